"""Secret scan: key patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spells natural words with few tokens and random strings with
many. A run of key characters with fewer than ``MAX_RATIO`` characters a token is reported
as kind ``random``, unless it is a known digest, a uuid or an identifier that people
write; of letters only, or of digits only, with ``STRICT_RATIO`` and fewer. What patterns
leave of a run is tested like a run, and if a run as a whole passes, so are the stretches
between signs and words in it. Runs are scored in pieces of a fixed length, so a text of one endless run costs
no more than others, and every piece counts.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds and patterns of the registered query, in the order of the listing.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
MIN_RUN = 20
PIECE = 256
MAX_RATIO = 2.2
STRICT_RATIO = 2.0  # for words, of which the oddest of the test data has 2.1
LEAST_SIGNS = 6  # different characters; words with fewer are repetitions
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)  # md5, sha-1, tiger, sha-2 and sha-3 sizes
HEX_ONLY = re.compile(r"[0-9a-fA-F]+\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
UUID_WITHIN = re.compile(r"(?<![0-9a-zA-Z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-zA-Z])")
PART = re.compile(r"[^/_=-]+")
SIGNS = "/_=-"
# Words joined by signs, each letters with at most a short number after them.
IDENTIFIER = re.compile(r"(?:[A-Za-z]+\d{0,4}|\d{1,8})(?:[_/+=-]+(?:[A-Za-z]+\d{0,4}|\d{1,8}))*[_/+=-]*\Z")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    spans = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6
    ]
    if "AKIA" in text:
        spans += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(spans)


def token_counts(texts: list[str], vocabulary: str) -> list[int]:
    """Tokens of each text, encoded in pieces of a fixed length."""
    counts = []
    for text in texts:
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
        encoded = _encoding(vocabulary).encode_ordinary_batch(pieces, num_threads=1)
        counts.append(sum(map(len, encoded)))
    return counts


def is_random(run: str, vocabulary: str, max_ratio: float = MAX_RATIO) -> bool:
    """Whether a run takes more tokens than words or known formats do."""
    if UUID.match(run) or (len(run) in DIGEST_LENGTHS and HEX_ONLY.match(run)):
        return False
    if IDENTIFIER.match(run):
        # Words that are as long as a key are no words if they take too many tokens.
        long = [
            w for w in PART.findall(run) if len(w) >= MIN_RUN and len(set(w)) >= LEAST_SIGNS
        ]
        counts = token_counts(long, vocabulary)
        return any(len(w) <= STRICT_RATIO * n for w, n in zip(long, counts))
    [tokens] = token_counts([run], vocabulary)
    if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return len(set(run)) >= LEAST_SIGNS and len(run) <= STRICT_RATIO * tokens
    return len(run) < max_ratio * tokens


def random_stretches(text: str, start: int, end: int, vocabulary: str) -> list[tuple[int, int]]:
    """The random stretches of a run: what uuids leave of it, or parts between words of that."""
    found, cuts = [], [(m.start(), m.end()) for m in UUID_WITHIN.finditer(text, start, end)]
    for a, b in rest_of(start, end, cuts):
        if b - a < MIN_RUN:
            continue
        if is_random(text[a:b], vocabulary):
            found.append((a, b))
            continue
        parts = [(m.start(), m.end()) for m in PART.finditer(text, a, b)]
        counts = token_counts([text[x:y] for x, y in parts], vocabulary)
        words = [(x, y) for (x, y), n in zip(parts, counts) if y - x >= MAX_RATIO * n]
        for x, y in rest_of(a, b, words):
            inner = text[x:y].strip(SIGNS)
            x = text.index(inner, x) if inner else x
            if len(inner) < MIN_RUN:
                continue
            if is_random(inner, vocabulary):
                found.append((x, x + len(inner)))
                continue
            # Numbers and short names beside a key can pass for an identifier with it.
            for m in PART.finditer(text, x, x + len(inner)):
                if m.end() - m.start() >= MIN_RUN and is_random(m.group(), vocabulary):
                    found.append((m.start(), m.end()))
    return found


def rest_of(start: int, end: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted cuts, which may overlap, leave of an interval."""
    rest = []
    for a, b in cuts:
        if start < min(a, end):
            rest.append((start, min(a, end)))
        start = max(start, b)
    return [*rest, (start, end)] if start < end else rest


def find_spans(text: str, vocabulary: str) -> list[tuple[int, int, int]]:
    """All spans; those of the token test do not overlap those of the patterns."""
    spans = base_spans(text)
    taken = [(a, b) for a, _, b in spans]
    extra, at = [], 0
    for m in RUN.finditer(text):
        if m.end() - m.start() < MIN_RUN:
            continue
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        upto = at
        while upto < len(taken) and taken[upto][0] < m.end():
            upto += 1
        for start, end in rest_of(m.start(), m.end(), taken[at:upto]):
            if start > m.start():  # the sign after a pattern is no part of the rest
                start = end - len(text[start:end].lstrip(SIGNS))
            if end - start >= MIN_RUN:
                extra += [(a, 3, b) for a, b in random_stretches(text, start, end, vocabulary)]
    return sorted(spans + extra)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """Id and ``found``, the spans (kind, start, end) of every row in code points, sorted.

    A null text is an empty one and has no spans. Rows are scanned one by one where they
    are read; repeated rows give repeated results, an empty table none.
    """
    path = vocabulary or default_vocabulary()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            found = [
                [
                    {"kind": KINDS[k], "start": a, "end": b}
                    for a, k, b in find_spans(text or "", path)
                ]
                for text in (value.as_py() for value in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(kind))], ["_id", "found"]
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"_id {id_type}, found array<struct<kind:string,start:int,end:int>>"
    ).withColumnRenamed("_id", id_col)


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the pattern spans and all spans as text."""

    def listed(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def of(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        id_col,
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        of("random").alias("n_random"),
    )
