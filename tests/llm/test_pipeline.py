"""The pipeline: what each stage does to its own input, and its last rows."""

import hashlib
import struct
from collections import Counter

import corpus_pipeline
from tripmart.llm import bpe, near_dedup, toxicity
from tripmart.llm.common import parked, table

from .test_dedup import exact_want, near_want

SMALL = "/root/testdata/sf0.001"


def test_near_copies_between_80_and_85_percent_are_dropped(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles, of which a change costs five
    texts = []
    for group in range(20):
        one = [f"g{group}{w}" for w in base]
        other = list(one)
        other[20] = other[60] = "new"  # 90 of 110 shingles: 0.818
        far = list(one)
        far[20] = far[50] = far[80] = "far"  # 85 of 115: 0.739, to other 80 of 120
        texts += [one, other, far]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows if i % 3 != 1}
    assert near_dedup.drop_near_copies(docs).count() == len(rows)  # op8's own threshold
    for percent in (80, 85):
        bands, width = near_dedup.band_shape(percent)
        assert (1 - (percent / 100) ** width) ** bands <= near_dedup.MISS


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        after = parked(stage(spark, docs, SMALL), "stage")
        seen[name] = (docs, after)
        docs = after
    assert all(after.columns == columns for _, after in list(seen.values())[:-1])

    before, after = seen["toxicity"]
    model = toxicity.fit(before, table(spark, SMALL, "labels"))
    want = {r.doc_id for r in model.score(before).collect() if r.score < 0.5}
    assert {r.doc_id for r in after.collect()} == want

    before, after = seen["exact dedup"]
    want, _ = exact_want(before.select("doc_id", "text").collect())
    assert {r.doc_id for r in after.collect()} == {w[1] for w in want}

    before, after = seen["near dedup"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    want = near_want(rows, corpus_pipeline.NEAR_PERCENT)
    assert {r.doc_id for r in after.collect()} == {k for k, (_, top) in want.items() if k == top}

    before, after = seen["mixing"]
    known = {r.doc_id for r in before.collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert set(copies) <= known and max(copies.values()) <= 2

    before, after = seen["bpe"]
    tokenizer = bpe._tokenizer(bpe.default_vocabulary())
    want = Counter()
    for key, text in before.select("doc_id", "text").collect():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, decoded.encode())]
        want[key, len(ids), *digests] += 1
    assert Counter(map(tuple, after.collect())) == want
