"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import (
    bpe,
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    importance,
    language_id,
    mixing,
    near_dedup,
    quality_crf,
    secrets_scan,
    token_files,
    toxicity,
    url_filter,
)
from tripmart.llm.common import table
from tripmart.runtime import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return keep


@register("op1_bpe_tokens")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(bpe.encode_decode(table(spark, folder, "documents")))


RULE_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)


@register(
    "op2_url_filter",
    rf"""
    WITH rules(verdict, rhost, rpath) AS (VALUES {RULE_SQL}),
    rest AS (
        SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
        FROM pages
    ),
    hosts AS (
        SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest
    ),
    parts AS (
        SELECT page_id, translate(h, '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
            regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path
        FROM hosts
    ),
    fit AS (
        SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule
        FROM (SELECT DISTINCT * FROM parts) AS d JOIN rules
            ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        GROUP BY ALL
    )
    SELECT p.page_id, p.host, p.path, f.rule,
        coalesce(r.verdict, '{url_filter.DEFAULT}') AS verdict
    FROM parts AS p
    LEFT JOIN fit AS f ON p.page_id IS NOT DISTINCT FROM f.page_id
        AND p.host = f.host AND p.path = f.path
    LEFT JOIN rules AS r ON f.rule = r.rhost || r.rpath
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark))


@register("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op4_language")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language(table(spark, folder, "documents"))


@register("op5_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_scan.span_digest(secrets_scan.scan_secrets(table(spark, folder, "documents")))


@register("op6_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return quality_crf.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register(
    "op7_exact_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (
        SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
            first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
        FROM d
    )
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@register("op8_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


@register("op9_embedding_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.vector_groups(table(spark, folder, "embeddings"))


@register(
    "op10_mixing",
    rf"""
    WITH d AS (
        SELECT doc_id, source,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents
    ),
    s AS (
        SELECT source, source_size, {mixing.MOST} * source_size AS cap,
            list_value({", ".join(map(str, mixing.WEIGHTS))})[
                1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1)
                % {len(mixing.WEIGHTS)}] AS weight,
            row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
    ),
    w AS (
        SELECT *, sum(source_size) OVER () * {mixing.TOTAL}::DOUBLE AS everything,
            coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
            sum(weight) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
        FROM s
    ),
    level AS (
        SELECT * FROM w WHERE weight * (everything - capped) / open <= cap
        ORDER BY cap / weight, rank LIMIT 1
    ),
    t AS (
        SELECT w.source, w.source_size, CASE
            WHEN (w.cap / w.weight, w.rank) >= (l.cap / l.weight, l.rank)
            THEN w.weight * (l.everything - l.capped) / l.open
            ELSE w.cap::DOUBLE END AS target
        FROM w, level AS l
    ),
    e AS (
        SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
            CASE WHEN t.source_size > 0
                THEN floor(t.target / t.source_size * {mixing.UNIT})::BIGINT ELSE 0 END AS units,
            ('0x' || substr(sha256('1:' || coalesce('s' || d.source, '')), 1, 7))::BIGINT * 4
                AS start
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ),
    r AS (
        SELECT *, start + sum(units) OVER (PARTITION BY source ORDER BY size, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
        FROM e
    )
    SELECT doc_id, size, source_size, target,
        ((stop // {mixing.UNIT} - (stop - units) // {mixing.UNIT}) * size)::BIGINT AS taken
    FROM r
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


# CRC-32 of a text by its bytes, with a table from the generator polynomial.
CRC_TABLE_SQL = """
    crc_table AS MATERIALIZED (
        SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
                THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT) AS v
            FROM range(256) AS r(i)
        )
    )
"""


def crc_sql(text: str) -> str:
    """The CRC-32 of a text, beside the table ``t`` of ``crc_table``."""
    bytes_ = (
        f"[('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT "
        f"FOR i IN range(strlen({text}))]"
    )
    return (
        f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), "
        "4294967295::BIGINT), 4294967295::BIGINT)"
    )


def _words_sql(column: str) -> str:
    folded = f"translate(coalesce({column}, ''), '{importance.UPPER}', '{importance.LOWER}')"
    return f"regexp_extract_all({folded}, '{importance.WORD_PATTERN}')"


@register(
    "op11_importance",
    rf"""
    WITH {CRC_TABLE_SQL},
    d AS (SELECT doc_id, {_words_sql("text")} AS words FROM documents),
    b AS (SELECT unnest({_words_sql("text")}) AS word FROM benchmark),
    counted AS (SELECT doc_id, unnest(words) AS word FROM d),
    distinct_words AS (SELECT word FROM counted UNION SELECT word FROM b),
    hashed AS MATERIALIZED (
        SELECT word, {crc_sql("word")} % {importance.BUCKETS} AS bucket
        FROM distinct_words, crc_table
    ),
    s AS (SELECT bucket, count(*) AS s FROM counted JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (word) GROUP BY bucket),
    gains AS (
        SELECT bucket, floor(1000 * ln(
            (coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s)
                + {importance.BUCKETS})::DOUBLE
            / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t)
                + {importance.BUCKETS})::DOUBLE)))::BIGINT AS gain
        FROM s FULL JOIN t USING (bucket)
    ),
    w AS (
        SELECT doc_id, sum(gain)::BIGINT AS weight
        FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
    ),
    scored AS (
        SELECT d.doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('{importance.SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5)
                    ::DOUBLE / 4294967296)))::BIGINT AS score
        FROM d LEFT JOIN w USING (doc_id)
    ),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r,
            count(*) OVER () * {importance.PERCENT} // 100 AS most
        FROM scored WHERE n_features >= {importance.LEAST_WORDS}
    )
    SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
        CASE WHEN r <= most THEN r END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).select("doc_id", "n_features", "weight", "score", "rank")


@register(
    "op12_conversation_trie",
    rf"""
    WITH {CRC_TABLE_SQL},
    turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, strlen(coalesce(text, '')) AS size,
            strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS id
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    own AS MATERIALIZED (
        SELECT conv_id, list({{'id': id, 'size': size}}
            ORDER BY turn NULLS FIRST, role, substr(sha256(id), 1, 32), size) AS turns
        FROM turns GROUP BY conv_id
    ),
    starts AS (
        SELECT conv_id, turns,
            {crc_sql("conv_id::VARCHAR")} % {conversation_trie.STARTS} AS h
        FROM own, crc_table
    ),
    rebuilt AS MATERIALIZED (
        SELECT s.conv_id, list_concat(coalesce(b.turns[1:h], []), s.turns[h + 1:]) AS turns
        FROM starts AS s LEFT JOIN own AS b
            ON b.conv_id = s.conv_id - s.conv_id % {conversation_trie.SHARED}
    ),
    reached AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
    nodes AS MATERIALIZED (
        SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                FILTER (len(turns) = depth), '')) AS ends_sha256
        FROM reached GROUP BY ALL
    ),
    children AS (
        SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY ALL
    ),
    counted AS MATERIALIZED (
        SELECT n.*, coalesce(c.n_children, 0) AS n_children,
            CASE WHEN n.depth = 0 THEN 0 ELSE n.path[n.depth].size END AS size
        FROM nodes AS n LEFT JOIN children AS c ON n.depth = c.depth AND n.path = c.path
    ),
    below AS (
        SELECT path, n_convs, n_children, size, unnest(range(depth + 1)) AS depth FROM counted
    ),
    subtrees AS (
        SELECT path[1:depth] AS path, depth, count(*) FILTER (n_children = 0) AS n_leaves,
            sum((n_convs - 1) * size)::BIGINT AS saved_tokens
        FROM below GROUP BY ALL
    )
    SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
        s.n_leaves, s.saved_tokens, c.ends_sha256
    FROM counted AS c
    JOIN subtrees AS s ON c.depth = s.depth AND c.path = s.path
    LEFT JOIN nodes AS p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.conversation_turns(table(spark, folder, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.rebuilt(turns))


@register("op13_token_files")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{fresh_folder(spark, 'token-files')}/corpus"
    token_files.write_tokens(table(spark, folder, "documents"), path)
    return token_files.read_tokens(spark, path, tokens=False)
