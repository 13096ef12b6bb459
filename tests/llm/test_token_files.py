"""Shards of compressed ids against the tokenizer, by Spark and by short reads."""

import glob
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import token_files as tf
from tripmart.runtime import fresh_folder

ENCODER = tf.encoder(tf.default_vocabulary(), tf.default_ranks())


def want(text):
    return [*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, tf.END_ID]


def written(docs, **how):
    path = f"{fresh_folder(docs.sparkSession, 'files')}/out"
    tf.write_tokens(docs, path, **how)
    return path


@pytest.fixture(scope="module")
def path(docs):
    return written(docs, shard_bytes=600)


def test_like_the_tokenizer(docs, path, spark):
    got = sorted(tf.read_tokens(spark, path).collect(), key=lambda r: r.start)
    rows = docs.select("doc_id", "text").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted((r.doc_id for r in rows), key=lambda k: (k is not None, k or 0))
    texts = {r.doc_id: r.text for r in rows}
    start = 0
    for r in got:
        ids = want(texts[r.doc_id])
        assert np.frombuffer(r.tokens, "<u4").tolist() == ids
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_manifest(docs, path, spark):
    shards = tf.read_manifest(spark, path).orderBy("shard").collect()
    assert len(shards) > 3 and sum(s.documents for s in shards) == docs.count()
    assert [s.start for s in shards] == np.cumsum([0, *[s.tokens for s in shards[:-1]]]).tolist()


def test_short_reads(docs, path, spark):
    """One document of a shard by header, footer, index and its own frame."""
    dictionary = tf.read_dictionary(spark, path)
    known = {hashlib.sha256(dictionary).digest(): dictionary}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = {}
    for name in glob.glob(f"{path.removeprefix('file:')}/files/kind=shards/*/part-*"):
        with open(name, "rb") as file:
            size, reads = file.seek(0, 2), []

            def read(at, n, file=file, reads=reads):
                file.seek(at)
                reads.append(n)
                return file.read(n)

            shard = tf.Shard(read, size, known)
            assert len(reads) == 3
            for key in texts:
                for ids in shard.find(key) if key is not None else []:
                    found.setdefault(key, []).append(ids.tolist())
            assert sum(reads[3:]) == shard.sizes[np.array(shard.index["id"].is_valid())].sum()
            with pytest.raises(ValueError, match="needs the dictionary"):
                tf.Shard(read, size, {})
    assert all(ids == want(texts[k]) for k, lists in found.items() for ids in lists)
    assert sorted(found) == sorted(k for k in texts if k is not None)


def test_shards_are_read_by_pieces(path, spark, monkeypatch):
    """No file is a value of a row, if Arrow opens the store; both ways give the same rows."""
    got = tf.read_tokens(spark, path)
    assert "content:binary" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tf, "reads_ranges", lambda path: False)
    whole = tf.read_tokens(spark, path)
    assert "content:binary" in whole._jdf.queryExecution().executedPlan().toString()
    by_start = [sorted(map(tuple, df.collect()), key=lambda r: r[1]) for df in (got, whole)]
    assert by_start[0] == by_start[1] and by_start[0]


def test_read_ahead():
    data, reads = bytes(range(250)), []

    def read(at, n):
        reads.append((at, n))
        return data[at : at + n]

    ahead = tf.read_ahead(read, len(data), 100)
    for at, n in ((0, 10), (240, 10), (10, 30), (40, 70), (110, 120), (230, 0)):
        assert bytes(ahead(at, n)) == data[at : at + n]
    assert reads == [(0, 100), (240, 10), (10, 100), (110, 120)]


def test_other_stores(tmp_path):
    assert tf.reads_ranges(f"file:{tmp_path}") and tf.reads_ranges(str(tmp_path))
    assert not tf.reads_ranges(f"{tmp_path}/none") and not tf.reads_ranges("viewfs://x/y")


def test_no_shard():
    with pytest.raises(ValueError, match="not a shard"):
        tf.Shard(lambda at, n: b"\0" * n, 500, {})


def test_keys_of_text(docs, spark):
    named = docs.selectExpr("concat('k', doc_id) AS name", "text AS body", "size AS doc_id")
    path = written(named, id_col="name", text_col="body")
    got = tf.read_tokens(spark, path, "name", "string", tokens=False)
    assert got.columns == ["name", "start", "n_tokens", "ids_crc32"]
    assert [r.name for r in got.orderBy("start").collect()] == [
        r.name for r in named.orderBy("name").collect()
    ]


def test_empty_table(no_docs, spark):
    path = written(no_docs)
    assert tf.read_dictionary(spark, path) == b""
    assert tf.read_tokens(spark, path).collect() == []


def test_many_equal_rows(spark):
    same = spark.range(3000).selectExpr("7L AS doc_id", "'the same words' AS text")
    path = written(same, shard_bytes=500)
    assert tf.read_manifest(spark, path).count() > 1
    got = sorted(tf.read_tokens(spark, path, tokens=False).collect(), key=lambda r: r.start)
    n = len(want("the same words"))
    assert [r.start for r in got] == list(range(0, 3000 * n, n))


def test_wide_ids_and_dictionaries():
    assert tf.id_width(65_535) == 2 and tf.id_width(65_536) == 4
    assert tf.trained_dictionary([]) == b"" and tf.trained_dictionary([b"", b"ab"]) == b"ab"


def test_same_ids_for_every_character():
    """Both libraries put every character into the same class."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b 1{c}2 !{c}! {c} " for c in every[i : i + 64]) for i in range(0, len(every), 64)]
    found = ENCODER.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, f in zip(texts, found) if ENCODER.ids(t) != f.ids] == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_same_ids(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [*ENCODER.ids(text), tf.END_ID] == want(text)


@pytest.mark.parametrize(
    "text", [" " * 200_000, "\n \t" * 50_000 + "x", "a" * 100_000, "<|endoftext|>", "x <|endoftext|>y"]
)
def test_same_ids_where_patterns_recurse(text):
    assert [*ENCODER.ids(text), tf.END_ID] == want(text)
