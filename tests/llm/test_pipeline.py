"""The pipeline against plain versions of its stages, on a small table."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioscope.llm import packing, quality, simhash, suffix_dedup

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def plain(rows, kept):
    """What stages two to four leave of ``rows`` (doc_id, text) that the classifier has kept."""
    docs = {k: t or "" for k, t in rows if k in kept}
    first = {}
    for k in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", docs[k]), k)
    docs = {k: docs[k] for k in first.values()}
    fp = {k: simhash.fingerprint(t) for k, t in docs.items()}
    root = {k: k for k in docs}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    words = {k: t.encode().lower().split() for k, t in docs.items()}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for k, w in words.items()}
    for k in docs:
        for j in docs:
            both = len(sets[k] & sets[j])
            if j < k and ((fp[k] ^ fp[j]).bit_count() <= 2 or both and both >= 0.8 * (len(sets[k]) + len(sets[j]) - both)):
                a, b = sorted((top(k), top(j)))
                root[b] = a
    docs = {k: t for k, t in docs.items() if top(k) == k}
    data = {k: t.encode() for k, t in docs.items()}
    count = Counter(hash(d[p : p + 200]) for d in data.values() for p in range(len(d) - 199))
    out = {}
    for k, d in data.items():
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - 199):
            if count[hash(d[p : p + 200])] > 1:
                gone[p : p + 200] = True
        edges = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(int))).tolist()
        out[k] = "".join(d[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2]))
    return out


def test_pipeline_equals_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {x["doc_id"] for x in quality.quality(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if x["kept"]}
    expected = plain([(x["doc_id"], x["text"]) for x in docs.select("doc_id", "text").collect()], kept)
    assert 0 < len(expected) < docs.count()
    found = defaultdict(list)
    for x in corpus_pipeline.run(spark, sf).collect():
        found[x["doc_id"]].append(x)
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    assert set(found) == set(expected)
    for k, text in expected.items():
        packed = tokenizer.encode(text) + (2).to_bytes(4, "little")
        at = 0
        for x in sorted(found[k], key=lambda x: x["start"]):
            assert x["start"] == at and x["doc_tokens"] == len(packed) // 4
            assert x["ids_crc32"] == zlib.crc32(packed[4 * at : 4 * (at + x["length"])])
            at += x["length"]
        assert at == len(packed) // 4


def test_stages_keep_the_columns_and_odd_rows(spark, sf):
    docs = spark.createDataFrame([(1, "a b c d", "en", None, 3), (None, None, None, "s", None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a b c d", "en", "s", 7), (4, "é" * 300, "fr", "s", 1), (5, "xé" + "é" * 299, "fr", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns
    ids = [x["doc_id"] for x in out.collect()]
    assert None in ids and 3 not in ids and 1 in ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs.unionByName(docs), sf).collect()
    assert sorted(x["doc_id"] for x in packed if x["doc_id"] and not x["start"]) == [1, 1, 2, 2, 2, 2, 3, 3, 4, 4, 5, 5]
    assert sum(x["doc_id"] is None for x in packed) == 2
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, sf)
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf).count() == 0


def test_rows_of_one_id_are_judged_by_their_texts(spark, sf):
    r = np.random.default_rng(3)
    a, b, c = (" ".join(f"w{x}" for x in r.integers(0, 9000, 300)) for _ in range(3))
    rows = [(3, a), (7, a.replace(" ", "\t\n", 2)), (7, b), (8, b), (9, b + " end"), (9, c), (9, c), (None, b), (11, a + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS text_sha256", "2 AS dropped_id")
    exact = corpus_pipeline.exact(spark, docs, sf)
    assert exact.columns == docs.columns
    left = sorted(((x["doc_id"], x["text"]) for x in exact.collect()), key=str)
    assert left == sorted([(3, a), (7, b), (9, b + " end"), (9, c), (9, c), (None, b), (11, a + " x")], key=str)
    near = sorted(((x["doc_id"], x["text"]) for x in corpus_pipeline.near(spark, exact, sf).collect()), key=str)
    assert near == sorted([(3, a), (7, b), (9, c), (9, c), (None, b)], key=str)


def test_passages_keep_characters_of_the_text(spark, sf):
    shared = "é" * 150
    rows = [(1, "keep \ufffd mark " + shared), (2, "xx" + shared + "è"), (3, "alone \ufffd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    found = {x["doc_id"]: (x["text"], x["n_chars"]) for x in corpus_pipeline.passages(spark, docs, sf).collect()}
    assert found == {1: ("keep \ufffd mark ", 12), 2: ("xx", 2), 3: ("alone \ufffd", 7)}


def test_passages_of_texts_that_end_a_byte_short_of_a_window_behind_their_last_phrase_start(spark, sf):
    text = bytes(np.random.default_rng(6).integers(97, 123, 30).astype(np.uint8)) + b"z" * 400
    text = text[: suffix_dedup.Parse([text]).starts[-1] + 199].decode()
    docs = spark.createDataFrame([(1, text), (2, text[1:]), (3, "alone")], "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    found = {x["doc_id"]: (x["text"], x["n_chars"]) for x in corpus_pipeline.passages(spark, docs, sf).collect()}
    assert found == {1: (text[0], 1), 2: ("", 0), 3: ("alone", 5)}
