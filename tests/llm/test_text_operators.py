"""Operators 3, 7, 8 and 9: round trips, held-out accuracy, brute force, and their defined cases."""

import base64
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from folioscope.llm import byte_bpe, licences, packing, quality

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_byte_bpe_equals_tiktoken_and_decodes(spark):
    import tiktoken

    path = byte_bpe.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    alphabet = "ab'sS  \n\t\r\x0b\x0c\x1c\x85\xa0\u2003é1²!?日本\u0301\U0001f600tllved"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(500)] + [None, "", "x" * 20000, " " * 5000, "<|endoftext|>"]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    found = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert len(found) == len(texts)
    for x in found:
        text = texts[x["doc_id"]] or ""
        assert x["ids"] == own.encode_ordinary(text)
        assert bytes(x["decoded"]) == text.encode()
    assert byte_bpe.encode(df.limit(0)).count() == 0


def test_packing_places_every_id_once(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_tokenizer())
    r = random.Random(2)
    texts = ["".join(r.choice(["Alpha ", "betas ", "x\n", "été ", "12,3 ", "don't "]) for _ in range(r.choice([0, 3, 100, 900, 2500]))) for _ in range(150)]
    texts += [None, "", "a<|endoftext|>b", "a\x1cb", "word " * 9000]
    df = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)] + [(7, texts[7], 5)], "doc_id long, text string, length int").repartition(4)
    packed = packing.pack_documents(df, with_ids=True).collect()
    expected = {k: [*own.encode(t or "", add_special_tokens=False).ids, 2] for k, t in enumerate(texts)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in packed:
        assert zlib.crc32(x["ids"]) == x["ids_crc32"] and len(x["ids"]) == 4 * x["length"]
        assert x["doc_tokens"] == len(expected[x["doc_id"]])
        by_doc[x["doc_id"]].append(x)
        by_sequence[x["sequence_id"]].append(x)
    for k, ids in expected.items():
        pieces = sorted(by_doc[k], key=lambda x: x["start"])
        pieces = pieces[::2] if k == 7 else pieces
        assert np.frombuffer(b"".join(x["ids"] for x in pieces), "<u4").tolist() == ids
    for rows in by_sequence.values():
        at = 0
        for x in sorted(rows, key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= packing.WINDOW
    tokens = sum(x["length"] for x in packed)
    assert tokens > 0.97 * packing.WINDOW * (len(by_sequence) - 1)
    whole = packing.sequences(packing.pack_documents(df, with_ids=True)).collect()
    assert len(whole) == len(by_sequence)
    assert all(len(x["tokens"]) == 4 * packing.WINDOW or (len(x["tokens"]) // 4).bit_count() == 1 for x in whole)
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_plan_covers_any_histogram():
    for seed in range(20):
        g = np.random.default_rng(seed)
        counts = {int(x): int(n) for x, n in zip([4096, *(64 * g.integers(1, 64, 12)), *g.integers(1, 64, 9)], g.integers(1, 5000, 22))}
        rows = packing.plan(counts)
        for length, n in counts.items():
            spans = sorted((a, b) for x, a, b, *_ in rows if x == length)
            assert spans[0][0] == 0 and spans[-1][1] == n and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
    assert packing.plan({}) == []


@pytest.mark.parametrize("mean", [300, 1200, 2600])
def test_plan_wastes_little_on_the_lengths_of_texts(mean):
    g = np.random.default_rng(mean)
    counts = defaultdict(int)
    for n in g.exponential(mean, 20000).astype(int) + 1:
        for _, length in packing.cuts(int(n)):
            counts[length] += 1
    rows = packing.plan(counts)
    fill = sum(x * n for x, n in counts.items())
    sequences = max(first + (b - a) // per for _, a, b, per, first, _ in rows)
    assert sequences <= 1.01 * fill / 4096 + 1


def test_nnls_ends_at_an_optimum():
    for seed in range(4):
        g = np.random.default_rng(seed)
        a, b = packing.combinations(64), g.integers(0, 2000, 63).astype(float)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-3 * np.abs(a.T @ b).max() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-3 * np.abs(a.T @ b).max()


def test_odd_columns_and_repeated_rows_of_tokenising_operators(spark):
    rows = [(1, "a b, c"), (1, "a b, c"), (None, "x" * 200_000), (2, None), (3, "")]
    df = spark.createDataFrame([(*x, 5, "y") for x in rows], "doc_id long, text string, ids int, length string").selectExpr("*", "1 AS part", "2 AS rank", "3 AS n")
    encoded = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert sorted(bytes(x["decoded"]).decode() for x in encoded) == sorted(t or "" for _, t in rows)
    packed = packing.pack_documents(df).collect()
    assert sum(x["doc_id"] == 1 and x["start"] == 0 for x in packed) == 2 and sum(x["doc_tokens"] == 1 for x in packed) == 2
    assert len({(x["sequence_id"], x["offset"]) for x in packed}) == len(packed)


def test_nnls_matches_a_known_solution():
    g = np.random.default_rng(0)
    a = g.random((30, 12))
    x = np.maximum(g.standard_normal(12), 0)
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert (packing.nnls(a, -np.ones(30)) == 0).all()


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = {x["doc_id"]: x["kept"] for x in quality.quality(docs, labels.filter("doc_id % 2 = 0")).collect()}
    held = labels.filter("doc_id % 2 = 1").collect()
    assert len(found) == docs.count()
    assert np.mean([found[x["doc_id"]] == (x["quality"] > 0) for x in held]) > 0.93
    assert np.mean([found[x["doc_id"]] for x in held if x["quality"]]) > 0.97


def test_quality_shrinks_sparse_sites(spark):
    rows = [(k, "Good plain words in a line. " * 5, f"h{k % 3}", "en") for k in range(60)] + [(100 + k, "BAD!! BAD!! WORDS!! ", "spam", "en") for k in range(60)] + [(500, "Good plain words in a line. " * 5, "lone", "en"), (501, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(60)] + [(100 + k, 0) for k in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    found = {x["doc_id"]: x for x in quality.quality(docs, labels).collect()}
    assert len(found) == len(rows)
    assert found[0]["kept"] and not found[100]["kept"] and found[500]["kept"]
    assert found[100]["site"] < found[500]["site"] < found[0]["site"]
    none = quality.quality(docs, labels.limit(0)).collect()
    assert all(x["kept"] for x in none)
    assert quality.quality(docs.limit(0), labels).count() == 0


def plain_posteriors(rows, keep=0.5):
    """(site, quality, kept) of each of (host, path, evidence), by plain loops."""
    p = [1 / (1 + math.exp(-e)) for *_, e in rows]
    base = sum(p) / len(p)

    def strength(sites):
        own = [(total / n, n, parent) for total, n, parent in sites if n > 1]
        if not own:
            return 1e4
        between = (sum((m - q) ** 2 / max(q * (1 - q), 1e-9) for m, _, q in own) - sum(1 / n for _, n, _ in own)) / len(own)
        return 1e4 if between <= 1e-4 else max(1.0, 1 / between - 1)

    def totals(key):
        return {k: (sum(x for x, r in zip(p, rows) if key(r) == k), sum(key(r) == k for r in rows)) for k in map(key, rows)}

    def logit(x):
        x = min(1 - 1e-6, max(1e-6, x))
        return math.log(x / (1 - x))

    hosts, paths = totals(lambda r: r[0]), totals(lambda r: r[:2])
    a = strength([(*x, base) for x in hosts.values()])
    mean = {h: (a * base + total) / (a + n) for h, (total, n) in hosts.items()}
    b = strength([(*x, mean[k[0]]) for k, x in paths.items()])
    out = []
    for own, (host, path, e) in zip(p, rows):
        total, n = paths[host, path]
        site = (b * mean[host] + total - own) / (b + n - 1)
        q = 1 / (1 + math.exp(-(e + logit(site) - logit(base))))
        out.append((site, q, q >= keep))
    return out


def test_quality_posteriors_equal_plain_loops(spark):
    r = random.Random(6)
    rows = [(h := f"h{min(9, int(r.expovariate(0.4)))}", f"{h}/{r.randrange(4)}", r.gauss(int(h[1:]) / 3 - 1, 2)) for _ in range(300)] + [("lone", "lone/x", -3.0), ("", "", 0.5)]
    rows = rows + rows[:7]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "doc_id long, host string, path string, evidence double").selectExpr("*", "1 / (1 + exp(-evidence)) AS p").repartition(4)
    found = {x["doc_id"]: (x["site"], x["quality"], x["kept"]) for x in quality.posteriors(df).collect()}
    for k, (site, q, kept) in enumerate(plain_posteriors(rows)):
        assert found[k][0] == pytest.approx(site) and found[k][1] == pytest.approx(q) and found[k][2] == kept


def test_features_of_each_text_are_its_own():
    texts = ["  The the, THE! cat\tcat\n\u00e9t\u00e9 ", "", None, " \n", "a !! b?! | cc, (d) #\n&", "x" * 1000 + " y.", "|", "ab", "ba", "Z"]
    made, named = quality.features(texts), len(quality.STATISTICS)
    assert made.shape == (len(texts), named + quality.BUCKETS)
    for k, t in enumerate(texts):
        assert (made[k] == quality.features([t])[0]).all()
    words = np.rint(np.expm1(made[:, named:]) * np.maximum(1, [len((t or "").split()) for t in texts])[:, None] / 100).astype(int)
    assert words.sum(axis=1).tolist() == [6, 0, 0, 0, 8, 2, 1, 1, 1, 1] and sorted(words[0][words[0] > 0]) == [1, 2, 3]
    assert (words[7] != words[8]).any()
    signs = made[4, [quality.STATISTICS.index(x) for x in ("punctuation_runs", "punctuation_words", "line_breaks", "comma")]]
    assert (signs * 8).tolist() == [2, 4, 1, 1]
    assert made[0, quality.STATISTICS.index("line_breaks")] == 1 / 6 and made[5, quality.STATISTICS.index("ends_full_stop")] == 1


def test_quality_of_urls_repeated_labels_and_odd_rows(spark):
    good, bad = "Good plain words in a line. " * 5, "BAD!! BAD!! WORDS!! "
    rows = [(k, good * (1 + k % 9) + f"n{k}", f"https://a.org/x/{k}", 1.5, "c") for k in range(40)] + [(100 + k, bad * (1 + k), f"http://b.net/{k % 2}/y", 1.5, "c") for k in range(40)]
    rows += [(7, good, "https://a.org/x", 0.0, "c")] * 200 + [(None, good, None, 0.0, "c"), (600, good * 9 + "n " * 200_000, "not a url", 0.0, "c"), (601, None, "https://a.org", 0.0, "c"), (602, "", "https://a.org/?q", 0.0, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, url string, features double, host string").repartition(5)
    labels = spark.createDataFrame([(k, 1) for k in range(40)] + [(100 + k, 0) for k in range(40)] + [(7, 1)] * 50 + [(7, 0)] * 60 + [(8, 1), (8, 0)], "doc_id long, quality int")
    table = quality._labelled(docs, labels, "quality", 1000).collect()
    assert len(table) == 80 and {x["doc_id"]: x["y"] for x in table}[7] == 0.0 and {x["doc_id"]: x["y"] for x in table}[8] == 1.0
    assert len(quality._labelled(docs, labels, "quality", 20).collect()) < 50
    found = quality.quality(docs, labels).collect()
    assert len(found) == len(rows)
    by_id = {x["doc_id"]: x["kept"] for x in found}
    assert by_id[20] and not by_id[120] and {None, 600, 601, 602} <= set(by_id)
    host, path = quality.sites(docs)
    named = {(x[0], x[1]) for x in docs.select(host, path).collect()}
    assert {("a.org", "a.org/x"), ("b.net", "b.net/0"), ("b.net", "b.net/1")} <= named


def test_licence_rules(spark):
    full = "Copyright 2020 X\n\n" + "\n\n".join(re.sub(r"(.{50,70}?) ", "\\1\n", licences.SENTENCES[k]) for k in ("mit.grant", "mit.notice", "mit.warranty")) + "\n"
    wrong = "\n\n".join(licences.SENTENCES[k] for k in ("mit.warranty", "mit.notice", "mit.grant"))
    header = "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n"
    rows = [(1, full), (2, wrong), (3, header), (4, "words\nReleased under the MIT License. more"), (5, "Licensed under CC BY-NC 4.0.\nx\nReleased under the MIT License."), (6, None), (7, ""), (8, "a license is here"), (9, "x " * 50000 + "\nReleased under the MIT license!")]
    found = {x["doc_id"]: x["licences"] for x in licences.scan(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, licences int")).collect()}
    assert found == {1: ["MIT"], 2: [], 3: ["Apache-2.0"], 4: ["MIT"], 5: ["CC-BY-NC-4.0", "MIT"], 6: [], 7: [], 8: [], 9: ["MIT"]}


def test_each_licence_sentence_names_its_own_licence(spark):
    rows = {"\n".join(licences.SENTENCES[k] for k in keys): [licence] for licence, keys, _ in licences.RULES}
    rows |= {"\n\n".join(licences.SENTENCES[k] for k in keys): [licence] for licence, keys, _ in licences.RULES}
    rows |= {sentence: [licence] for sentence, licence in licences.notices().items()}
    rows |= {
        "SPDX-License-Identifier: WTFPL": [],
        "SPDX-License-Identifier: Some\nA word about a license:\nMIT": [],
        "// SPDX-License-Identifier: MPL-2.0\r\nint x;": ["MPL-2.0"],
        "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0": ["Apache-2.0", "MIT"],
        "/* SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) */": ["GPL-2.0"],
        "# SPDX-License-Identifier: LGPL-2.1-or-later OR MIT": ["LGPL-2.1", "MIT"],
        "SPDX-License-Identifier: MIT AND WTFPL": ["MIT"],
        "SPDX-License-Identifier:": [],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.": [],
        "// subject to\n// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy": [],
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy": ["MPL-2.0"],
        "3. " + "\n".join(licences.SENTENCES[k] for k in ("bsd.grant", "bsd.endorse", "bsd.warranty")): ["BSD-3-Clause"],
        licences.SENTENCES["bsd.grant"] + "\n3. " + licences.SENTENCES["bsd.endorse"] + "\n\n" + licences.SENTENCES["bsd.warranty"]: ["BSD-3-Clause"],
    }
    texts = list(rows)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: x for x in licences.scan(docs).collect()}
    assert {t: found[k]["licences"] for k, t in enumerate(texts)} == rows
    assert found[texts.index("SPDX-License-Identifier: MIT")]["sentence_ids"] == ["notice.MIT"]
    known, alone, _ = licences.tables()
    assert all(any(c in f or c == "cc-by" for c in licences.CUES) for f in known)
    assert len({licences.normal_form(s) for s in licences.notices()}) == len({(licences.normal_form(s), x) for s, x in licences.notices().items()})

    import duckdb

    documents = docs.toPandas()
    own = {d: (x.split(",") if x else [], n, i) for d, x, n, i in duckdb.sql(licences.ORACLE).fetchall()}
    assert len(documents) == len(own)
    assert own == {k: (x["licences"], x["n_sentences"], " ".join(x["sentence_ids"])) for k, x in found.items()}


def test_licences_of_long_repeated_and_no_rows(spark):
    import time

    many = "\n".join(licences.SENTENCES[k] for k in ("bsd.grant", "mit.notice", "isc.grant", "mit.warranty")) + "\n"
    rows = [(1, many * 5000), (2, "Released under the MIT License."), (2, "Released under the MIT License."), (None, "Released under the ISC License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    found = [(x["doc_id"], x["licences"], x["n_sentences"]) for x in licences.scan(docs).collect()]
    assert time.time() - began < 20
    assert sorted(found, key=str) == sorted([(1, ["ISC"], 20000), (2, ["MIT"], 1), (2, ["MIT"], 1), (None, ["ISC"], 1)], key=str)
    assert licences.scan(docs.limit(0)).count() == 0
