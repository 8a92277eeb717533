"""Operators 1, 5, 6 and 10 against brute force, and their defined cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from folioscope.llm import components, embedding_dedup, exact_dedup, line_dedup, simhash

WORDS = ["alpha", "beta", "Gamma", "delta", "être", "x", "42", "omega"]


def texts(seed, n=120):
    r = random.Random(seed)
    made = [None, "", " ", "a", "a  b", "a\tb", "one two", "x" * 9000, "word " * 6000]
    while len(made) < n:
        if len(made) > 20 and r.random() < 0.4:
            t = r.choice(made[9:])
            made.append(t if r.random() < 0.5 else t.replace(" ", r.choice(["  ", "\n", " "]), 3) + r.choice(["", "", " end"]))
        else:
            made.append("".join(r.choice(WORDS) + r.choice([" ", " ", "\n"]) for _ in range(r.randint(0, 400))))
    return made


def documents(spark, seed=1):
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts(seed))]
    rows.append(rows[30])
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id string, fp int").repartition(3), rows


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_exact_dedup_is_grouping_by_normalised_text(spark):
    docs, rows = documents(spark)
    groups = {}
    for k, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t or ""), []).append(k)
    expected = sorted((k, min(g), len(g), k == min(g), hashlib.sha256(body.encode()).hexdigest()) for body, g in groups.items() for k in g)
    found = exact_dedup.exact_dedup(docs).drop("n_chunks").collect()
    assert sorted(map(tuple, found)) == expected


def test_chunks_are_the_text_and_follow_content(spark):
    r = random.Random(3)
    body = " ".join(r.choice(WORDS) for _ in range(4000))
    df = spark.createDataFrame([(body,), ("intro words that shift it all " + body,), ("é" * 30000,), ("",)], "body string")
    cut = [x[0] for x in df.select(exact_dedup.chunks(df["body"])).collect()]
    assert ["".join(c) for c in cut] == [x[0] for x in df.collect()]
    assert len(set(cut[0]) & set(cut[1])) > len(cut[0]) / 2
    assert all(len(c) <= exact_dedup.MAX_CHARS for own in cut for c in own)


def test_exact_dedup_without_ids_and_without_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (None, "b")], "doc_id long, text string")
    found = sorted(map(tuple, exact_dedup.exact_dedup(df).select("doc_id", "keep_id", "kept").collect()), key=str)
    assert found == [(3, 3, True), (None, 3, False), (None, None, True), (None, None, True)]
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def brute_lines(rows, length):
    seen, gone = set(), {}
    for k, t in rows:
        lines = (t or "").split("\n")
        out = set()
        for p in range(len(lines) - length + 1):
            w = tuple(lines[p : p + length])
            if w in seen:
                out.update(range(p, p + length))
            seen.add(w)
        gone[k] = (len(lines), len(out), "\n".join(x for i, x in enumerate(lines) if i not in out))
    return gone


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_line_dedup_deletes_later_copies_of_runs(spark, length):
    r = random.Random(length)
    rows = [(k, "\n".join(r.choice("abcd") for _ in range(r.randint(0, 30)))) for k in range(60)] + [(90, None), (91, "\n\n\n\n\n\n\n\n")]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, uid int").repartition(5)
    found = {x["doc_id"]: (x["n_lines"], x["n_removed"], x["kept_text"]) for x in line_dedup.line_dedup(df, min_lines=length).collect()}
    assert found == brute_lines(rows, length)
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_line_dedup_keeps_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "x\ny\nz")], "doc_id long, text string")
    assert sorted(x["n_removed"] for x in line_dedup.line_dedup(df).collect()) == [0, 0, 3]


def test_line_and_exact_dedup_of_long_texts_and_clashing_columns(spark):
    long = "\n".join(f"line {k}" for k in range(40_000))
    rows = [(1, long), (2, "head\n" + long), (3, "é" * 300_000), (4, "é" * 300_000 + " "), (5, "é" * 300_000)]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, lines int, pos int").selectExpr("*", "3 AS runs", "4 AS recipe", "5 AS body", "6 AS found")
    found = {x["doc_id"]: (x["n_lines"], x["n_removed"], x["kept_text"][:4]) for x in line_dedup.line_dedup(df).collect()}
    assert found[1][:2] == (40_000, 0) and found[2] == (40_001, 40_000, "head")
    assert {x["doc_id"]: x["keep_id"] for x in exact_dedup.exact_dedup(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


def slow_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0d]+", words)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_classes_equal_brute_force(spark):
    docs, rows = documents(spark, 5)
    fp = {k: slow_fingerprint(t) for k, t, *_ in rows}
    comp = union([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2], fp)
    found = simhash.near_dedup(docs).collect()
    assert len(found) == len(rows)
    assert {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in found} == {k: (f"{fp[k]:016x}", comp[k]) for k in fp}
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def test_simhash_links_lose_nothing(spark):
    r = random.Random(9)
    values = {r.getrandbits(64) for _ in range(300)}
    for v in list(values)[:150]:
        values.add(v ^ 1 << r.randrange(64))
        values.add(v ^ 1 << r.randrange(64) ^ 1 << r.randrange(64))
    values |= {k for k in range(200)} | {1 << 63, (1 << 63) | 1}
    values = sorted(values)
    signed = [v - (v >> 63 << 64) for v in values]
    df = spark.createDataFrame([(v, 1) for v in signed], "fp long, id long")
    made = components.components(simhash.links(df)).collect()
    comp = union([(a, b) for a in signed for b in signed if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2], signed)
    linked = {n for n in comp if any(m != n and comp[m] == comp[n] for m in comp)}
    assert {x["node"]: x["component"] for x in made} == {n: comp[n] for n in linked}


def test_simhash_of_missing_and_repeated_ids(spark, monkeypatch):
    own = [(1, 0), (None, 3), (2, 15), (7, 31 << 40), (7, 255 << 20), (9, 63 << 40), (4, 255 << 20 | 1), (None, 1023 << 50)]
    rows = spark.createDataFrame(own, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: rows)
    found = {(x["doc_id"], int(x["fingerprint"], 16)): (x["component_id"], x["kept"]) for x in simhash.near_dedup(rows).collect()}
    assert found == {
        (1, 0): (1, True), (None, 3): (1, False), (2, 15): (1, False),
        (7, 31 << 40): (7, True), (9, 63 << 40): (7, False),
        (7, 255 << 20): (4, False), (4, 255 << 20 | 1): (4, True), (None, 1023 << 50): (None, True),
    }


def test_bk_tree_finds_all_within_radius():
    r = random.Random(2)
    values = {r.getrandbits(12) for _ in range(500)}
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 4096, 37):
        assert sorted(tree.near(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def test_components_of_paths_stars_and_rings(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 180)] + [(500, k) for k in range(501, 560)] + [(600 + k, 600 + (k + 1) % 30) for k in range(30)] + [(7, 7), (None, 3)]
    names = list(range(1000))
    r.shuffle(names)
    renamed = [(a if a is None else names[a], names[b]) for a, b in edges]
    comp = union([(a, b) for a, b in renamed if a is not None and a != b], {x for a, b in renamed if a is not None and a != b for x in (a, b)})
    found = components.components(spark.createDataFrame(renamed, "a long, b long")).collect()
    assert {x["node"]: x["component"] for x in found} == comp


def test_components_take_logarithmic_rounds(spark):
    path = spark.range(10_000).selectExpr("id AS a", "id + 1 AS b")
    roots, rounds = components.contracted(path)
    assert rounds <= 20 and roots.count() == 10_001 and roots.select("root").distinct().count() == 1
    star = spark.range(1, 5000).selectExpr("0L AS a", "id AS b")
    roots, rounds = components.contracted(star)
    assert rounds <= 3 and roots.select("root").distinct().count() == 1


def cluster_rows(seed, n=400, dim=16):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((20, dim))
    rows = []
    for k in range(n):
        v = centres[g.integers(20)] + g.standard_normal(dim) * g.choice([0.02, 0.15, 1.0])
        rows.append((k, [float(np.float32(x)) for x in v], int(g.integers(3))))
    for k in range(n, n + 40):
        rows.append((k, rows[k - n][1], rows[k - n][2]))
    nan, inf = float("nan"), float("inf")
    rows += [(n + 50, None, 1), (n + 51, [0.0] * dim, 1), (n + 52, [nan] + [1.0] * (dim - 1), 1), (n + 53, [inf] + [1.0] * (dim - 1), 1), (n + 54, rows[0][1], None), (n + 55, [None] + [1.0] * (dim - 1), 1), (n + 56, [], 1), (n + 57, [1.0, 2.0], 1)]
    return rows


def brute_links(rows, threshold):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for a, va, la in rows:
        for b, vb, lb in rows:
            if a < b and la == lb is not None and usable(va) and usable(vb) and len(va) == len(vb):
                if np.dot(va, vb) / (np.linalg.norm(va) * np.linalg.norm(vb)) >= threshold:
                    links.append((a, b))
    return links


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links_are_true_and_nearly_all_found(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup.near_links, "__defaults__", (embedding_dedup.THRESHOLD, block))
    rows = cluster_rows(block)
    df = spark.createDataFrame([(*x, 0) for x in rows], "vec_id long, embedding array<float>, label int, id int").repartition(4)
    links = brute_links(rows, embedding_dedup.THRESHOLD)
    count = {k: 0 for k, *_ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    comp = union(links, count)
    found = {x["vec_id"]: x for x in embedding_dedup.near_dedup(df).collect()}
    assert set(found) == set(count)
    assert all(found[k]["n_links"] <= count[k] for k in count)
    assert sum(x["n_links"] for x in found.values()) >= 0.97 * 2 * len(links) > 200
    assert np.mean([found[k]["component_id"] == comp[k] for k in comp]) > 0.97
    assert all(x["kept"] == (x["component_id"] == x["vec_id"]) for x in found.values())
    assert embedding_dedup.near_dedup(df.limit(0)).count() == 0


def test_embeddings_of_missing_and_repeated_ids(spark):
    rows = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [0.0, 1.0]), (5, [1.0, 0.01]), (None, [1.0, 0.02]), (6, [1.0, 0.03]), (None, [-1.0, 0.0]), (None, None), (3, None)]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, label int")
    found = sorted((map(tuple, embedding_dedup.near_dedup(df).collect())), key=str)
    assert found == sorted([(7, 3, 5, False), (7, 1, 7, True), (8, 1, 7, False), (5, 3, 5, True), (None, 3, 5, False), (6, 3, 5, False), (None, 0, None, True), (None, 0, None, True), (3, 0, 3, True)], key=str)


def test_sketches_lose_few_pairs_at_the_threshold():
    g = np.random.default_rng(3)
    a, b = g.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = embedding_dedup.THRESHOLD * a + np.sqrt(1 - embedding_dedup.THRESHOLD**2) * b
    p = embedding_dedup.planes(64, embedding_dedup.SKETCH, 1)
    differ = ((a @ p > 0) != (c @ p > 0)).sum(axis=1)
    assert (differ > embedding_dedup.far()).sum() <= 2
    assert (((a @ p > 0) != (np.roll(a, 1, axis=0) @ p > 0)).sum(axis=1) <= embedding_dedup.far()).mean() < 0.01


@pytest.mark.parametrize("block", [1024, 7])
def test_similar_texts_are_joined(spark, block, monkeypatch):
    monkeypatch.setattr(simhash.similar_links, "__defaults__", (simhash.SIMILARITY, block))
    r = random.Random(block)
    words = [f"w{k}" for k in range(3000)]
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b")]
    for base in range(12):
        text = [r.choice(words) for _ in range(r.randint(60, 400))]
        for _ in range(9):
            own = list(text)
            for _ in range(r.randint(0, len(own) // 25)):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append((10 + len(rows), " ".join(own)))
    rows.append(rows[50])
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for k, t in rows}
    fp = {k: slow_fingerprint(t) for k, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and (len(sets[a] & sets[b]) >= 0.8 * max(1, len(sets[a] | sets[b])) or (fp[a] ^ fp[b]).bit_count() <= 2)]
    comp = union(near, sets)
    assert len(near) > 100
    docs = spark.createDataFrame([(*x, 1) for x in rows] + [(None, "q", 1)], "doc_id long, text string, keys int").repartition(3)
    found = simhash.similar_dedup(docs).collect()
    assert len(found) == len(rows) + 1
    got = {x["doc_id"]: x["component_id"] for x in found}
    assert {k: got[k] for k in comp} == comp
    assert simhash.similar_dedup(docs.limit(0)).count() == 0


def test_similar_texts_are_joined_however_often_a_line_repeats(spark):
    r = random.Random(11)
    rows, line = [], " or eight words that make up a line"
    for k in range(12):
        body = " ".join(f"w{r.randrange(5000)}" for _ in range(400))
        rows += [(10 * k + n, body + (f" n{k}" + line) * times) for n, times in enumerate((2, 21, 31, 61))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = {x["doc_id"]: x for x in simhash.sketches(docs).collect()}
    assert all(own[k]["shingles"] == own[k - k % 10]["shingles"] for k in own)
    assert {x["doc_id"]: x["component_id"] for x in simhash.similar_dedup(docs).collect()} == {k: k - k % 10 for k, _ in rows}


@pytest.mark.parametrize("crossing", [False, True])
def test_all_pairs_of_a_key_are_compared(crossing):
    g = np.random.default_rng(crossing)
    common, sets = g.integers(0, 1 << 32, 20, dtype=np.uint64), []
    for size in g.integers(30, 900, 20):
        base = np.concatenate([common, g.integers(0, 1 << 32, size, dtype=np.uint64)])
        sets += [np.unique(np.concatenate([base[int(cut * len(base)) :], g.integers(0, 1 << 32, int(cut * len(base)), dtype=np.uint64)])).astype("<u4") for cut in (0, 0.05, 0.1, 0.12, 0.3)]
    n = len(sets)
    blocks = np.arange(n) % 2 if crossing else np.zeros(n, int)

    def similar(a, b):
        both = len(set(a.tolist()) & set(b.tolist()))
        return both >= 0.8 * (len(a) + len(b) - both)

    near = [(a, b) for a in range(n) for b in range(a) if (not crossing or blocks[a] != blocks[b]) and similar(sets[a], sets[b])]
    assert len(near) > 20
    for few in (n, 2, 6):
        pairs = [(a, b) for a, b in near if a < few]
        made = simhash._joined(np.arange(few), sets[:few], blocks[:few], 0.8)
        assert union(made, range(few)) == union(pairs, range(few))
    labels = np.arange(n) // 5
    made = simhash._joined(np.arange(n), sets, blocks, 0.8, labels)
    known = [(k, 5 * (k // 5)) for k in range(n)]
    assert union(made + known, range(n)) == union(near + known, range(n))
    postings = simhash.Postings(sets)
    for k in (0, 9, n - 1):
        assert np.delete(postings.common(k, 7), k).tolist() == [len(np.intersect1d(sets[k], x)) for j, x in enumerate(sets) if j != k]
