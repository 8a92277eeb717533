"""Operators 2 and 4 against brute force, and their defined cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioscope.llm import anchors, fm_dedup, suffix_dedup


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 7))) for _ in range(300)]

    def prose(k):
        return "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", "  "]) for _ in range(k))

    passages = [prose(k) for k in (30, 45, 60, 80, 200, 51)]
    texts = [None, "", "a", "x" * 199, "y" * 200, "z" * 900, "ab " * 400, prose(30) * 12]
    while len(texts) < n:
        t = prose(r.randint(0, 150))
        for _ in range(r.randint(0, 3)):
            t += r.choice(passages) + prose(r.randint(0, 60))
        texts.append(t)
        if r.random() < 0.3:
            texts.append(texts[r.randrange(8, len(texts))])
        if r.random() < 0.3:
            own = texts[r.randrange(8, len(texts))].split(" ")
            own[len(own) // 2 : len(own) // 2 + 1] = ["changed"]
            texts.append(" ".join(own))
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts, 1)]
    return [*rows, rows[20], (500, rows[25][1])]


def brute_bytes(rows, window):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[p : p + window] for d in data for p in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - window + 1):
            if count[d[p : p + window]] > 1:
                gone[p : p + window] = True
        spans = int(np.sum(np.diff(np.r_[False, gone].astype(int)) == 1))
        out.append((len(d), int(gone.sum()), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def brute_words(rows, window):
    words = [(anchors.LAST if k is None else k, (t or "").encode().split()) for k, t in rows]
    least = defaultdict(lambda: anchors.LAST)
    for k, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            least[key] = min(least[key], k)
    out = []
    for k, w in words:
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - window + 1):
            if least[tuple(w[p : p + window])] < k:
                gone[p : p + window] = True
        out.append((len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*x, 3, "clash") for x in rows], "doc_id long, text string, n int, spans string").repartition(3)


def order(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize(("seed", "hot"), [(1, None), (2, 2), (3, 0)])
def test_suffix_dedup_equals_brute_force(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(anchors, "BLOCK", 700)
    rows = corpus(seed)
    found = suffix_dedup.substring_dedup(frame(spark, rows), hot=hot).collect()
    got = order((x["doc_id"], x["n_bytes"], x["n_removed"], len(x["removed"]), bytes(x["kept"])) for x in found)
    assert got == order((k, *x) for (k, _), x in zip(rows, brute_bytes(rows, 200)))


@pytest.mark.parametrize(("seed", "hot"), [(4, None), (5, 2), (6, 0)])
def test_word_dedup_equals_brute_force(spark, seed, hot):
    rows = corpus(seed)
    found = fm_dedup.word_dedup(frame(spark, rows), hot=hot).collect()
    got = order((x["doc_id"], x["n_words"], x["n_removed"], x["kept_text"]) for x in found)
    assert got == order((k, *x) for (k, _), x in zip(rows, brute_words(rows, 50)))


@pytest.mark.parametrize(("trigger", "modulus"), [(1, 1), (2, 3), (4, 5), (6, 1 << 40)])
def test_prefix_free_parse_gives_corpus_order_and_repeats(trigger, modulus):
    g = np.random.default_rng(trigger)
    base = bytes(g.integers(0, 3, 400).astype(np.uint8))
    strings = [base[a : a + k] for a, k in zip(g.integers(0, 380, 60), g.integers(0, 60, 60))] + [b"", bytes(90), base[5:40] * 2]
    parse = suffix_dedup.Parse(strings, trigger, modulus)
    suffixes = [s[k:] for s in strings for k in range(len(s) + 1)]
    ordered = [suffixes[k] for k in parse.order() if parse.left[parse.place[k]] > trigger or suffixes[k] == b""]
    assert [x for x in ordered if len(x) >= trigger] == sorted(x for x in suffixes if len(x) >= trigger)
    for window in (trigger + 1, 10, 25):
        count = Counter(x[:window] for x in suffixes if len(x) >= window)
        assert parse.repeated(window).tolist() == [len(x) >= window and count[x[:window]] > 1 for x in suffixes]


def ending_in_a_phrase_of(size, seed):
    """A text whose last phrase has ``size`` bytes, and the only one that is longer than its head."""
    head = bytes(np.random.default_rng(seed).integers(97, 123, 30).astype(np.uint8))
    text = head + b"z" * 400
    return text[: suffix_dedup.Parse([text]).starts[-1] + size]


@pytest.mark.parametrize("size", [198, 199, 200, 201])
def test_a_shard_without_a_window_inside_a_phrase(size):
    checked = 0
    for seed in range(60):
        text = ending_in_a_phrase_of(size, seed)
        for contexts in ([text], [text, b"x" + text], [text, text[1:]], [text, text[:-1], b"y" * 250]):
            contexts = [c for c in contexts if len(c) >= 200]
            if contexts:
                count = Counter(c[p : p + 200] for c in contexts for p in range(len(c) - 199))
                found = suffix_dedup.compare(None, contexts, None)
                assert [f.tolist() for f in found] == [[count[c[p : p + 200]] > 1 for p in range(len(c) - 199)] for c in contexts]
                checked += 1
    assert checked > 100


def test_suffix_dedup_of_texts_whose_last_phrase_is_a_byte_short_of_a_window(spark):
    text = ending_in_a_phrase_of(199, 6).decode()
    rows = [(1, text), (2, text[1:]), (3, "other " * 10), (4, None)]
    found = suffix_dedup.substring_dedup(frame(spark, rows)).collect()
    got = order((x["doc_id"], x["n_bytes"], x["n_removed"], len(x["removed"]), bytes(x["kept"])) for x in found)
    assert got == order((k, *x) for (k, _), x in zip(rows, brute_bytes(rows, 200)))
    assert sum(x[2] for x in got) == 2 * len(text) - 2


def test_common_prefixes_in_steps():
    g = np.random.default_rng(8)
    symbols, starts = g.integers(0, 2, 300).astype(np.uint16), g.integers(0, 290, 101)
    found = suffix_dedup._common(symbols, starts, 9, 7)
    padded = np.r_[symbols, np.zeros(9, int)]
    assert found.tolist() == [-1] + [next((k for k in range(9) if padded[a + k] != padded[b + k]), 9) for a, b in zip(starts, starts[1:])]


def test_rows_without_id_that_repeat_a_text_stay_linear(spark, monkeypatch):
    made = []
    plain = anchors._contexts
    monkeypatch.setattr(anchors, "_contexts", lambda *a: made.append(plain(*a).count()) or plain(*a))
    text = "".join(chr(97 + x) for x in np.random.default_rng(5).integers(0, 26, 3000))
    sizes = []
    for n in (40, 160):
        rows = [(None, text)] * n + [(7, text[500:1500])] * n + [(8, "x" + text[600:1400])]
        found = suffix_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
        assert [(x["n_bytes"], x["n_removed"]) for x in found if x["doc_id"] == 8] == [(801, 800)]
        assert all(x["n_removed"] == x["n_bytes"] for x in found if x["doc_id"] != 8)
        sizes.append(made[-1])
    assert sizes[1] <= 2 * sizes[0]
    rows = [(None, " ".join(text[k : k + 3] for k in range(0, 600, 3)))] * 50 + [(9, " ".join(text[k : k + 3] for k in range(30, 600, 3)))]
    found = fm_dedup.word_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(x["doc_id"], x["n_words"], x["n_removed"]) for x in found} == {(None, 200, 190), (9, 190, 0)}


def test_empty_tables(spark):
    empty = frame(spark, [(1, "a")]).limit(0)
    assert suffix_dedup.substring_dedup(empty).count() == 0
    assert fm_dedup.word_dedup(empty).count() == 0


def test_every_window_has_its_content_s_anchor():
    g = np.random.default_rng(1)
    values = g.integers(0, 3, 5000).astype(np.uint64)
    values[1000:1400] = 7
    ends = np.array([1700, 1700, 1750, 5000])
    seen, owner = {}, {}
    for first, last, place, h in anchors.anchors(values, ends, 40, 8):
        for a, b, p, x in zip(first, last, place, h):
            for s in range(a, b + 1):
                owner[s] = (p - s, x)
    begins = [0, 1700, 1700, 1750]
    assert set(owner) == {s for a, b in zip(begins, ends) for s in range(a, b - 39)}
    for s, o in owner.items():
        assert seen.setdefault(values[s : s + 40].tobytes(), o) == o


def test_fm_index_counts_and_widens():
    g = np.random.default_rng(2)
    parts = [g.integers(1, 5, k) for k in (30, 12, 12, 50, 3)]
    text = np.concatenate([np.r_[p, 0] for p in parts])
    index = fm_dedup.FMIndex(text, 4)
    lengths = np.array([len(p) for p in parts])
    padded = np.zeros((len(parts), 51), np.int64)
    for k, p in enumerate(parts):
        padded[k, : len(p)] = p
    count = Counter(tuple(p[i : i + 4]) for p in parts for i in range(len(p) - 3))
    checked = 0
    for live, at, interval in fm_dedup.matching_statistics(index, padded, lengths, 4):
        for k, s, i in zip(live, at, interval):
            assert index.ends[i] - index.starts[i] == count[tuple(parts[k][s : s + 4])]
            checked += 1
    assert checked == sum(count.values())
