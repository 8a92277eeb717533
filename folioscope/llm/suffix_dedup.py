"""Suffix-array dedup of byte strings by prefix-free parsing, a shard at a time.

Windows that may be repeated are found and dealt to shards by their anchors (see
``anchors.py``); all places of a window are in one shard. A shard's contexts are
parsed: a rolling hash over ``TRIGGER`` bytes cuts them into phrases that overlap by a
trigger, so that no phrase's suffix longer than a trigger is a proper prefix of
another's. The *dictionary* holds each distinct phrase once, the *parse* is the
sequence of phrase ranks. Suffix ranks of the dictionary and of the parse are made by
prefix doubling; the rank of a place's phrase suffix and then the rank of the parse
behind it are its place in corpus order. Places that are neighbours there with a
common prefix of ``WINDOW`` bytes or more hold the same window: the prefix within a
phrase is read in the dictionary, that behind it in the parse, whose neighbours'
common prefixes bound those of all places between. Highly repetitive shards have a
small dictionary, and each of its strings is sorted once.

Contexts of an anchor with very many of them may be decided by grouping equal windows
instead (step 4 of ``anchors.py``).

Every byte that is covered by a ``WINDOW``-byte string which also starts anywhere
else is removed. Texts are compared as UTF-8 and matches lie within one document.

Defined cases: a null text is empty. Rows that repeat a doc_id are documents of
their own; rows without doc_id count like any other. An empty table gives an
empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Bytes, covered, grams, repeated, with_repeats

WINDOW, GRAM, SHARD = 200, 32, 2 << 20
TRIGGER, MODULUS = 12, 32


def suffix_ranks(key: np.ndarray, depth: int, left: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of strings, equal for equal ones, by prefix doubling.

    ``key`` orders them to ``depth`` symbols; ``left`` is how many a suffix has. A rank
    is one more than the number of suffixes before it. Suffixes that are alone or have
    ended leave the rounds: with an equal prefix, all have ended or none has.
    """
    n = len(key)
    rank, active, behind = np.zeros(n, np.int64), np.arange(n), key
    while len(active):
        before = rank[active]
        order = np.argsort(before * (n + 1) + behind) if active.size < n or rank.any() else np.argsort(behind)
        before, behind, active = before[order], behind[order], active[order]
        opens = np.r_[True, before[1:] != before[:-1]]
        new = opens | np.r_[True, behind[1:] != behind[:-1]]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.r_[heads, len(active)])
        first = np.maximum.accumulate(np.where(opens, np.arange(len(active)), 0))[heads]
        rank[active] = np.repeat(np.maximum(before[heads], 1) + heads - first, sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        active = active[left[active] > depth]
        behind = rank[active + depth]
        depth *= 2
    return rank


def _common(symbols: np.ndarray, starts: np.ndarray, most: int, step: int = 8192) -> np.ndarray:
    """The common prefix, up to ``most``, of each start with the one before; -1 for the first."""
    padded = np.r_[symbols, np.zeros(most, symbols.dtype)]
    found = np.full(len(starts), -1, np.int64)
    for at in range(1, len(starts), step):
        rows = padded[starts[at - 1 : at + step, None] + np.arange(most)]
        differ = rows[1:] != rows[:-1]
        found[at : at + step] = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    return found


class Parse:
    """The prefix-free parse of some strings, and the ranks of its dictionary's and its own suffixes."""

    def __init__(self, strings: list[bytes], trigger: int = TRIGGER, modulus: int = MODULUS):
        sizes = np.array([len(s) + 1 for s in strings])
        self.begins = np.r_[0, np.cumsum(sizes)[:-1]]
        ends = self.begins + sizes  # behind each string's end symbol, 0
        self.symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
        self.symbols[ends - 1] = 0
        n, of = len(self.symbols), np.repeat(np.arange(len(strings)), sizes)

        triggered = np.zeros(n, bool)
        if n >= trigger:
            hashes = grams(self.symbols.astype(np.uint64), trigger)
            triggered[: len(hashes)] = (hashes >> np.uint64(20)) % np.uint64(modulus) == 0
            triggered[: len(hashes)] &= np.arange(trigger, n + 1) < ends[of[: len(hashes)]]  # within a string
        triggered[self.begins] = True
        self.starts = np.flatnonzero(triggered)
        last = np.r_[of[self.starts][1:] != of[self.starts][:-1], True]
        stops = np.where(last, ends[of[self.starts]], np.r_[self.starts[1:], 0] + trigger)

        raw, known, firsts, phrase = self.symbols.astype(">u2").tobytes(), {}, [], []
        for a, b in zip(self.starts.tolist(), stops.tolist()):
            own = raw[2 * a : 2 * b]
            k = known.setdefault(own, len(firsts))
            if k == len(firsts):
                firsts.append((a, b))
            phrase.append(k)
        phrase = np.array(phrase)

        lengths = np.array([b - a for a, b in firsts])
        heads = np.r_[0, np.cumsum(lengths)[:-1]]
        self.dictionary = np.concatenate([self.symbols[a:b] for a, b in firsts])
        self.left = np.repeat(heads + lengths, lengths) - np.arange(len(self.dictionary))
        key, padded = np.zeros(len(self.dictionary), np.int64), np.r_[self.dictionary, np.zeros(7, np.uint16)].astype(np.int64)
        for k in range(7):
            key = key << 9 | np.where(self.left > k, padded[k : k + len(key)], 0)
        self.ranks = suffix_ranks(key, 7, self.left)

        #: Every symbol's phrase and place in the dictionary.
        self.phrase = np.cumsum(triggered) - 1
        self.place = heads[phrase][self.phrase] + np.arange(n) - self.starts[self.phrase]
        behind = np.cumsum(last[::-1])[::-1]  # strings still to end
        whole = np.flatnonzero(last)
        self.parse_ranks = suffix_ranks(self.ranks[heads[phrase]], 1, whole[len(whole) - behind] - np.arange(len(phrase)) + 1)
        self.trigger = trigger

    def order(self) -> np.ndarray:
        """All places in corpus order, by their phrase's suffix and then by the parse behind it."""
        following = np.r_[self.parse_ranks, 0][np.minimum(self.phrase + 1, len(self.parse_ranks))]
        following[self.left[self.place] == np.r_[self.begins[1:], len(self.symbols)][np.searchsorted(self.begins, np.arange(len(self.symbols)), side="right") - 1] - np.arange(len(self.symbols))] = 0
        return np.lexsort((following, self.ranks[self.place]))

    def repeated(self, window: int) -> np.ndarray:
        """For each place, whether the ``window`` symbols from it on lie in its string and occur at another place."""
        ends = np.repeat(np.r_[self.begins[1:], len(self.symbols)], np.diff(np.r_[self.begins, len(self.symbols)]))
        able = np.flatnonzero(np.arange(len(self.symbols)) + window < ends)
        left, found = self.left[self.place[able]], np.zeros(len(self.symbols), bool)

        def mark(places: np.ndarray, key: np.ndarray) -> None:
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            found[places[order[np.r_[same, False] | np.r_[False, same]]]] = True

        chosen = able[left >= window]  # windows within a phrase: the dictionary's order alone
        if len(chosen) > 1:
            long = np.flatnonzero(self.left >= window)
            long = long[np.argsort(self.ranks[long])]
            within = np.zeros(len(self.left), np.int64)
            within[long] = np.cumsum(_common(self.dictionary, long, window) < window)
            mark(chosen, within[self.place[chosen]])
        sorted_parse = np.argsort(self.parse_ranks)
        shared = _common(self.symbols, self.starts[sorted_parse], window + self.trigger)
        by_left = np.argsort(left, kind="stable")
        bounds = np.searchsorted(left[by_left], np.arange(window + 1))
        interval = np.empty(len(sorted_parse), np.int64)
        for own in range(self.trigger + 1, window):
            chosen = able[by_left[bounds[own] : bounds[own + 1]]]
            if len(chosen) > 1:
                interval[sorted_parse] = np.cumsum(shared < window - own + self.trigger)
                mark(chosen, self.ranks[self.place[chosen]] * (len(interval) + 1) + interval[self.phrase[chosen] + 1])
        return found


def compare(_of: np.ndarray, contexts: list[bytes], _at: np.ndarray, _doc_ids=None, window: int = WINDOW) -> list[np.ndarray]:
    """For each context, which of its windows another context has."""
    parse = Parse(contexts)
    found = parse.repeated(window)
    return [found[b : b + max(0, len(c) - window + 1)] for b, c in zip(parse.begins.tolist(), contexts)]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed, kept, carried): removed spans and the remaining bytes, one row per input row.

    ``carried`` is a struct of the columns named in ``carry``, unchanged. With
    ``as_text``, ``kept`` is a string: the parts of characters that a cut leaves at
    its edges go too.
    """
    others = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), others.alias("carried"))
    found = repeated(named.drop("carried"), Bytes(WINDOW, GRAM), compare, False, SHARD, **({"hot": hot} if hot is not None else {}))
    joined = with_repeats(named, found)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_bytes", "n_removed", "removed", "kept", "carried"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, removed, kept = [], [], [], []
            for text, copies, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "copies", "spans"))):
                data = text.encode()
                if copies is not None and copies > 1 and len(data) >= WINDOW:
                    spans = [(0, len(data))]
                else:
                    spans = covered([(s["a"], s["b"]) for s in starts or ()], WINDOW)
                edges = [0, *[x for s in spans for x in s], len(data)]
                sizes.append(len(data))
                gone.append(sum(b - a for a, b in spans))
                removed.append([{"start": a, "end": b} for a, b in spans])
                left = [data[a:b] for a, b in zip(edges[::2], edges[1::2])]
                kept.append("".join(x.decode("utf-8", "ignore") for x in left) if as_text else b"".join(left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, span), pa.array(kept, pa.string() if as_text else pa.binary()), batch.column("carried")], names)

    kind = named.schema["carried"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}, carried {kind}")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    result = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return result.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, h, unnest(range(len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400),
m AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS w FROM p),
f AS (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM m),
s AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200, true) AS opens FROM f WHERE n > 1),
g AS (SELECT r, i, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM s),
x AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY r, k),
y AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM x),
t AS (SELECT y.r, count(*) AS n_spans, sum(b - a) AS n_removed,
      string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM y JOIN d ON d.r = y.r GROUP BY y.r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN t ON t.r = d.r
"""
