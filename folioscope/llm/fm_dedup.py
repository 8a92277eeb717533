"""Substring dedup of word sequences with an FM-index per shard.

Windows of ``WINDOW`` words that may be repeated are found and dealt to shards by
their anchors (see ``anchors.py``); all places of a window are in one shard. A
shard's contexts are indexed: their words become symbols, a suffix array to the
depth of a window gives the Burrows-Wheeler transform, which is kept as a wavelet
matrix of packed bits with sampled counts; the suffix array itself and the interval
that each suffix shares with those that agree with it for a window are plain arrays,
bounded by the shard. Each context is then streamed through the index
from its end: a step of backward search extends the match by a word, and beyond a
window's length the interval is widened to the suffixes that share a window. The
matching statistics so capped at ``WINDOW`` give for every start the interval of
its window; it is reported if the interval holds a smaller doc_id.

Defined cases: a null text has no words. Rows of one doc_id never remove each
other's words. Rows without doc_id come after all others and count as one
document. An empty table gives an empty result. Columns other than the two named
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import LAST, Words, covered, repeated, with_repeats

WINDOW, GRAM, SHARD = 50, 8, 2 << 20


def suffix_array(symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order to a depth beyond ``window``, and where one differs from the one before within it."""
    n, depth = len(symbols), 1
    rank = symbols.astype(np.int64) + 1
    at_depth: list[tuple[int, np.ndarray]] = []
    while True:
        if depth <= window:
            at_depth.append((depth, rank))
        behind = np.zeros(n, np.int64)
        behind[: n - depth] = rank[depth:] if depth < n else 0
        key = rank * (int(rank.max()) + 1) + behind if n else rank
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.array([], bool)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        depth *= 2
        if depth > window + 1 or n == 0:
            break
    have, names = at_depth[-1]
    step = np.minimum(order + window - have, n - 1)
    first, second = names[order], np.where(order + window - have < n, names[step], 0)
    differs = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])] if n else np.array([], bool)
    return order, differs


class Wavelet:
    """Rank queries over symbols: one packed bit vector per binary digit, with a count before every 64 bits."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        own = symbols.astype(np.int64)
        for digit in range(digits - 1, -1, -1):
            bits = (own >> digit & 1).astype(bool)
            packed = np.zeros(len(bits) // 64 + 1, "<u8")
            packed.view(np.uint8)[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
            before = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)][:-1].astype(np.int64)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((digit, packed, before, zeros))
            own = np.concatenate([own[~bits], own[bits]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` comes to lie among the places of its symbol in the sorted sequence."""
        for digit, packed, before, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(packed[block] & mask).astype(np.int64)
            at = np.where(symbols >> digit & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Backward search over contexts of symbols 1 and up, each followed by symbol 0."""

    def __init__(self, text: np.ndarray, window: int):
        order, differs = suffix_array(text, window)
        n, symbols = len(text), int(text.max(initial=0)) + 1
        self.order = order
        self.bwt = Wavelet(text[order - 1] if n else text, max(1, (symbols - 1).bit_length()))
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))].astype(np.int64)
        self.base = self.bwt.place(np.arange(symbols), np.zeros(symbols, np.int64))
        self.starts = np.flatnonzero(differs)
        self.ends = np.r_[self.starts[1:], n]
        self.of = np.cumsum(differs) - 1

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with ``symbol`` put in front."""
        both = np.r_[symbol, symbol]
        place = self.bwt.place(both, np.r_[low, high]) - self.base[both] + self.before[both]
        return place[: len(symbol)], place[len(symbol) :]


def matching_statistics(index: FMIndex, contexts: np.ndarray, lengths: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(contexts, start, interval) of every window; ``contexts`` is padded to the right, intervals as in ``index.starts``."""
    n = len(lengths)
    low, high = np.zeros(n, np.int64), np.full(n, index.before[-1], np.int64)
    for step in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > step)
        at = lengths[live] - 1 - step
        a, b = index.extend(contexts[live, at], low[live], high[live])
        if step >= window:
            interval = index.of[a]
            a, b = index.starts[interval], index.ends[interval]
        low[live], high[live] = a, b
        if step >= window - 1:
            yield live, at, index.of[a]


def compare(of: np.ndarray, contexts: list[bytes], _at: np.ndarray, doc_ids: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each context, which of its windows occur under a smaller doc_id."""
    values = Words(window, GRAM).parse(contexts)
    lengths = np.array([len(v) for v in values])
    names, symbols = np.unique(np.concatenate(values), return_inverse=True)
    symbols = symbols + 1
    padded = np.zeros((len(values), int(lengths.max()) + 1), np.int64)
    inside = np.arange(padded.shape[1]) < lengths[:, None]
    padded[inside] = symbols
    text = padded[np.arange(padded.shape[1]) <= lengths[:, None]]
    index = FMIndex(text, window)
    owner = np.repeat(doc_ids, lengths + 1)[index.order]
    least = np.minimum.reduceat(owner, index.starts)
    flags = [np.zeros(max(0, k - window + 1), bool) for k in lengths.tolist()]
    for live, at, interval in matching_statistics(index, padded, lengths, window):
        hit = least[interval] < doc_ids[live]
        for k, start in zip(live[hit].tolist(), at[hit].tolist()):
            flags[k][start] = True
    return flags


def word_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_text): removed spans of words and the rest, one row per input row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = repeated(own, Words(WINDOW, GRAM), compare, True, SHARD, **({"hot": hot} if hot is not None else {}))
    joined = with_repeats(own, found)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, removed, kept = [], [], [], []
            for doc_id, text, first, starts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "first_id", "spans"))):
                words = text.encode().split()
                if first is not None and first < (LAST if doc_id is None else doc_id):
                    spans = [(0, len(words))] if len(words) >= WINDOW else []
                else:
                    spans = covered([(s["a"], s["b"]) for s in starts or ()], WINDOW)
                edges = [0, *[x for s in spans for x in s], len(words)]
                sizes.append(len(words))
                gone.append(sum(b - a for a, b in spans))
                removed.append([{"start": a, "end": b} for a, b in spans])
                kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, span), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "removed", "kept_text"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string")


def op4_fm_dedup(spark, sf_dir: str) -> DataFrame:
    result = word_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM p),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE least < doc_id),
k AS (SELECT d.doc_id, u.i, u.x FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x) u),
r AS (SELECT k.doc_id, k.i, k.x, g.i IS NOT NULL AS removed FROM k LEFT JOIN g ON g.doc_id = k.doc_id AND g.i = k.i),
t AS (SELECT doc_id, count(*) FILTER (removed) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT removed), '') AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
