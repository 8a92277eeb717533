"""Finding repeated windows: what the two substring operators share.

A window is a fixed number of consecutive units (bytes or words) of one text.
Every window has an anchor that depends on its content alone: the gram in it with
the least rolling hash (the leftmost of equals). Consecutive windows share
anchors, so a text has about two anchors per window length, and equal windows
have equal anchors wherever they stand. The steps, all keyed and all reading
written tables:

1. Equal texts are collapsed to the smallest id and a count. Texts, and below
   contexts, are told apart by two 64-bit hashes with different seeds, 128 bits that
   are not verified further.
2. Anchors are counted over distinct texts. Those that occur once are dropped: no
   window over them is repeated.
3. For each other anchor its *context* is cut out: the windows it anchors.
   Equal contexts are collapsed to classes.
4. Classes that share an anchor are compared by the operator's index, a shard of
   anchors at a time. An anchor with more than ``HOT`` distinct contexts would
   make a hot shard. Its contexts are cut into parts of fewer windows, keyed by
   the units that all windows of a part share, and steps 3 and 4 are repeated for
   the parts, with ever fewer windows a part. At one window a part the key is a hash
   of the window itself, so a key has one context; should hashes clash, all of its
   contexts are compared.
5. Repeated starts go back to the members of their classes and to their texts.

No group is gathered beyond ``HOT`` contexts or one text, and hot keys occur only
in joins of two written tables, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import clear, save, small_batches
from .simhash import _and_end

HOT, BLOCK = 256, 1 << 20
LAST = (1 << 63) - 1
_PLACE = (1 << 26) - 1
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def grams(values: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` values, by doubling."""
    odd = _ODD[seed]
    h, have = _mix((values + np.uint64(seed + 1)) * np.uint64(odd)), 1
    while have * 2 <= length:
        h = h[:-have] * np.uint64(pow(odd, have, 1 << 64)) + h[have:]
        have *= 2
        if have % 4 == 0 or have == length:
            h = _mix(h)
    if have < length:
        step = length - have
        h = _mix(h[:-step] * np.uint64(pow(odd, length, 1 << 64)) + h[step:])
    return h


def _least(h: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[: len(h) - (width - have)], h[width - have :]) if have < width else h


def anchors(values: np.ndarray, ends: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first start, last start, anchor, hash) of the runs of windows that share an anchor.

    ``values`` holds several texts, ending at ``ends``; windows lie in one text.
    Long input is taken in blocks, which may cut a run in two.
    """
    for at in range(0, len(values) - window + 1, BLOCK):
        own = values[at : at + BLOCK + window - 1]
        h = grams(own, gram)
        least = _least((h & np.uint64(~_PLACE & (1 << 64) - 1)) | np.arange(len(h), dtype=np.uint64), window - gram + 1)
        starts = np.arange(at, at + len(least))
        inside = ends[np.searchsorted(ends, starts, side="right")] - starts >= window
        new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])])
        last = np.r_[new[1:], len(least)] - 1
        new, last = new[inside[new]], last[inside[new]]
        place = (least[new] & np.uint64(_PLACE)).astype(np.int64)
        yield at + new, at + last, at + place, h[place]


class Units:
    """How texts are cut into units; one per operator."""

    #: Windows a part, level by level, where an anchor is hot.
    parts: tuple[int, ...] = (1,)

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def values(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, object]:
        """All units' values, the end of each text among them, and what ``cut`` needs."""
        raise NotImplementedError

    def cut(self, raw, start: int, end: int) -> bytes:
        raise NotImplementedError

    def raw(self, context: bytes):
        """What ``cut`` needs, from a context that it has made."""
        raise NotImplementedError


class Bytes(Units):
    parts = (24, 4, 1)

    def values(self, texts):
        joined = b"".join(texts)
        return np.frombuffer(joined, np.uint8).astype(np.uint64), np.cumsum([len(t) for t in texts]), joined

    def cut(self, raw, start, end):
        return raw[start:end]

    def raw(self, context):
        return context


class Words(Units):
    """Runs of other than ASCII white space."""

    parts = (6, 2, 1)

    def values(self, texts):
        from xxhash import xxh64_intdigest

        words = [t.split() for t in texts]
        flat = [w for own in words for w in own]
        hashes = {w: xxh64_intdigest(w) for w in set(flat)}
        return np.array(list(map(hashes.__getitem__, flat)), np.uint64), np.cumsum([len(w) for w in words]), flat

    def cut(self, raw, start, end):
        return b" ".join(raw[start:end])

    def raw(self, context):
        return context.split(b" ")

    def parse(self, contexts: list[bytes]) -> list[np.ndarray]:
        """Values of contexts that ``cut`` has made."""
        values, ends, _ = self.values(contexts)
        return np.split(values, ends[:-1]) if len(ends) else []


def _batches(column: pa.Array) -> list[bytes]:
    return [(x.as_py() or "").encode() for x in column]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _anchored(texts: DataFrame, units: Units) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends, _ = units.values(_batches(batch.column(3)))
            found = list(anchors(values, ends, units.window, units.gram)) if len(values) >= units.window else []
            starts = np.concatenate([f[0] for f in found]) if found else np.array([], np.int64)
            hashes = np.concatenate([f[3] for f in found]) if found else np.array([], np.uint64)
            offsets = np.r_[0, np.searchsorted(starts, ends)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(offsets), _longs(hashes))], ["doc_id", "t1", "t2", "anchors"])

    return texts.mapInArrow(run, "doc_id long, t1 long, t2 long, anchors array<long>")


#: A context of the text or class (p1, p2), with its windows' first and last start there and the anchor's place in it.
_MEMBERS = "p1 long, p2 long, doc_id long, anchor long, first long, last long, at long, context binary"
_MEMBER_NAMES = [c.split(" ")[0] for c in _MEMBERS.split(", ")]


def _contexts(texts: DataFrame, units: Units) -> DataFrame:
    names = _MEMBER_NAMES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in (1, 2, 5))))
            new = [copies == 1 or (t1, t2) not in seen and not seen.add((t1, t2)) for t1, t2, copies in keys]  # rows may repeat
            batch = batch.filter(pa.array(new))
            values, ends, raw = units.values(_batches(batch.column(3)))
            shared = np.unique(batch.column(4).flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
            begins = np.r_[0, ends[:-1]]
            for first, last, place, h in anchors(values, ends, units.window, units.gram) if len(values) >= units.window else ():
                chosen = np.isin(h, shared)
                first, last, place, h = first[chosen], last[chosen], place[chosen], h[chosen]
                of = np.searchsorted(ends, first, side="right")
                pieces = [units.cut(raw, a, b + units.window) for a, b in zip(first.tolist(), last.tolist())]
                base = begins[of] if len(of) else of
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(pa.array(of)) for k in (1, 2, 0)], _longs(h), _longs(first - base), _longs(last - base), _longs(place - first), pa.array(pieces, pa.binary())], names
                )

    return texts.mapInArrow(run, _MEMBERS)


def _spans(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return [{"a": a, "b": b - 1} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


Compare = Callable[[np.ndarray, list[bytes], np.ndarray, np.ndarray], list[np.ndarray]]
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _compared(classes: DataFrame, compare: Compare, limit: int) -> DataFrame:
    """(c1, c2, spans) by ``compare(anchors, contexts, at, doc_ids)``, shard by shard."""
    dealt = classes.select("anchor", "c1", "c2", "at", "doc_id", "context").repartition("anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in _and_end(batches):
            if batch is not None:
                kept.append(batch)
                size += batch.column(5).nbytes
                if size < limit:
                    continue
            if not kept:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            of = table.column("anchor").to_numpy()
            whole = len(of) if batch is None else int(np.searchsorted(of, of[-1], side="left"))  # the last anchor may go on
            if whole:
                own = table.slice(0, whole)
                flags = compare(of[:whole], own.column("context").to_pylist(), own.column("at").to_numpy(), own.column("doc_id").to_numpy())
                some = np.array([f.any() for f in flags])
                spans = pa.array([_spans(f) for f, s in zip(flags, some) if s], _SPANS)
                rows = own.filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([rows.column(c).combine_chunks() for c in ("c1", "c2")] + [spans], ["c1", "c2", "spans"])
            rest = table.slice(whole)
            kept = rest.to_batches()
            size = rest.column("context").nbytes

    return dealt.mapInArrow(run, "c1 long, c2 long, spans array<struct<a:int,b:int>>")


def _split(classes: DataFrame, units: Units, size: int) -> DataFrame:
    """Members for the parts of ``size`` windows of classes, keyed by what a part's windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            rows = []
            for c1, c2, doc_id, anchor, at, context in zip(*(column.to_pylist() for column in batch.columns)):
                raw = units.raw(context)
                last = len(raw) - units.window
                for part in range(max(0, at - last) // size, at // size + 1):
                    a, b = max(0, at - (part + 1) * size + 1), min(last, at - part * size)
                    shared = units.cut(raw, at - part * size, at - (part + 1) * size + 1 + units.window)
                    key = xxh64_intdigest(shared, (anchor ^ part) & LAST) >> 1
                    rows.append((c1, c2, doc_id, key, a, b, at - a, units.cut(raw, a, b + units.window)))
            columns = list(zip(*rows)) or [()] * len(_MEMBER_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "context" else pa.int64()) for n, c in zip(_MEMBER_NAMES, columns)], _MEMBER_NAMES)

    return classes.select("c1", "c2", "doc_id", "anchor", "at", "context").mapInArrow(run, _MEMBERS)


def _resolved(members: DataFrame, units: Units, compare: Compare, earlier: bool, limit: int, hot: int, scratch: list[DataFrame], level: int = 0) -> DataFrame:
    """(p1, p2, spans) of the texts or classes whose contexts have repeated windows."""
    named = members.withColumn("c1", F.xxhash64("context", "at", "anchor")).withColumn("c2", F.xxhash64(F.lit(7), "context", "at", "anchor"))
    named = save(named, "contexts", scratch)
    classes = named.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.first("at").alias("at"), F.first("context").alias("context"))
    classes = save(classes, "context-classes", scratch)
    sizes = save(classes.groupBy("anchor").agg(F.count("*").alias("distinct")).filter("distinct > 1"), "anchor-sizes", scratch)
    sized = save(classes.join(sizes, "anchor"), "sized-classes", scratch)
    large = sized.filter((F.col("distinct") > hot) & F.lit(level < len(units.parts)))
    spans = _compared(sized.filter((F.col("distinct") <= hot) | F.lit(level == len(units.parts))), compare, limit)
    if level < len(units.parts) and not large.isEmpty():
        parts = _resolved(_split(large, units, units.parts[level]), units, compare, earlier, limit, hot, scratch, level + 1)
        spans = spans.unionByName(parts.select(F.col("p1").alias("c1"), F.col("p2").alias("c2"), "spans"))
    spans = save(spans, "class-spans", scratch)
    results = classes.select("c1", "c2", "n", F.col("doc_id").alias("least")).join(spans, ["c1", "c2"], "left").filter("n > 1 OR spans IS NOT NULL")
    results = save(results, "class-results", scratch)
    joined = named.select("p1", "p2", "doc_id", "first", "last", "c1", "c2").join(results, ["c1", "c2"])
    whole = F.array(F.struct(F.col("first").cast("int").alias("a"), F.col("last").cast("int").alias("b")))
    shifted = F.transform(F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")), lambda s: F.struct((s["a"] + F.col("first")).cast("int").alias("a"), (s["b"] + F.col("first")).cast("int").alias("b")))
    ranges = F.when(F.col("doc_id") > F.col("least") if earlier else F.col("n") > 1, whole).otherwise(shifted)
    # At most the windows of one text or class come together here: a row that was read in several tasks counts once.
    found = joined.select("p1", "p2", ranges.alias("own")).filter(F.size("own") > 0)
    return found.groupBy("p1", "p2").agg(F.flatten(F.collect_set("own")).alias("spans"))


def hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def repeated(docs: DataFrame, units: Units, compare: Compare, earlier: bool, limit: int, hot: int = HOT) -> DataFrame:
    """(t1, t2, first_id, copies, spans) of texts with repeats; ``docs`` has doc_id and text.

    ``spans`` are the starts of windows that occur elsewhere; with ``earlier``, of
    those that also occur under a smaller doc_id. A null doc_id comes after all.
    """
    small_batches(docs.sparkSession)
    scratch: list[DataFrame] = []
    texts = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), *hashes(F.col("text")), "text")
    anchored = save(_anchored(texts, units), "anchored", scratch)
    # Equal texts have equal anchors, so any row's will do.
    whole = save(anchored.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("anchors").alias("anchors")), "texts", scratch)
    own = whole.select("t1", "t2", "doc_id", "copies", F.explode("anchors").alias("anchor"))
    shared = save(own.groupBy("anchor").count().filter("count > 1").select("anchor"), "shared-anchors", scratch)
    per_text = own.join(shared, "anchor").groupBy("t1", "t2", "doc_id", "copies").agg(F.collect_set("anchor").alias("anchors"))  # a text's own
    chosen = texts.join(save(per_text, "anchors-per-text", scratch), ["t1", "t2", "doc_id"]).select("doc_id", "t1", "t2", "text", "anchors", "copies")
    found = _resolved(_contexts(chosen, units), units, compare, earlier, limit, hot, scratch)
    per_text = found.select(F.col("p1").alias("t1"), F.col("p2").alias("t2"), "spans")
    info = whole.drop("anchors").join(save(per_text, "text-spans", scratch), ["t1", "t2"], "left").filter("copies > 1 OR spans IS NOT NULL")
    repeats = save(info.withColumnRenamed("doc_id", "first_id"), "repeats")
    clear(scratch)
    return repeats


def covered(starts: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Disjoint, sorted (start, end) covered by the windows that start in the given inclusive ranges."""
    merged: list[list[int]] = []
    for a, b in sorted(starts):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b + window)
        else:
            merged.append([a, b + window])
    return [(a, b) for a, b in merged]


def with_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) with what ``repeated`` says of its text."""
    keyed = docs.select("*", *hashes(F.col("text")))
    return keyed.join(repeats, ["t1", "t2"], "left").select(*docs.columns, "first_id", "copies", "spans")
