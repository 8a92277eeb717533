"""SimHash near-dedup with BK-trees over shards of bounded size.

A document's fingerprint has a bit set where more than half of its shingles'
hashes have it set. Equal fingerprints are first collapsed. The distinct ones are
dealt to shards so that no link is lost: the 64 bits are cut into ``radius`` + 6
blocks, and two fingerprints within ``radius`` bits agree on some choice of six
blocks. A shard is one such choice together with its bits, so it holds at most
2 ** (64 - kept bits) distinct fingerprints (65,536 at radius 2) however large
the corpus is, and far fewer in practice. In each shard a BK-tree (children keyed
by their integer Hamming distance to the parent) is built and searched, following
only edges within the radius of the query's distance. A tree yields a spanning
forest of its links; distributed connected components join the forests.

The trees are not broadcast: a tree over all fingerprints has no size bound, and
at 64 bits its search would visit a growing share of it. Sharding by agreeing
blocks gives each tree only fingerprints that can matter.

Fingerprints, not documents, are the nodes of the graph, so it does not matter how
rows are named: the component of a row is that of its fingerprint, and its id is
the smallest doc_id found in it.

Defined cases: a null text has no words; documents without words get fingerprint
zero, which links like any other. Rows that repeat a doc_id are documents of their
own, in the components of their own texts. Rows without doc_id link like others and
get the component's smallest doc_id, null if no row of it has one; they are kept only
then. An empty table gives an empty result. Columns other than the two named are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import contracted
from .durable import clear, drop, save, small_batches

WORDS, RADIUS, SEED, KEPT = 3, 2, 42, 6


def shingle_hashes(text: str | None, words: int = WORDS) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles in order, repeats included, some thousands at a time."""
    from xxhash import xxh64_intdigest

    own = (text or "").encode().lower().split()  # of bytes: A-Z, and white space 20 and 09-0D
    if not own:
        return
    joined = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    n = max(1, len(own) - words + 1)
    first = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[min(words, len(own)) - 1 :].tolist()
    for at in range(0, n, 8192):
        yield np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first[at : at + 8192], last[at : at + 8192])], "<u8")


def folded(hashes: Iterator[np.ndarray]) -> int:
    """The unsigned 64-bit SimHash of some hashes; zero of none."""
    ones, n = np.zeros(64, np.int64), 0
    for own in hashes:
        ones += np.unpackbits(own.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(own)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    return folded(shingle_hashes(text, words))


class BKTree:
    """Distinct integers under Hamming distance."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        at = self.root
        while True:
            d = (at[0] ^ value).bit_count()
            if d not in at[1]:
                at[1][d] = (value, {})
                return
            at = at[1][d]

    def near(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                found.append(own)
            if children:
                todo += [child for k, child in children.items() if d - radius <= k <= d + radius]
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Indexes (i, j) of links that connect what links within ``radius`` connect."""
    tree, at, root = BKTree(), {v: k for k, v in enumerate(values)}, list(range(len(values)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links = []
    for k, value in enumerate(values):
        for other in tree.near(value, radius):
            a, b = top(k), top(at[other])
            if a != b:
                root[a] = b
                links.append((k, at[other]))
        tree.add(value)
    return links


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp): fp holds the unsigned fingerprint's bits as a long."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    return chosen.mapInArrow(run, "doc_id long, fp long")


def masks(radius: int = RADIUS, kept: int = KEPT) -> list[int]:
    """Signed masks of every choice of ``kept`` among radius + kept blocks of the 64 bits."""
    edges = np.linspace(0, 64, radius + kept + 1).astype(int).tolist()
    blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    found = [sum(c) for c in combinations(blocks, kept)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column ``fp`` that connect all within ``radius`` bits."""
    chosen = masks(radius)
    shards = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(chosen)])).alias("s"))
    dealt = shards.select("s.choice", "s.bits", "fp").repartition("choice", "bits").sortWithinPartitions("choice", "bits", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in _and_end(batches):
            if batch is not None:
                own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
                kept = own if kept is None else [np.concatenate(x) for x in zip(kept, own)]
            if kept is None or not len(kept[0]):
                continue
            starts = np.flatnonzero(np.r_[True, (kept[0][1:] != kept[0][:-1]) | (kept[1][1:] != kept[1][:-1])])
            ends = np.r_[starts[1:], len(kept[0])]
            if batch is not None:  # the last shard may go on in the next batch
                starts, ends, rest = starts[:-1], ends[:-1], starts[-1]
            else:
                rest = len(kept[0])
            several = np.flatnonzero(ends - starts > 1)
            a, b = [], []
            for s, e in zip(starts[several].tolist(), ends[several].tolist()):
                own = kept[2][s:e]
                for i, j in forest(own.view(np.uint64).tolist(), radius):
                    a.append(int(own[i]))
                    b.append(int(own[j]))
            kept = [x[rest:] for x in kept]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    pa.default_memory_pool().release_unused()
    yield None


def fingerprint_roots(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) of the distinct fingerprints of ``distinct``; a root is some fingerprint of the component."""
    roots, _ = contracted(links(distinct, radius))
    return distinct.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept): one row per input row."""
    scratch: list[DataFrame] = []
    own = save(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = save(own.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints", scratch)
    rooted = save(distinct.join(fingerprint_roots(distinct, radius), "fp"), "rooted-fingerprints", scratch)
    least = save(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "fingerprint-components", scratch)
    classes = save(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-classes")
    clear(scratch)
    return own.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# Similar texts: links by shingle similarity, which few differing bits alone do not find.

SIMILARITY, SIMILAR_WORDS, KEYS, BLOCK, PIVOTS = 0.8, 5, 5, 1024, 16


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, keys: int = KEYS) -> DataFrame:
    """What one reading of the texts gives, a row per input row.

    doc_id, text_sha256, close (the fingerprint of ``near_dedup``), and of the set of
    ``words``-word shingles: keys (min-hashes), digest, shingles (sorted 32-bit hashes).
    """
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"), text.alias("text"))
    seeds = np.random.default_rng(SEED).integers(0, 1 << 63, keys, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close, least, digests, sets = [], [], [], []
            for cell in batch.column(2):
                text = cell.as_py()
                close.append(fingerprint(text))
                parts = list(shingle_hashes(text, words))
                own = np.unique(np.concatenate(parts)) if parts else np.array([], np.uint64)
                mixed = [(own ^ s) * np.uint64(0x9E3779B97F4A7C15) for s in seeds] if parts else []
                least.append([int((m ^ (m >> np.uint64(32))).min().view(np.int64)) for m in mixed])
                sets.append(np.unique(own.astype("<u4")).tobytes())
                digests.append(blake2b(sets[-1], digest_size=16).digest())
            signed = pa.array(np.array(close, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], signed, pa.array(least, pa.list_(pa.int64())), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["doc_id", "text_sha256", "close", "keys", "digest", "shingles"])
        pa.default_memory_pool().release_unused()

    return chosen.mapInArrow(run, "doc_id long, text_sha256 string, close long, keys array<long>, digest binary, shingles binary")


class Postings:
    """Which of some sets hold each value, for exact sizes of intersections."""

    def __init__(self, sets: list[np.ndarray]):
        self.lengths = np.array([len(x) for x in sets])
        _, value = np.unique(np.concatenate(sets), return_inverse=True)
        times = np.bincount(value)
        shared = times[value] > 1
        owner = np.repeat(np.arange(len(sets)), self.lengths)[shared]
        value = value[shared]
        self.counts = np.where(times > 1, times, 0)
        self.starts = np.r_[0, np.cumsum(self.counts)[:-1]]
        self.owners = owner[np.argsort(value, kind="stable")]
        self.own = np.split(value, np.searchsorted(owner, np.arange(1, len(sets))))

    def common(self, k: int, step: int = 4096) -> np.ndarray:
        """How many values set ``k`` shares with each other set."""
        found = np.zeros(len(self.lengths), np.int64)
        for at in range(0, len(self.own[k]), step):
            value = self.own[k][at : at + step]
            n = self.counts[value]
            places = np.repeat(self.starts[value] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found += np.bincount(self.owners[places], minlength=len(found))
        return found


def _joined(ids: np.ndarray, sets: list[np.ndarray], own: np.ndarray, similarity: float = SIMILARITY, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between a task's texts that connect what similar ones connect; of two blocks (``own``), only across.

    Texts of one label are known to be connected. Every pair's similarity is exact, by
    the sizes of all intersections with a text at once.
    """
    tops = np.unique(ids if labels is None else labels, return_inverse=True)[1]
    crossing = (own != own[0]).any()
    within, links, postings = own == own.min(), [], Postings(sets)
    lengths, place = postings.lengths, np.arange(len(ids))
    for k in np.flatnonzero(~within).tolist() if crossing else range(1, len(ids)):
        others = (within if crossing else place < k) & (tops != tops[k])
        if not others.any():
            continue
        both = postings.common(k)
        for other in np.flatnonzero(others & (both > 0) & (both >= similarity * (lengths + lengths[k] - both))).tolist():
            if tops[other] != tops[k]:
                tops[tops == tops[other]] = tops[k]
                links.append((int(ids[k]), int(ids[other])))
    return links


_GROUP = ["table", "key", "b1", "b2"]


def _verified(dealt: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) within the groups of (table, key, b1, b2, own, label, id): all pairs, or across where ``own`` has two values.

    Ids come with whole sets only here, once for each group that holds them.
    """
    whole = dealt.join(sets, "id").select(*_GROUP, "own", "label", "id", "shingles").repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in _and_end(batches):
            if batch is not None:
                fresh = pa.Table.from_batches([batch])
                rest = fresh if rest is None else pa.concat_tables([rest, fresh])
            if rest is None or not rest.num_rows:
                continue
            key = [rest.column(k).to_numpy() for k in range(4)]
            starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])
            ends = np.r_[starts[1:], rest.num_rows]
            if batch is not None:
                starts, ends = starts[:-1], ends[:-1]
            found = []
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s > 1:
                    group = rest.slice(s, e - s)
                    own, labels, ids = (group.column(c).to_numpy() for c in ("own", "label", "id"))
                    if (labels == labels[0]).all():
                        continue
                    found += _joined(ids, [np.frombuffer(x, "<u4") for x in group.column("shingles").to_pylist()], own, similarity, labels)
            rest = rest.slice(int(ends[-1]) if len(ends) else 0)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return whole.mapInArrow(run, "a long, b long")


def similar_links(chosen: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, *, scratch: list[DataFrame] | None = None) -> DataFrame:
    """Links (a, b) that connect similar texts among ``chosen`` (id, keys), whose ``sets`` are (id, shingles).

    Texts of similarity 0.8 share a min-hash key with probability 0.9997 at five
    keys. The texts of a key are compared on their whole shingle sets; no similar texts
    of a key are missed.

    A key of more than ``block`` texts is dealt to blocks. Their texts are first
    compared with ``PIVOTS`` of their own; the links so far are contracted, and what is
    still apart from the key's largest component meets every block, two blocks to a
    task. Near copies of one text are so linked in linear work, and nothing is dropped.
    Sets are joined to small keys and pivots in one go, and once more to what is apart.
    """
    entries = chosen.select("id", F.posexplode("keys").alias("table", "key"))
    sizes = save(entries.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1"), "key-sizes", scratch)
    several = save(entries.join(sizes, ["table", "key"]), "shared-keys", scratch)
    alone = several.filter(F.col("n") <= block).select("table", "key", F.lit(0).alias("b1"), F.lit(0).alias("b2"), F.lit(0).alias("own"), F.col("id").alias("label"), "id")
    hot = several.filter(F.col("n") > block)
    blocks = F.ceil(F.col("n") / block).cast("int")
    place = F.xxhash64("id", F.lit(1))
    pivots = hot.groupBy("table", "key", "n", F.pmod(F.xxhash64("id"), F.lit(PIVOTS))).agg(F.min("id").alias("id"))
    first = hot.select("table", "key", F.lit(-1).alias("b1"), F.pmod(place, blocks).cast("int").alias("b2"), F.lit(1).alias("own"), F.col("id").alias("label"), "id").unionByName(
        pivots.select("table", "key", F.lit(-1).alias("b1"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b2"), F.lit(0).alias("own"), F.col("id").alias("label"), "id")
    )
    # Both at once, hot keys or none: all sets move once for them, by the same plan at every size.
    found = save(_verified(alone.unionByName(first), sets, similarity), "similar-links", scratch)
    if hot.isEmpty():
        return found

    roots, _ = contracted(found)
    scratch.append(roots) if scratch is not None else None
    labelled = save(hot.join(roots.withColumnRenamed("node", "id"), "id", "left").select("table", "key", "id", F.coalesce("root", "id").alias("label")), "labelled", scratch)
    per_label = labelled.groupBy("table", "key", "label").agg(F.count("*").alias("n"))
    main = per_label.groupBy("table", "key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n")).filter("n > most")
    apart = save(labelled.join(save(main, "main-components", scratch), ["table", "key"]), "apart", scratch)
    few, many = F.ceil((F.col("n") - F.col("most")) / block).cast("int"), F.ceil(F.col("most") / block).cast("int")
    outside = F.col("label") != F.col("main")
    own = F.when(outside, F.pmod(place, few)).otherwise(few + F.pmod(place, many)).cast("int")
    across = (
        apart.withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.when(outside, few + many).otherwise(few) - 1)))
        .select("table", "key", F.least("own", "with").alias("b1"), F.greatest("own", "with").alias("b2"), "own", "label", "id")
    )
    return found.unionByName(save(_verified(across, sets, similarity), "crossing-links", scratch))


def similar_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_sha256, component_id, kept): texts linked by nearly equal fingerprints or by shingle similarity.

    One row per input row; text_sha256 tells the rows of a repeated doc_id apart. The
    nodes are rows, one for each shingle set, so repeated or missing doc_ids merge
    nothing. Rows without doc_id link like others and are always kept; the other
    defined cases are those above.
    """
    scratch: list[DataFrame] = []
    own = save(sketches(docs, id_col, text_col, words).withColumn("row", F.monotonically_increasing_id()), "sketches", scratch)
    first = save(own.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("id")), "first-sketches", scratch)
    noded = save(own.select("doc_id", "text_sha256", "close", "digest").join(first, "digest"), "noded", scratch)
    named = own.join(first.select(F.col("node").alias("row")), "row", "left_semi")
    links = similar_links(named.select(F.col("row").alias("id"), "keys"), own.select(F.col("row").alias("id"), "shingles"), similarity=similarity, scratch=scratch)
    pairs = save(noded.select("close", "node").distinct(), "close-pairs", scratch)
    rooted = save(pairs.join(fingerprint_roots(pairs.select(F.col("close").alias("fp")).distinct()).withColumnRenamed("fp", "close"), "close"), "close-roots", scratch)
    least = save(rooted.groupBy("root").agg(F.min("node").alias("b")), "close-components", scratch)
    close = rooted.join(least, "root").select(F.col("node").alias("a"), "b")
    roots, _ = contracted(links.unionByName(close))
    classes = first.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "id")
    classes = save(classes, "similar-classes", scratch)
    named_classes = classes.join(classes.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("node", "component_id")
    joined = noded.join(save(named_classes, "named-classes", scratch), "node")
    result = save(joined.select("doc_id", "text_sha256", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "similar")
    drop(roots)
    clear(scratch)
    return result


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "fingerprint", "component_id")
