"""Embedding near-dedup by random-hyperplane sign hashing.

Vectors that are equal within a label are first collapsed to one with a
multiplicity. Each is hashed in several tables: a table's key is the signs of the
vector's products with ``bits`` random planes. The number of bits grows with the
logarithm of the number of vectors, so buckets keep their size, and the number of
tables follows from it: a pair at the threshold itself meets in some table with
probability ``RECALL`` or more, closer pairs with a higher one.

What travels to the buckets is not the vector but its sketch, the signs of
``SKETCH`` further planes in 32 bytes. Vectors that share a label and a key in some
table are compared by sketch; those with a partner within ``FAR`` differing signs
(which a pair at the threshold exceeds with a probability of 0.00002) are candidates
in their bucket. Only candidates then bring their vectors there, once for each
bucket, and are compared by exact cosine in double precision.

A bucket of any size is compared whole: above ``BLOCK`` vectors it is cut into
blocks, and every two blocks meet in a task of their own. A pair that meets in
several tables is counted in the first. No pair leaves its task: a task returns
for each vector how many links it has there and one vector that it hangs
together with, and connected components join those. The nodes are the distinct
vectors, numbered here, so it does not matter how rows are named.

Defined cases: vectors that are null, empty, zero or have null or non-finite
components, or whose label is null, link with nothing and are their own
component. Vectors of different lengths do not link. Rows that repeat a vec_id
are vectors of their own, each with its own links and component. Rows without
vec_id link and are counted like others; their component_id is the smallest vec_id
they reach, null if there is none, and they are kept only then. An empty table gives
an empty result. Columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import contracted
from .durable import clear, save, small_batches
from .simhash import _and_end

THRESHOLD, RECALL, BLOCK, SEED = 0.93, 0.98, 1024, 20240229
SKETCH, DEVIATIONS = 256, 4.1


def shape(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = min(30, max(8, math.ceil(math.log2(max(n, 1) / 32))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-meet))


def far(threshold: float = THRESHOLD) -> int:
    """How many of the sketch's signs a pair at the threshold may differ in, but for chance."""
    apart = math.acos(threshold) / math.pi
    return math.ceil(SKETCH * apart + DEVIATIONS * math.sqrt(SKETCH * apart * (1 - apart)))


def planes(dim: int, count: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng([SEED, dim, seed]).standard_normal((dim, count))


def _signs(vectors: np.ndarray, bits: int, tables: int, made: dict[int, np.ndarray]) -> np.ndarray:
    """Each table's key of each vector."""
    dim = vectors.shape[1]
    if dim not in made:
        made[dim] = planes(dim, bits * tables)
    return ((vectors @ made[dim]).reshape(len(vectors), tables, bits) > 0) @ (1 << np.arange(bits, dtype=np.int64))


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors in double precision; None for the others."""
    found = []
    for cell in column:
        own = None if not cell.is_valid or cell.values.null_count else np.asarray(cell.values.to_numpy(zero_copy_only=False), np.float64)
        found.append(own if own is not None and len(own) and np.isfinite(own).all() and own.any() else None)
    return found


def _keyed(rows: DataFrame) -> DataFrame:
    """vec_id, label, and a digest of the vector (null: it links with nothing)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [None if v is None else hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() for v in _vectors(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["vec_id", "label", "embedding", "digest"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    keyed = rows.mapInArrow(run, f"vec_id long, label {types['label']}, embedding {types['embedding']}, digest binary")
    return keyed.withColumn("digest", F.when(F.col("label").isNotNull(), F.col("digest")))


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Adds ``dim``, ``signs`` (each table's key) and ``sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        others: dict[int, np.ndarray] = {}
        for batch in batches:
            own = _vectors(batch.column(batch.schema.get_field_index("embedding")))
            signs, sketches = [None] * len(own), [None] * len(own)
            lengths = np.array([len(v) for v in own])
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                vectors = np.stack([own[k] for k in at])
                if dim not in others:
                    others[dim] = planes(dim, SKETCH, 1)
                packed = np.packbits(vectors @ others[dim] > 0, axis=1)
                for k, g, p in zip(at.tolist(), _signs(vectors, bits, tables, made), packed):
                    signs[k], sketches[k] = g, p.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.int32()), pa.array(signs, pa.list_(pa.int32())), pa.array(sketches, pa.binary())], [*batch.schema.names, "dim", "signs", "sketch"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{fields}, dim int, signs array<int>, sketch binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Sorted rows as (table, starts, ends, key columns) of whole groups of two rows or more."""
    rest: pa.Table | None = None
    for batch in _and_end(batches):
        if batch is not None:
            fresh = pa.Table.from_batches([batch])
            rest = fresh if rest is None else pa.concat_tables([rest, fresh])
        if rest is None or not rest.num_rows:
            continue
        key = [rest.column(k).to_numpy() for k in range(keys)]
        starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])
        ends = np.r_[starts[1:], rest.num_rows]
        if batch is not None:
            starts, ends = starts[:-1], ends[:-1]
        done = int(ends[-1]) if len(ends) else 0
        several = ends - starts > 1
        if several.any():
            yield rest.slice(0, done).combine_chunks(), starts[several], ends[several], key
        rest = rest.slice(done)


def _near(sketches: np.ndarray, own: np.ndarray, crossing: bool, most: int) -> np.ndarray:
    """Which sketches (rows of 64-bit words) have a partner within ``most`` signs; of two blocks, in the other."""
    found = np.zeros(len(sketches), bool)
    for at in range(0, len(sketches), 128):
        rows = sketches[at : at + 128]
        differ = np.zeros((len(rows), len(sketches)), np.uint16)
        for word in range(sketches.shape[1]):
            differ += np.bitwise_count(rows[:, word, None] ^ sketches[None, :, word])
        close = differ <= most
        close[np.arange(len(rows)), np.arange(at, at + len(rows))] = False
        if crossing:
            close &= own[at : at + 128, None] != own[None, :]
        found[at : at + 128] = close.any(axis=1)
    return found


def _compare(ids, weights, table, vectors, own_block, crossing, threshold, signs):
    """(ids, roots, links) of the vectors of one pair of blocks that link there."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links, roots = np.zeros(len(ids), np.int64), np.arange(len(ids))
    close = unit @ unit.T >= threshold
    np.fill_diagonal(close, False)
    if crossing:
        close &= own_block[:, None] != own_block[None, :]
    linked = close.any(axis=1)
    if not linked.any():
        return ids[linked], ids[linked], links[linked]
    keys = signs(vectors) if table else None
    for at in range(0, len(ids), 64):
        i, j = np.nonzero(close[at : at + 64])
        i = i + at
        first = ~(keys[i, :table] == keys[j, :table]).any(axis=1) if table else np.ones(len(i), bool)
        np.add.at(links, i[first], weights[j[first]])
    while True:
        lowest = np.where(close, roots[None, :], len(ids)).min(axis=1)
        after = np.minimum(roots, lowest)
        after = after[after]
        if (after == roots).all():
            break
        roots = after
    return ids[linked], ids[roots[linked]], links[linked]


_KEYS = ["label", "dim", "table", "key", "b1", "b2"]


def near_links(signed: DataFrame, bits: int, tables: int, threshold: float = THRESHOLD, block: int = BLOCK, *, scratch: list[DataFrame] | None = None) -> DataFrame:
    """(id, root, links): per task what each vector links with; sums and components make the whole."""
    entries = signed.select("label", "dim", F.posexplode("signs").alias("table", "key"), "id")
    sizes = save(entries.groupBy("label", "dim", "table", "key").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes", scratch)
    sketched = signed.select("label", "dim", F.posexplode("signs").alias("table", "key"), "id", "sketch")
    several = sketched.join(sizes, ["label", "dim", "table", "key"])
    dealt = (
        several.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "dim", "table", "key", F.least("own", "with").alias("b1"), F.greatest("own", "with").alias("b2"), "own", "id", "sketch")
    )
    dealt = dealt.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    most = far(threshold)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends, key in _groups(batches, len(_KEYS)):
            own = table.column("own").to_numpy()
            words = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u8").reshape(len(own), -1)
            found = np.zeros(len(own), bool)
            for s, e in zip(starts.tolist(), ends.tolist()):
                found[s:e] = _near(words[s:e], own[s:e], key[4][s] != key[5][s], most)
            yield from table.drop_columns(["sketch"]).filter(pa.array(found)).to_batches()

    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    candidates = dealt.mapInArrow(chosen, ", ".join(f"{c} {types[c]}" for c in (*_KEYS, "own", "id")))
    candidates = save(candidates, "candidates", scratch)
    whole = candidates.join(signed.select("id", "weight", "embedding"), "id").select(*_KEYS, "own", "id", "weight", "embedding").repartition(*_KEYS).sortWithinPartitions(*_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for table, starts, ends, key in _groups(batches, len(_KEYS)):
            own, ids, weights = (table.column(c).to_numpy() for c in ("own", "id", "weight"))
            vectors = table.column("embedding").combine_chunks()
            out: list[list] = [[], [], []]
            for s, e in zip(starts.tolist(), ends.tolist()):
                v = vectors.slice(s, e - s).flatten().to_numpy().astype(np.float64).reshape(e - s, -1)
                found = _compare(ids[s:e], weights[s:e], int(key[2][s]), v, own[s:e], key[4][s] != key[5][s], threshold, lambda x: _signs(x, bits, tables, made))
                for x, y in zip(out, found):
                    x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], ["id", "root", "links"])

    return whole.mapInArrow(run, "id long, root long, links long")


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row."""
    small_batches(vectors.sparkSession)
    scratch: list[DataFrame] = []
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    keyed = save(_keyed(rows), "keyed")
    usable = keyed.filter("digest IS NOT NULL")
    classes = usable.groupBy("label", "digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    bits, tables = shape(usable.count(), threshold, recall)
    signed = save(_signed(classes, bits, tables).withColumn("id", F.monotonically_increasing_id()), "signed", scratch)
    found = save(near_links(signed, bits, tables, threshold, scratch=scratch), "near-links", scratch)
    roots, _ = contracted(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    scratch.append(roots)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    whole = (
        signed.select("label", "digest", "id", "least", "weight")
        .join(links, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select("label", "digest", "least", F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"))
    )
    whole = save(whole, "vector-classes", scratch)
    named = save(whole.join(whole.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("label", "digest", "component_id", "n_links"), "named-vectors")
    clear(scratch)
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return keyed.select("vec_id", "label", "digest").join(named, ["label", "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
c AS (SELECT vec_id, vec_id AS least FROM embeddings UNION SELECT l.b, c.least FROM c JOIN l ON l.a = c.vec_id WHERE c.least < l.b),
m AS (SELECT vec_id, min(least) AS component_id FROM c GROUP BY vec_id),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, m.component_id, m.vec_id = m.component_id AS kept FROM m LEFT JOIN k ON k.a = m.vec_id
"""
