"""The vector index: built in parts, resumable, reusable.

An index folder holds one namespace per configuration, in it one folder per part
(``part_rows`` consecutive rows), and a progress document. A part counts as done
if it has as many rows as planned, each of the encoder's dimension; pending parts
are planned parts less done ones. Parts are written in waves with dynamic
partition overwrite, so a lost run costs one wave at most.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors
from . import images

INDEX_SCHEMA = "row_idx long, id string, embedding array<float>, part_id int"


class StageFailure(RuntimeError):
    """A named failure with the exit code that a command line would return."""

    def __init__(self, stage: str, message: str, code: int):
        super().__init__(f"[{stage}] {message}")
        self.stage, self.code = stage, code


def row_text() -> Column:
    """Content, else text; a row with neither raises."""
    return F.coalesce(F.nullif(F.col("content"), F.lit("")), F.nullif(F.col("text"), F.lit("")), F.raise_error(F.concat(F.lit("empty text in row "), F.col("id"))).cast("string"))


def out_of_memory(error: BaseException) -> bool:
    said = str(error).lower()
    return isinstance(error, MemoryError) or "out of memory" in said or "oom" in said


def encode_rows(encoder, texts: list[str] | None, pictures: list | None, batch: int, dim: int) -> tuple[list[list[float]], int]:
    """Vectors of all rows and the smallest batch used; a batch that does not fit is halved and tried again."""
    n = len(texts if texts is not None else pictures or [])
    at, size, out = 0, max(1, batch), []
    while at < n:
        own = slice(at, at + size)
        try:
            made = encoder.encode_documents(None if texts is None else texts[own], None if pictures is None else pictures[own])
        except Exception as e:
            if size > 1 and out_of_memory(e):
                size //= 2
                continue
            raise
        wanted = min(size, n - at)
        if made.shape != (wanted, dim):
            raise StageFailure("EMBED", f"encoder gave {made.shape} for {wanted} rows of {dim}", 2)
        out += made.tolist()
        at += wanted
    return out, size


def encode(articles: DataFrame, encoder, modality: str = "image_text", strategy: str = "primary", cell: int = 512, batch: int = 8) -> DataFrame:
    """(row_idx, id, embedding, part_id, batch) of articles that have ``part_id``; batch is the smallest that their task had to use."""
    dim = encoder.dim
    pictures = F.transform("images", lambda i: i["bytes"]) if modality != "text" else F.lit(None).cast("array<binary>")
    chosen = articles.select("row_idx", "id", row_text().alias("input"), pictures.alias("pictures"), F.col("part_id").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(2).to_pylist() if modality != "image" else None
            slots = [images.row_image(p or [], strategy, cell) for p in rows.column(3).to_pylist()] if modality != "text" else None
            made, used = encode_rows(encoder, texts, slots, batch, dim)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(made, pa.list_(pa.float32())), rows.column(4), pa.array([used] * rows.num_rows, pa.int32())], ["row_idx", "id", "embedding", "part_id", "batch"])

    return chosen.mapInArrow(run, INDEX_SCHEMA + ", batch int")


def effective_batch(spark: SparkSession, folder: str, batch: int) -> int:
    """The smallest batch that any part was encoded with."""
    return spark.read.schema(INDEX_SCHEMA + ", batch int").parquet(folder).agg(F.min("batch")).first()[0] or batch


def with_parts(rows: DataFrame, part_rows: int = 128) -> DataFrame:
    return rows.withColumn("part_id", F.floor(F.col("row_idx") / part_rows).cast("int"))


def part_plan(rows: DataFrame, part_rows: int = 128) -> DataFrame:
    """(part_id, first_row, rows) of every planned part."""
    return with_parts(rows, part_rows).groupBy("part_id").agg(F.min("row_idx").alias("first_row"), F.count("*").alias("rows"))


def pending(planned: DataFrame, done: DataFrame) -> DataFrame:
    """Planned parts of which no complete copy exists; both have (part_id, rows)."""
    return planned.join(done.select("part_id", "rows"), ["part_id", "rows"], "left_anti")


def head_sha(articles: DataFrame) -> DataFrame:
    """One row: 32 hex digits over the row count and the first and last id and content, each length-prefixed."""
    n = articles.agg(F.count("*").cast("string").alias("n"))
    ends = articles.agg(F.min_by(F.struct("id", "content"), "row_idx").alias("a"), F.max_by(F.struct("id", "content"), "row_idx").alias("z"))
    fields = [F.col("n"), *(F.coalesce(F.col(f"{e}.{c}"), F.lit("None")) for e in "az" for c in ("id", "content"))]
    prefixed = F.concat(*[x for f in fields for x in (F.octet_length(f).cast("string"), f)])
    return ends.crossJoin(n).select(F.substring(F.sha2(prefixed, 256), 1, 32).alias("sha"))


def config_key(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()


def _progress_path(path: str) -> str:
    return os.path.join(path, "_progress.json")


def read_progress(path: str) -> dict | None:
    """The progress document; None if there is none or it cannot be read."""
    try:
        with open(_progress_path(path), encoding="utf-8") as file:
            return json.load(file)
    except (OSError, ValueError):
        return None


def write_progress(path: str, document: dict) -> None:
    os.makedirs(path, exist_ok=True)
    with open(_progress_path(path) + ".tmp", "w", encoding="utf-8") as file:
        json.dump(document, file, indent=2, sort_keys=True)
        file.flush()
        os.fsync(file.fileno())
    os.replace(_progress_path(path) + ".tmp", _progress_path(path))


def _space(path: str, key: str) -> str:
    return os.path.join(path, f"parts-{key[:16]}")


def committed(spark: SparkSession, folder: str, dim: int) -> DataFrame:
    """(part_id, rows) on disk, counting rows of the right dimension."""
    if not os.path.isdir(folder) or not any(x.startswith("part_id=") for x in os.listdir(folder)):
        return spark.createDataFrame([], "part_id int, rows long")
    return spark.read.schema(INDEX_SCHEMA).parquet(folder).filter(F.size("embedding") == dim).groupBy("part_id").agg(F.count("*").alias("rows"))


def shape(index: DataFrame) -> tuple[int, int, int, bool]:
    """(rows, smallest dimension, largest dimension, all finite)."""
    row = index.agg(F.count("*").alias("n"), F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("z"), F.coalesce(F.bool_and(vectors.finite(F.col("embedding"))), F.lit(True)).alias("finite")).first()
    return row["n"], row["a"] or 0, row["z"] or 0, row["finite"]


def check(index: DataFrame, rows: int, dim: int) -> None:
    n, low, high, finite = shape(index)
    if n != rows or (rows and (low, high) != (dim, dim)):
        raise StageFailure("EMBED", f"index has {n} rows of {low}..{high}, expected {rows} of {dim}", 2)
    if not finite:
        raise StageFailure("EMBED", "index has non-finite values", 2)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    progress = read_progress(path)
    if not progress or progress["status"] != "finalized":
        raise StageFailure("EMBED", f"no finished index at {path}", 1)
    return spark.read.schema(INDEX_SCHEMA).parquet(_space(path, progress["config_key"]))


def build_or_resume(articles: DataFrame, encoder, path: str, part_rows: int = 128, modality: str = "image_text", strategy: str = "primary", cell: int = 512, batch: int = 8, force: bool = False, parts_per_wave: int = 1024, config: dict | None = None) -> dict:
    """Reuse a finished index of this configuration, resume a partial one, or build; returns loop stats."""
    spark, began = articles.sparkSession, time.perf_counter()
    rows = articles.count()
    settings = {"modality": modality, "multi_image": strategy, "image_cell": cell, "batch_size": batch, "part_rows": part_rows, "num_rows": rows, "expected_dim": encoder.dim, "dataset_head_sha": head_sha(articles).first()["sha"], **(config or {})}
    key = config_key(settings)
    progress = read_progress(path)
    if force and os.path.isdir(path):
        shutil.rmtree(path)
        progress = None
    folder = _space(path, key)
    result = {"reused_existing": False, "resumed_parts": 0, "num_rows": rows, "dim": encoder.dim, "dtype": "float32", "wall_seconds": None, "embed_file": folder}
    if progress and progress["config_key"] == key and progress["status"] == "finalized":
        check(open_index(spark, path), rows, encoder.dim)
        return result | {"reused_existing": True, "bytes": _bytes(folder)}
    encoder.ensure()
    if progress and progress["config_key"] != key:
        shutil.rmtree(_space(path, progress["config_key"]), ignore_errors=True)
    parts = with_parts(articles, part_rows)
    todo = [r["part_id"] for r in pending(part_plan(articles, part_rows), committed(spark, folder, encoder.dim)).orderBy("part_id").toLocalIterator()]
    total = -(-rows // part_rows)
    done = total - len(todo)
    document = {"config_key": key, "embed_file": folder, "modality": modality, "multi_image": strategy, "batch_size": batch, "part_rows": part_rows, "num_rows": rows, "completed_parts": done, "status": "partial", "model_path": type(encoder).__name__, "model_revision": None, "started_utc": _now()}
    write_progress(path, document)
    for at in range(0, len(todo), parts_per_wave):
        wave = todo[at : at + parts_per_wave]
        # A range of row numbers is what a Parquet reader can skip row groups by.
        near = parts.filter(F.col("row_idx").between(wave[0] * part_rows, (wave[-1] + 1) * part_rows - 1))
        chosen = near.filter(F.col("part_id").isin(wave)).repartition("part_id").sortWithinPartitions("row_idx")
        made = encode(chosen, encoder, modality, strategy, cell, batch)
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part_id").parquet(folder)
        document["completed_parts"] = done + at + len(wave)
        write_progress(path, document)
    if rows:
        check(spark.read.schema(INDEX_SCHEMA).parquet(folder), rows, encoder.dim)
    wall = round(time.perf_counter() - began, 1)
    write_progress(path, document | {"status": "finalized", "finished_utc": _now(), "wall_seconds": wall})
    least = effective_batch(spark, folder, batch) if rows else batch
    return result | {"resumed_parts": done, "wall_seconds": wall, "bytes": _bytes(folder), "effective_batch": least, "oom_halvings": max(0, (max(1, batch) // least).bit_length() - 1)}


def _now() -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())


def _bytes(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)
