"""Stable article ids from relative paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def base_id(rel: Column) -> Column:
    """The folder path of an article; ``root`` for the top one."""
    steps = F.filter(F.split(rel, "/"), lambda s: s != "")
    folder = F.when(F.element_at(steps, -1) == "index.mdx", F.slice(steps, F.lit(1), F.size(steps) - 1)).otherwise(steps)
    return F.coalesce(F.nullif(F.array_join(folder, "/"), F.lit("")), F.lit("root"))


def with_suffix(base: Column, rel: Column) -> Column:
    return F.concat(base, F.lit("#"), F.substring(F.sha1(rel), 1, 8))


def with_ids(articles: DataFrame, rel: str = "rel_path", base: Column | None = None) -> DataFrame:
    """Adds ``base`` and ``id``: the base for the first path in order, with a hash for later ones.

    Paths are unique. The first one of a base is a minimum, which is made before any row
    is moved, so a base with very many paths is no hot group.
    """
    named = articles.withColumn("base", base_id(F.col(rel)) if base is None else base)
    first = named.groupBy(F.col("base").alias("_base")).agg(F.min(rel).alias("_first"))
    joined = named.join(first, F.col("base").eqNullSafe(F.col("_base")))
    return joined.withColumn("id", F.when(F.col(rel) == F.col("_first"), F.col("base")).otherwise(with_suffix(F.col("base"), F.col(rel)))).drop("_base", "_first")


def dense(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` with ``row_idx`` less the number of ``dropped`` (row_idx) before it.

    Drops are counted per block of row numbers; only blocks, one for 4,096 rows, are put
    in one order.
    """
    block = F.floor(F.col("row_idx") / 4096)
    gone = dropped.select("row_idx", block.alias("block")).groupBy("block").agg(F.array_sort(F.collect_list("row_idx")).alias("gone"))  # at most 4,096
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.select(block.alias("block")).distinct().join(gone, "block", "full")
    counted = blocks.select("block", "gone", F.coalesce(F.sum(F.greatest(F.size("gone"), F.lit(0))).over(earlier), F.lit(0)).alias("before"))
    within = F.size(F.filter(F.coalesce("gone", F.array().cast("array<bigint>")), lambda g: g < F.col("row_idx")))
    return rows.withColumn("block", block).join(counted, "block").withColumn("row_idx", F.col("row_idx") - F.col("before") - within).select(rows.columns)
