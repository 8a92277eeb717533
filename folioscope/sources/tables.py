"""Article tables on disk: scans, shards and the card beside them."""

from __future__ import annotations

import os
import re
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_SCHEMA = (
    "row_idx long, id string, title string, source_path string, text string, content string, "
    "image_refs array<string>, images array<struct<bytes:binary,path:string>>, metadata string"
)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARTICLE_SCHEMA).parquet(path)


def corpus_view(articles: DataFrame) -> DataFrame:
    """Columns needed to show results, never images; absent ones get their fallbacks."""
    have = set(articles.columns)
    row = F.col("row_idx") if "row_idx" in have else F.monotonically_increasing_id()
    id_ = F.col("id") if "id" in have else F.concat(F.lit("row-"), row.cast("string"))
    content = F.col("content") if "content" in have else F.col("text") if "text" in have else F.lit("")
    return articles.select(
        row.alias("row_idx"),
        id_.alias("id"),
        (F.col("title") if "title" in have else F.lit(None).cast("string")).alias("title"),
        F.coalesce(content, F.lit("")).alias("content"),
        (F.col("source_path") if "source_path" in have else id_).alias("source_path"),
        (F.col("image_refs") if "image_refs" in have else F.array().cast("array<string>")).alias("image_refs"),
    )


def shard_plan(rows: DataFrame, shard_rows: int = 256) -> DataFrame:
    """(shard, first_row, rows): what ``write_shards`` writes."""
    shard = F.floor(F.col("row_idx") / shard_rows)
    return rows.groupBy(shard.alias("shard")).agg(F.min("row_idx").alias("first_row"), F.count("*").alias("rows")).orderBy("shard")


def write_shards(articles: DataFrame, out: str, shard_rows: int = 256) -> list[str]:
    """Shards of consecutive rows named ``train-%05d-of-%05d.parquet``, old ones replaced.

    Rows are dealt by shard number, so writing is parallel and each shard is one
    file; rows within it are sorted. An empty table is an error.
    """
    last = articles.agg(F.max("row_idx")).first()[0]
    if last is None:
        raise ValueError("no rows to write")
    total = last // shard_rows + 1
    staging = os.path.join(out, "_staging")
    shutil.rmtree(staging, ignore_errors=True)
    numbered = articles.withColumn("shard", F.floor(F.col("row_idx") / shard_rows).cast("int"))
    numbered.repartition("shard").sortWithinPartitions("shard", "row_idx").write.partitionBy("shard").parquet(staging)
    written = []
    for folder in os.listdir(staging):
        if number := re.fullmatch(r"shard=(\d+)", folder):
            part = next(x for x in os.listdir(os.path.join(staging, folder)) if x.endswith(".parquet"))
            path = os.path.join(out, f"train-{int(number[1]):05d}-of-{total:05d}.parquet")
            os.replace(os.path.join(staging, folder, part), path)
            written.append(path)
    for name in os.listdir(out):  # only now is nothing lost
        path = os.path.join(out, name)
        if path not in written and (name.endswith(".parquet") or name == "dataset_info.json"):
            os.remove(path)
    shutil.rmtree(staging)
    write_card(out)
    return sorted(written)


def write_card(out: str) -> None:
    """A short README beside the shards: how to load them and what the columns are."""
    columns = "\n".join(f"| {f.name} | {f.dataType.simpleString()} |" for f in T.StructType.fromDDL(ARTICLE_SCHEMA))
    with open(os.path.join(out, "README.md"), "w", encoding="utf-8") as card:
        card.write(f"# Articles\n\nOne row per article, split `train`, ordered by `row_idx`.\n\n    spark.read.parquet(\"{out}\")\n\n| column | type |\n|---|---|\n{columns}\n\n`images` and `image_refs` are aligned and never null.\n")
