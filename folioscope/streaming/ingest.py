"""Articles that land over time, encoded into an index as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index
from ..sources.tables import ARTICLE_SCHEMA


def stream_articles(spark: SparkSession, landing: str) -> DataFrame:
    """A stream of the article shards that appear in a folder."""
    return spark.readStream.schema(ARTICLE_SCHEMA).parquet(landing)


def stream_into_index(articles: DataFrame, encoder, out: str, checkpoint: str, part_rows: int = 128, modality: str = "text"):
    """Start a query that appends each batch's vectors; a batch that is run again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        made = index.encode(index.with_parts(batch, part_rows), encoder, modality).withColumn("batch", F.lit(number))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
