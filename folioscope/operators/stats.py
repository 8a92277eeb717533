"""Counters and histograms over article-shaped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_histogram(rows: DataFrame, n: Column) -> DataFrame:
    """(n, rows) by the number of items in a row, ascending."""
    return rows.groupBy(n.cast("long").alias("n")).agg(F.count("*").alias("rows")).orderBy("n")


def binned_histogram(rows: DataFrame, n: Column) -> DataFrame:
    """(bin, rows) for 0, 1, 2, 3 and 4+, empty bins included."""
    names = ("0", "1", "2", "3", "4+")
    bins = rows.sparkSession.createDataFrame([(b,) for b in names], "bin string")
    counted = rows.groupBy(F.when(n >= 4, "4+").otherwise(n.cast("string")).alias("bin")).agg(F.count("*").alias("rows"))
    return bins.join(counted, "bin", "left").select("bin", F.coalesce("rows", F.lit(0)).alias("rows")).orderBy("bin")


def image_counts(rows: DataFrame, n: Column) -> DataFrame:
    """One row: rows, total, most, with_images, text_only."""
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total"), F.coalesce(F.max(n), F.lit(0)).cast("long").alias("most"), F.count_if(n > 0).alias("with_images"), F.count_if(n == 0).alias("text_only"))


def duplicate_ids(rows: DataFrame, id_: str = "id") -> DataFrame:
    return rows.agg((F.count("*") - F.count_distinct(id_)).alias("duplicates"))


def content_lengths(rows: DataFrame, content: Column, short: int = 40) -> DataFrame:
    """One row: how many contents are empty, and how many shorter than ``short``."""
    n = F.coalesce(F.char_length(content), F.lit(0))
    return rows.agg(F.count_if(n == 0).alias("empty_rows"), F.count_if((n > 0) & (n < short)).alias("short_rows"))


def first_rows(rows: DataFrame, which: Column, n: int = 5) -> DataFrame:
    """(row_idx, id) of the first ``n`` rows that satisfy ``which``."""
    return rows.filter(which).select("row_idx", "id").orderBy("row_idx").limit(n)


def compact_histogram(histogram: dict[int, int]) -> str:
    """The first four counts and the last, for a report line."""
    shown = ", ".join(f"{k}: {v}" for k, v in sorted(histogram.items())[:4])
    return shown + (f", ... {max(histogram)}: {histogram[max(histogram)]}" if len(histogram) > 4 else "")


def counters(build) -> dict:
    """The first stage's counters from a Build; every one from an aggregate."""
    articles, every_ref = build.articles, build.references
    n = F.size("images")
    whole = image_counts(articles, n).first()
    failed = build.failed.count()
    error = F.coalesce("reason", "error")
    by_error = {r["kind"]: r["n"] for r in every_ref.filter(error.isNotNull()).groupBy(F.regexp_extract(error, "^[^:]*", 0).alias("kind")).agg(F.count("*").alias("n")).collect()}
    decoded = every_ref.filter("png IS NOT NULL").select("abs_path", "multi", "down").distinct().agg(F.count("*").alias("files"), F.count_if("multi").alias("multi"), F.count_if("down").alias("down")).first()
    gif_failed = every_ref.filter("error IS NOT NULL AND lower(abs_path) LIKE '%.gif'").count()
    return {
        "articles_total": whole["rows"] + failed,
        "converted": whole["rows"],
        "failed": failed,
        "rows_with_images": whole["with_images"],
        "text_only_rows": whole["text_only"],
        "resolved_local_image_refs": whole["total"],
        "unique_image_files_embedded": decoded["files"],
        "missing_refs_dropped": by_error.get("missing", 0),
        "corrupt_images_dropped": by_error.get("corrupt", 0),
        "not_file_dropped": by_error.get("not-file", 0),
        "unsupported_ext_dropped": by_error.get("unsupported-ext", 0),
        "gif_flattened": decoded["multi"],
        "gif_flattened_failed": gif_failed,
        "images_downscaled": decoded["down"],
        "max_images_in_one_article": whole["most"],
        "warn_empty_content": {r["id"]: r["reason"] for r in build.flagged.collect()},
        "histogram": {r["n"]: r["rows"] for r in exact_histogram(articles, n).collect()},
    }
