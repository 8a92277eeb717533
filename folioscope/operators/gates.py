"""Quality gates: each returns a DataFrame of violations, empty if it passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import images, stats

LARGE = 30
_COLUMNS = ("rule", "row_idx", "id", "pos", "message")


def _violations(rows: DataFrame, rule: str, broken: Column, message: Column | str) -> DataFrame:
    said = F.lit(message) if isinstance(message, str) else message
    return rows.filter(broken).select(F.lit(rule).alias("rule"), "row_idx", "id", F.lit(None).cast("int").alias("pos"), said.alias("message"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def without_flag(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows whose id is not flagged."""
    return rows.join(flagged.select("id"), "id", "left_anti")


def content_rule(articles: DataFrame, flagged: DataFrame) -> DataFrame:
    blank = articles.filter(F.coalesce(text.strip(F.col("content")), F.lit("")) == "")
    return _violations(without_flag(blank.select("row_idx", "id"), flagged), "C1", F.lit(True), "empty content without a flag")


def list_rule(articles: DataFrame) -> DataFrame:
    return _union([_violations(articles, "C2", F.col("images").isNull(), "images is null"), _violations(articles, "C4", F.col("image_refs").isNull(), "image_refs is null")])


def round_trip_rule(articles: DataFrame) -> DataFrame:
    """Lists come back from storage as they went in: text is a string, an empty list is a list, and no image of a list is null."""
    gone = F.coalesce(F.exists("images", lambda i: i.isNull() | (i["bytes"].isNull() & i["path"].isNull())), F.lit(False))
    return _union([_violations(articles, "C1", F.col("content").isNull(), "content is null"), _violations(articles, "C2", gone, "a null in images")])


def alignment_rule(articles: DataFrame) -> DataFrame:
    a, b = F.coalesce(F.size("images"), F.lit(0)), F.coalesce(F.size("image_refs"), F.lit(0))
    return _violations(articles, "C4", F.greatest(a, F.lit(0)) != F.greatest(b, F.lit(0)), F.concat(F.lit("len(images)="), a.cast("string"), F.lit(" != len(image_refs)="), b.cast("string")))


def image_rule(articles: DataFrame, decoder: images.Decoder) -> DataFrame:
    """C3 on every image: colour mode, one frame, some size."""

    @F.arrow_udf("string")
    def check(column):
        import pyarrow as pa

        said = []
        for cell in column:
            try:
                if not cell.as_py():
                    raise ValueError("an image without content")
                width, height, mode, frames = decoder.probe(cell.as_py())
                bad = [m for m, b in ((f"mode={mode}", mode not in ("RGB", "RGBA")), (f"n_frames={frames}", frames != 1), ("size zero", width <= 0 or height <= 0)) if b]
                said.append("; ".join(bad) or None)
            except Exception as e:
                said.append(str(e))
        return pa.array(said, pa.string())

    cells = articles.select("row_idx", "id", F.posexplode("images").alias("pos", "image"))
    return cells.select(F.lit("C3").alias("rule"), "row_idx", "id", "pos", check(F.col("image.bytes")).alias("message")).filter("message IS NOT NULL")


def count_rule(articles: DataFrame, expected: int) -> DataFrame:
    counted = articles.agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") != expected).select(F.lit("rows").alias("rule"), F.lit(None).cast("long").alias("row_idx"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("int").alias("pos"), F.concat(F.lit(f"expected {expected} rows, found "), F.col("n").cast("string")).alias("message"))


def hard_gate(articles: DataFrame, flagged: DataFrame, expected: int, decoder: images.Decoder | None = None) -> DataFrame:
    """All rules on all rows and images."""
    return _union([count_rule(articles, expected), content_rule(articles, flagged), list_rule(articles), alignment_rule(articles), image_rule(articles, decoder or images.default_decoder())]).select(*_COLUMNS)


def handoff_gate(articles: DataFrame, flagged: DataFrame, first: int = 8) -> DataFrame:
    """The row rules on the first rows only."""
    head = articles.filter(F.col("row_idx") < first)
    return _union([content_rule(head, flagged), list_rule(head), alignment_rule(head), round_trip_rule(head)]).select(*_COLUMNS)


def sampled_images(articles: DataFrame, cap: int = 400) -> DataFrame:
    """Every stride-th image in global order over aligned rows: (row_idx, id, pos, ref, image).

    The ordinal of an image is the number of images in earlier rows plus its
    position. Row sums are first added up per block of rows, so the only global
    order is over blocks.
    """
    aligned = articles.filter("images IS NOT NULL AND image_refs IS NOT NULL AND size(images) = size(image_refs)")
    n = F.size("images")
    block = F.floor(F.col("row_idx") / 4096)
    blocks = aligned.groupBy(block.alias("block")).agg(F.sum(n).alias("in_block"))
    before_block = F.coalesce(F.sum("in_block").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.select("block", before_block.alias("before_block"))
    within = F.coalesce(F.sum(n).over(Window.partitionBy("block").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = articles.agg(F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).alias("t")).first()["t"]
    stride = max(1, -(-total // cap))
    numbered = aligned.withColumn("block", block).withColumn("within", within).join(offsets, "block")
    cells = numbered.select("row_idx", "id", (F.col("before_block") + F.col("within")).alias("before"), "image_refs", F.posexplode("images").alias("pos", "image"))
    return cells.filter((F.col("before") + F.col("pos")) % stride == 0).select("row_idx", "id", "pos", F.get("image_refs", F.col("pos")).alias("ref"), "image")


def first_divergence(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(row_idx, expected_id, id) where ids first differ from a prefix of the expected order, if they do.

    The prefix is as long as the table. A row that is missing or too many differs too.
    """
    wanted = expected.select("row_idx", F.col("id").alias("expected_id"))
    last = found.agg(F.count("*").alias("n"))
    prefix = wanted.join(F.broadcast(last), F.col("row_idx") < F.col("n")).drop("n")  # one row
    joined = found.select("row_idx", "id").join(prefix, "row_idx", "full")
    return joined.filter(~F.col("id").eqNullSafe(F.col("expected_id"))).select("row_idx", "expected_id", "id").orderBy("row_idx").limit(1)


def large_rows(articles: DataFrame, least: int = LARGE) -> DataFrame:
    """(row_idx, n) of rows with many images."""
    return articles.select("row_idx", F.size("images").cast("long").alias("n")).filter(F.col("n") >= least)


def sample_rows(articles: DataFrame, rows: int) -> DataFrame:
    """What the first, middle and last row hold."""
    probes = sorted({0, rows // 2, max(0, rows - 1)})
    chosen = articles.filter(F.col("row_idx").isin(probes))
    title = F.col("title") if "title" in articles.columns else F.lit(None).cast("string")
    return chosen.select("row_idx", "id", title.alias("title"), F.greatest(F.size("images"), F.lit(0)).alias("n_images"), F.char_length("content").alias("n_chars"), text.first_heading(F.col("content")).alias("heading")).orderBy("row_idx")


def verify(articles: DataFrame, expected: DataFrame | None = None, decoder: images.Decoder | None = None, cap: int = 400, short: int = 40) -> dict:
    """The second stage's gate report; ``failures`` is empty if it passes."""
    n = F.greatest(F.size("images"), F.lit(0))
    counts = stats.image_counts(articles, n).first()
    failures, warnings = [], []
    if not counts["rows"]:
        failures.append("the table is empty")
    lengths = stats.content_lengths(articles, F.col("content"), short).first()
    empty = F.coalesce(F.char_length("content"), F.lit(0)) == 0
    brief = ~empty & (F.char_length("content") < short)
    has_text = F.coalesce(text.strip(F.col("text")), F.lit("")) != ""
    failures += [f"row {r['row_idx']} (id={r['id']}): content and text empty" for r in stats.first_rows(articles, empty & ~has_text).collect()]
    for what, which, count in (("empty", empty & has_text, lengths["empty_rows"]), ("short", brief, lengths["short_rows"])):
        if count:
            shown = ", ".join(f"{r['row_idx']}={r['id']}" for r in stats.first_rows(articles, which).collect())
            warnings.append(f"{what}-content rows: {count} (first: {shown})")
    if counts["most"] >= LARGE:
        large = large_rows(articles)
        warnings.append(f"rows of {LARGE} images or more: {large.count()}, the largest has {counts['most']}")
    aligned = [f"row {r['row_idx']} (id={r['id']}): {r['message']} ({r['rule']})" for r in list_rule(articles).unionByName(alignment_rule(articles)).orderBy("row_idx").limit(100).collect()]
    sample = sampled_images(articles, cap)
    checked = sample.count()
    corrupt = image_rule(sample.groupBy("row_idx", "id").agg(F.collect_list("image").alias("images")), decoder or images.default_decoder())
    modes = corrupt.filter("message LIKE 'mode=%'").count()
    bad = corrupt.count() - modes
    duplicates = stats.duplicate_ids(articles).first()["duplicates"]
    if duplicates:
        failures.append(f"duplicate ids: {duplicates}")
    determinism = "skipped"
    if expected is not None:
        determinism = "rederived"
        failures += [f"row order differs first at row {r['row_idx']}: {r['expected_id']!r} vs {r['id']!r}" for r in first_divergence(articles, expected).collect()]
    if bad:
        failures.append(f"{bad} sampled images cannot be decoded")
    if modes:
        warnings.append(f"{modes} sampled images are not RGB or RGBA")
    return {
        "rows": counts["rows"],
        "images_total": counts["total"],
        "histogram": {r["bin"]: r["rows"] for r in stats.binned_histogram(articles, n).collect()},
        "max_images_in_row": counts["most"],
        "empty_content_rows": lengths["empty_rows"],
        "short_content_rows": lengths["short_rows"],
        "images_sample_checked": checked,
        "corrupt_or_missing_images": bad,
        "non_color_modes": modes,
        "align_failures": aligned,
        "sample_rows": [r.asDict() for r in sample_rows(articles, counts["rows"]).collect()],
        "determinism_check": determinism,
        "warnings": warnings,
        "failures": failures + aligned,
    }


def strict_failures(counters: dict) -> list[str]:
    """What strict mode refuses: any dropped reference or unreadable article."""
    keys = ("failed", "missing_refs_dropped", "corrupt_images_dropped", "not_file_dropped", "unsupported_ext_dropped")
    return [f"{k}={counters[k]}" for k in keys if counters[k]]
