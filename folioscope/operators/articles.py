"""From a tree of articles to the article table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markdown, refs, text
from ..sources import mdx_corpus
from ..sources.scratch import saved
from . import ids, images

SHORT = 40
EMPTY_REASON = "the body holds only imports or components; cleaned content is empty"


@dataclass
class Build:
    """articles, bad_items (id, article, ref, resolved, error), failed (article, error), references, flagged (id, reason)."""

    articles: DataFrame
    bad_items: DataFrame
    failed: DataFrame
    references: DataFrame
    flagged: DataFrame


def content_flag(body: Column, content: Column) -> Column:
    """Why a row's content needs a look, or null: empty or nearly so although there was a body."""
    n = F.char_length(text.strip(content))
    reason = F.when(n == 0, F.lit(EMPTY_REASON)).when(n < SHORT, F.concat(F.lit("near-empty cleaned content ("), n.cast("string"), F.lit(f" chars < {SHORT})")))
    return F.when(text.strip(body) != "", reason)


def parsed(corpus: DataFrame, preserve_newlines: bool = False) -> DataFrame:
    """Articles with id, text, front matter, cleaned content and reference targets; unreadable ones have null ``text``."""
    checked = F.try_validate_utf8(F.col("content").cast("string"))
    plain = checked if preserve_newlines else F.regexp_replace(checked, "\r\n?", "\n")
    named = ids.with_ids(corpus).withColumn("text", plain).drop("content")
    return (
        named.withColumn("front", markdown.split_frontmatter(F.regexp_replace("text", "\r\n?", "\n")))
        .withColumn("content", markdown.cleaned(F.col("front.body")))
        .withColumn("dests", markdown.dests(F.col("front.body")))
    )


def references(articles: DataFrame) -> DataFrame:
    """(row_idx, id, rel_path, pos, original_ref, resolved): in-scope references in document order."""
    folder = F.regexp_replace("rel_path", "/?[^/]*$", "")
    exploded = articles.select("row_idx", "id", "rel_path", folder.alias("folder"), F.posexplode("dests").alias("pos", "original_ref"))
    return exploded.filter(refs.in_scope(F.col("original_ref"))).select("row_idx", "id", "rel_path", "pos", "original_ref", refs.resolved(F.col("folder"), F.col("original_ref")).alias("resolved"))


def build_articles(spark: SparkSession, root: str, decoder: images.Decoder | None = None, max_edge: int = 4096, keep_frames: bool = False, limit: int = 0, preserve_newlines: bool = False) -> Build:
    """The whole first stage. Articles are parsed and images decoded once; what comes of it is written and read by all else.

    Rows are numbered without gaps. An unreadable article still counts where ids are told apart.
    """
    every = saved(parsed(mdx_corpus.read_corpus(spark, root, limit), preserve_newlines), "parsed")
    failed = every.filter("text IS NULL").select(F.col("rel_path").alias("article"), F.lit("not readable as UTF-8").alias("error"))
    rows = every.filter("text IS NOT NULL")
    unreadable = every.filter("text IS NULL").select("row_idx")
    if not unreadable.isEmpty():
        rows = saved(ids.dense(rows, unreadable), "dense")
    found = images.resolve(references(rows), mdx_corpus.read_files(spark, root))
    good = saved(images.decode_once(found.filter("reason IS NULL"), decoder or images.default_decoder(), max_edge, keep_frames), "decoded")
    every_ref = good.unionByName(found.filter("reason IS NOT NULL"), allowMissingColumns=True)
    error = F.coalesce("reason", "error")
    bad = every_ref.filter(error.isNotNull()).select("row_idx", "pos", "id", F.col("rel_path").alias("article"), F.col("original_ref").alias("ref"), F.when(error != "missing", F.col("abs_path")).alias("resolved"), error.alias("error"))
    broken = rows.filter("front.error IS NOT NULL").select("row_idx", F.lit(-1).alias("pos"), "id", F.col("rel_path").alias("article"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("string").alias("resolved"), F.col("front.error").alias("error"))
    bad_items = bad.unionByName(broken).orderBy(F.col("error") != "missing", "row_idx", "pos").drop("row_idx", "pos")
    slots = (
        good.filter("error IS NULL")
        .groupBy("row_idx")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "original_ref", "png", "abs_path"))).alias("slots"))  # an article's own images
    )
    none = F.array()
    joined = rows.join(slots, "row_idx", "left")
    articles = joined.select(
        "row_idx",
        "id",
        F.coalesce(F.nullif(F.col("front.title"), F.lit("")), text.first_h1(F.col("content")), F.col("dir_name")).alias("title"),
        F.coalesce(F.nullif(F.col("front.path"), F.lit("")), F.col("rel_path")).alias("source_path"),
        "text",
        "content",
        F.coalesce(F.transform("slots", lambda s: s["original_ref"]), none.cast("array<string>")).alias("image_refs"),
        F.coalesce(F.transform("slots", lambda s: F.struct(s["png"].alias("bytes"), F.lit(None).cast("string").alias("path"))), none.cast("array<struct<bytes:binary,path:string>>")).alias("images"),
        F.col("front.meta_json").alias("metadata"),
    )
    flagged = rows.select("id", content_flag(F.col("front.body"), F.col("content")).alias("reason")).filter("reason IS NOT NULL").orderBy("id")
    return Build(articles, bad_items, failed, every_ref, flagged)
