"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is normalised (each run of ASCII white space becomes one space) and cut
into chunks where its content says so: between two words that end and begin with
certain characters (a word's last code is 1 modulo 8, the one before and the next
word's first are 1 modulo 4), ``MIN_CHARS`` characters or more apart; and after
``MAX_CHARS`` where no such words come. A chunk's identifier is its 64-bit hash.
Identifiers are verified once over all distinct chunks: no identifier may stand
for two SHA-256 digests; if one does, the digests themselves become the
identifiers. A document's recipe is its ordered identifier list, and documents
are equal when their recipes are. Texts never cross the network: chunks are
digested where they are read, and only identifiers are shuffled.

Defined cases: a null text counts as empty, and all empty texts are equal to one
another. Rows that share a doc_id are kept or dropped together. Rows whose
doc_id is null are kept only if their whole group has no doc_id. An empty table
gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import save

SPACES = r"[\x20\x09-\x0D]+"
MIN_CHARS, MAX_CHARS = 64, 8192


def _codes(modulus: int) -> str:
    return "[" + "".join(f"\\x{{{c:X}}}" for c in range(0x21, 0x100) if c % modulus == 1) + "]"


CHUNK = rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?<={_codes(4)}{_codes(8)} )(?={_codes(4)})|.{{1,{MAX_CHARS}}}"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def chunks(column: Column) -> Column:
    """The content-defined chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(column, F.lit(CHUNK), F.lit(0))


def _identifiers(chunk_list: Column, wide: bool) -> Column:
    return F.transform(chunk_list, (lambda c: F.unhex(F.sha2(c, 256))) if wide else (lambda c: F.xxhash64(c)))


def verified(texts: DataFrame) -> bool:
    """Whether no 64-bit identifier stands for two different chunks of column ``chunks``."""
    pairs = texts.select(F.explode("chunks").alias("chunk")).select(F.xxhash64("chunk").alias("id"), F.unhex(F.sha2("chunk", 256)).alias("digest"))
    return pairs.distinct().groupBy("id").count().filter("count > 1").isEmpty()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    plain = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("body"))
    wide = not verified(plain.select(chunks(F.col("body")).alias("chunks")))
    recipes = save(
        plain.select("doc_id", F.sha2("body", 256).alias("text_sha256"), _identifiers(chunks(F.col("body")), wide).alias("recipe")),
        "recipes",
    )
    groups = save(
        recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1").withColumn("found", F.lit(True)),
        "recipe-groups",
    )
    return recipes.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("found"), F.col("doc_id").eqNullSafe(F.col("keep_id"))).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
    )


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    result = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return result.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
