"""The training-corpus pipeline over ``documents``.

Stages, in order: quality classifier (rejected documents go), exact dedup, SimHash
near-dedup (of documents that share 0.8 of their five-word shingles, or whose
fingerprints differ in two bits or fewer, one stays), suffix-array dedup (repeated
passages are cut out of texts) and packing. Each stage works on everything the
one before has kept and its decisions take effect; all but the last return the
columns of ``documents``.

Rows of one doc_id and one text (in exact dedup, one text but for white space) are
one document and stand or fall together; rows of one doc_id with different texts are
judged each. Rows without doc_id are never dropped, but lose repeated passages like
others. A document whose whole text is repeated elsewhere stays as a row with an empty
text. Null texts count as empty, columns beyond those of ``documents`` are kept as
they are, and an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import durable, exact_dedup, packing, simhash, suffix_dedup
from folioscope.llm import quality as quality_model


def _without(docs: DataFrame, decisions: DataFrame, text: Column) -> DataFrame:
    """``docs`` less the rows that ``decisions`` (doc_id, text_sha256 of ``text``, kept) drops."""
    dropped = durable.save(decisions.filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("dropped_id"), F.col("text_sha256").alias("dropped_text")).distinct(), "dropped")
    # What goes grows with the input, so it is never broadcast: one plan at every size.
    return docs.join(dropped.hint("shuffle_merge"), (docs["doc_id"] == dropped["dropped_id"]) & (F.sha2(text, 256) == dropped["dropped_text"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality, by text and site, is below one half. Without labels of both classes nothing goes."""
    return _without(docs, quality_model.quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), F.coalesce("text", F.lit("")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, keeps the rows with the smallest doc_id. Empty and null texts are equal."""
    return _without(docs, exact_dedup.exact_dedup(docs), exact_dedup.normalised("text"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts, keeps the smallest doc_id; texts without words are similar to one another."""
    return _without(docs, simhash.similar_dedup(docs), F.coalesce("text", F.lit("")))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every repeated passage of 200 bytes or more out of all texts; all rows stay.

    What a cut leaves of a character at its edges goes too. Null texts become empty.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = suffix_dedup.substring_dedup(docs, carry=others, as_text=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept"), **{c: F.col("carried")[c] for c in others}}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast("long")
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises and packs every row, repeated ones and those without doc_id or text too, into sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("passage dedup", passages), ("packing", pack)]

#: Quality scores, fingerprints and tokens have no SQL; the test compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
