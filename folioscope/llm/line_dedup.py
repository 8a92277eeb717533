"""Line dedup by a distributed suffix array over line identifiers (DataFrame functions only).

Lines become 128-bit identifiers, a document a sequence of them. Prefix doubling
ranks the suffixes: the rank of a suffix to depth 2h is the rank of the pair of
ranks to depth h at it and h lines on. A round counts distinct pairs
(pre-aggregated, so a hot line is no hot group), sorts the repeated ones by range
partitions, and numbers them in that order; no partition needs to know how many
rows the others have, since ranks only need to ascend. Suffixes whose rank is
unique leave the rounds, as no deeper rank of theirs can be shared.

Rounds stop at depth ``min_lines``: suffixes of equal rank are then exactly the
intervals of the suffix array with a longest common prefix of at least
``min_lines`` lines, and deeper order would not change what is deleted. Of each
interval the first copy in corpus order (doc_id, then line) stays. The windows of
all later copies are merged into maximal repeated runs, and these lines go.

Defined cases: a null text counts as empty, which is one empty line. Rows that
repeat a doc_id are copies of each other, of which the first read stays; rows
without doc_id come first. An empty table gives an empty result. Columns other
than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import save

MIN_LINES = 3


def _ranked(keys: DataFrame, *columns: str) -> DataFrame:
    """Rows of distinct keys with ``rank``, ascending in the order of ``columns``; saved."""
    ordered = keys.repartitionByRange(*[F.col(c) for c in columns]).sortWithinPartitions(*columns)
    return save(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _pairs(active: DataFrame, step: int) -> DataFrame:
    """(uid, pos, doc_id, r1, r2): ranks at a position and ``step`` lines on, where both are shared."""
    ahead = active.select("uid", (F.col("pos") - step).alias("pos"), F.col("rank").alias("r2"))
    return active.withColumnRenamed("rank", "r1").join(ahead, ["uid", "pos"])


def repeated_windows(sequences: DataFrame, length: int = MIN_LINES) -> DataFrame:
    """(uid, pos) of every window of ``length`` lines that is a later copy; from (uid, doc_id, ids)."""
    lines = sequences.select("uid", "doc_id", F.posexplode("ids").alias("pos", "id")).select("uid", "doc_id", "pos", F.col("id.a").alias("r1"), F.col("id.b").alias("r2"))
    depth = 1
    first = F.min(F.struct("doc_id", "uid", "pos")).alias("first")
    while True:
        shared = lines.groupBy("r1", "r2").agg(F.count("*").alias("n"), *[first] * (depth == length)).filter("n > 1")
        if depth == length:
            windows = lines.join(save(shared, "windows"), ["r1", "r2"])
            return windows.filter(~F.struct("doc_id", "uid", "pos").eqNullSafe(F.col("first"))).select("uid", "pos")
        active = save(lines.join(_ranked(shared, "r1", "r2"), ["r1", "r2"]).select("uid", "doc_id", "pos", "rank"), "active")
        step = min(depth, length - depth)
        lines = save(_pairs(active, step), "pairs")
        depth += step


def runs(windows: DataFrame, length: int = MIN_LINES) -> DataFrame:
    """(uid, runs): windows merged to sorted, disjoint (start, end) of lines."""
    own = Window.partitionBy("uid").orderBy("pos")
    before = F.lag("pos").over(own)
    marked = windows.withColumn("new", F.when(before.isNull() | (F.col("pos") > before + length), 1).otherwise(0))
    numbered = marked.withColumn("run", F.sum("new").over(own))
    merged = numbered.groupBy("uid", "run").agg(F.min("pos").alias("start"), (F.max("pos") + length).alias("end"))
    return merged.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _kept(lines: Column, spans: Column) -> Column:
    """The lines outside the spans, by slices between them."""
    after = F.concat(F.array(F.lit(0)), spans["end"])
    before = F.concat(spans["start"], F.array(F.size(lines)))
    return F.flatten(F.zip_with(after, before, lambda a, b: F.slice(lines, a + 1, b - a)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, n_lines, n_removed, runs, kept_text): one row per input row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    table = save(own.withColumn("uid", F.monotonically_increasing_id()), "lines")
    ids = F.transform("lines", lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b")))
    spans = save(runs(repeated_windows(table.select("uid", "doc_id", ids.alias("ids")), min_lines), min_lines), "runs")
    joined = table.join(spans, "uid", "left")
    found = F.col("runs").isNotNull()
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(found, F.aggregate("runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])).otherwise(0).cast("long").alias("n_removed"),
        F.coalesce("runs", F.array().cast("array<struct<start:int,end:int>>")).alias("runs"),
        F.array_join(F.when(found, _kept(F.col("lines"), F.col("runs"))).otherwise(F.col("lines")), "\n").alias("kept_text"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    result = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return result.select("doc_id", "n_lines", "n_removed", F.size("runs").cast("long").alias("n_runs"), F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM d),
w AS (SELECT doc_id, pos, string_agg(line, chr(10)) OVER f AS body, count(*) OVER f AS n FROM l
      WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {MIN_LINES - 1} FOLLOWING)),
c AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS copy FROM w WHERE n = {MIN_LINES}),
gone AS (SELECT DISTINCT doc_id, pos + unnest(range({MIN_LINES})) AS pos FROM c WHERE copy > 1),
m AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS removed,
      (g.pos IS NOT NULL AND NOT coalesce(lag(g.pos IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.pos), false)) AS opens
      FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, count(*) FILTER (opens) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
