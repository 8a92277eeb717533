"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. *Evidence.* Every document gets text statistics and counts of its words, hashed to
   ``BUCKETS``; a ridge logistic regression fitted on labelled rows gives its log-odds.
   At most about ``SAMPLE`` labelled documents are used, chosen by a hash of their
   doc_id. Only those are gathered; all others are scored where they are read.
2. *Sites.* Over all documents, grouped aggregation sums expected quality per host
   and per path. A host's posterior mean shrinks toward the global mean, a path's
   toward its host's; the strength of each prior is estimated by the method of
   moments from how much sites differ. Sparse sites thus fall back to their
   parent.
3. *Posterior.* A document's log-odds are its evidence plus its path's log-odds
   relative to the global ones. Its own contribution is taken out of its path
   first, so no document vouches for itself. It is kept at ``KEEP`` or more, so a tie
   is kept.

Host and path are those of the column ``url`` where there is one: its host, and that
with the first part of its path. ``documents`` has none; there the host is ``source``
and the path is ``source/lang``.

Defined cases: a null text counts as empty; a null host or path is a site of its
own. Without labelled rows of both classes there is no evidence: every document
has quality 0.5 and is kept. A doc_id that is labelled several times is good if at
least half of its labels are; rows of one doc_id are scored each, and the least text
of them is learnt from. Rows without doc_id are scored like others. An empty table
gives an empty result. Columns other than the named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import save, small_batches

SAMPLE, KEEP, RIDGE, BUCKETS = 20_000, 0.5, 1.0, 256
STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "punctuation", "full_stop", "comma", "punctuation_runs", "punctuation_words", "line_breaks", "distinct_words", "distinct_lines", "ends_full_stop", "high_bytes", "control")

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
_PUNCTUATION = np.array([ord(c) for c in _SIGNS if c not in ".,"])
_BLANK = np.array([chr(b).isspace() and b < 33 and b not in (28, 29, 30, 31) for b in range(256)])
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUES[_UPPER] = _VALUES[97:123]
_VALUES[[b for b in range(128) if not chr(b).isalnum()]] = 0
_POWERS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)
_SIGN = np.array([b < 128 and chr(b) in _SIGNS for b in range(256)])


def features(texts: list[str | None], buckets: int = BUCKETS) -> np.ndarray:
    """A row per text: the statistics named in STATISTICS, then the logarithms of the hashed words' counts in a hundred words."""
    datas = [(t or "").encode() for t in texts]
    split = [d.split() for d in datas]
    lines = [d.split(b"\n") for d in datas]
    sizes, n_words = np.array([len(d) for d in datas]), np.array([len(x) for x in split])
    codes = np.frombuffer(b"\n" + b"\n".join(datas) + b"\n", np.uint8)  # a line feed before and behind each text
    of = np.repeat(np.arange(len(datas)), sizes + 1)  # text of every code but the first
    own = codes[1:]
    counts = np.bincount(of * 256 + own, minlength=256 * len(datas)).reshape(-1, 256)
    counts[:, 10] -= 1
    sign, blank = _SIGN[codes], _BLANK[codes]
    edges = np.flatnonzero(sign[1:] != sign[:-1]) + 1
    first, behind = edges[::2], edges[1::2]  # runs of signs
    run_of = of[first - 1]
    runs = np.bincount(run_of[behind - first > 1], minlength=len(datas))
    alone = np.bincount(run_of[blank[first - 1] & blank[behind]], minlength=len(datas))
    n, w = np.maximum(1, sizes), np.maximum(1, n_words)
    statistics = [
        np.log1p(sizes),
        np.log1p(n_words),
        np.minimum(40.0, sizes / w) / 10,
        counts[:, _UPPER].sum(axis=1) / n,
        counts[:, _DIGIT].sum(axis=1) / n,
        counts[:, _PUNCTUATION].sum(axis=1) / w,
        counts[:, 46] / w,
        counts[:, 44] / w,
        runs / w,
        alone / w,
        counts[:, 10] / w,
        np.array([len(set(x)) for x in split]) / w,
        np.array([len(set(x)) / len(x) for x in lines]),
        np.array([d.rstrip().endswith(b".") for d in datas], float),
        counts[:, 128:].sum(axis=1) / n,
        (counts[:, :32].sum(axis=1) - counts[:, 9] - counts[:, 10] - counts[:, 13]) / n,
    ]
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    hashed = np.zeros(len(datas) * buckets, np.int64)
    if len(starts):
        # A word's hash is of its letters and digits; A-Z count as a-z.
        place = np.arange(starts[0], len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
        hashes = np.add.reduceat(_VALUES[codes[starts[0] :]] * _POWERS[np.minimum(place, len(_POWERS) - 1)], starts - starts[0])
        hashes = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        hashed = np.bincount(of[starts - 1] * buckets + ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), minlength=len(hashed))
    return np.c_[np.stack(statistics, axis=1), np.log1p(hashed.reshape(-1, buckets) * 100 / w[:, None])]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression by Newton's method, for unscaled features."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-6]
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p) + 1e-6)) @ z + np.diag(penalty), z.T @ (y - p) - penalty * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    weights = beta[:-1] / scale
    return weights, float(beta[-1] - weights @ mean)


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str, sample: int) -> DataFrame:
    """(doc_id, y, text): one row per labelled document, about ``sample`` at most; ``docs`` has doc_id and text."""
    votes = labels.select("doc_id", F.col(label_col).cast("double").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    rows = save(votes.groupBy("doc_id").agg((F.avg(F.when(F.col("y") > 0, 1.0).otherwise(0.0)) >= 0.5).cast("double").alias("y")).join(docs.select("doc_id"), "doc_id", "left_semi"), "labelled")
    n = rows.count()
    if n > sample:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / n))
    # Bounded by ``sample``, so it is broadcast; a doc_id that repeats is reduced where it is read.
    return docs.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float, np.ndarray, np.ndarray] | None:
    """Weights, bias, and the least and largest of each feature met, from about ``sample`` labelled documents at most; None without both classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            packed = [row.tobytes() for row in features(batch.column(1).to_pylist()).astype("<f4")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["y", "features"])

    chosen = _labelled(docs, labels, label_col, sample).select("y", "text").mapInArrow(run, "y double, features binary").toPandas()  # bounded by ``sample``
    if chosen["y"].nunique() < 2:
        return None
    x = np.frombuffer(b"".join(chosen["features"]), "<f4").reshape(len(chosen), -1).astype(float)
    return *fit(x, chosen["y"].to_numpy(float)), x.min(axis=0), x.max(axis=0)


def scored(docs: DataFrame, model: tuple[np.ndarray, float, np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, text_sha256, host, path, evidence) of every row of (doc_id, text_sha256, host, path, text).

    Features beyond what was learnt from, as those of a very long text, count as the nearest that was met.
    """
    weights, bias, least, most = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = np.clip(np.clip(features(batch.column(4).to_pylist()), least, most) @ weights + bias, -12.0, 12.0) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(evidence, pa.float64())], ["doc_id", "text_sha256", "host", "path", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_sha256 string, host string, path string, evidence double")


def sites(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of a document: of its ``url``, or its ``source`` and ``lang``."""
    if "url" in docs.columns:
        host = F.try_parse_url("url", F.lit("HOST"))
        return host, F.concat_ws("/", host, F.split_part(F.try_parse_url("url", F.lit("PATH")), F.lit("/"), F.lit(2)))
    return F.col("source"), F.concat_ws("/", F.col("source"), F.col("lang"))


def _logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (1 - q))


def _strength(sites: DataFrame, parent: Column, most: float = 1e4) -> float:
    """Prior strength, in documents, by the method of moments over sites with two or more documents."""
    mean = F.col("total") / F.col("n")
    within = F.greatest(parent * (1 - parent), F.lit(1e-9))
    row = sites.filter("n > 1").agg(F.sum((mean - parent) ** 2 / within).alias("spread"), F.sum(1 / F.col("n")).alias("expected"), F.count("*").alias("sites")).first()
    if not row["sites"]:
        return most
    between = (row["spread"] - row["expected"]) / row["sites"]
    return most if between <= 1 / most else max(1.0, 1 / between - 1)


def quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """(doc_id, text_sha256, evidence, site, quality, kept): one row per input row; text_sha256 tells the rows of a repeated doc_id apart."""
    small_batches(docs.sparkSession)
    if host is None or path is None:
        own = sites(docs)
        host, path = own[0] if host is None else host, own[1] if path is None else path
    text = F.col(text_col).cast("string")
    site_names = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((host, "host"), (path, "path"))]
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"), *site_names, text.alias("text"))
    model = train(chosen.select("doc_id", "text"), labels, label_col, sample)
    if model is None:
        flat = F.lit(0.5)
        return chosen.select("doc_id", "text_sha256", F.lit(0.0).alias("evidence"), flat.alias("site"), flat.alias("quality"), F.lit(True).alias("kept"))
    rows = save(scored(chosen, model).withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))), "evidence")
    return posteriors(rows, keep).select("doc_id", "text_sha256", "evidence", "site", "quality", "kept")


def posteriors(rows: DataFrame, keep: float = KEEP) -> DataFrame:
    """Adds site, quality and kept to rows with host, path, evidence and its probability ``p``."""
    paths = save(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("total")), "paths")
    hosts = save(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    if not whole["n"]:
        return rows.withColumns({"site": F.col("p"), "quality": F.col("p"), "kept": F.lit(True)})
    base = F.lit(whole["total"] / whole["n"])
    over_hosts = _strength(hosts, base)
    host_mean = (F.lit(over_hosts) * base + F.col("total")) / (F.lit(over_hosts) + F.col("n"))
    above = hosts.select("host", host_mean.alias("host_mean"))
    under = save(paths.join(above, "host"), "paths-with-hosts")
    over_paths = F.lit(_strength(under, F.col("host_mean")))
    site = (over_paths * F.col("host_mean") + F.col("total") - F.col("p")) / (over_paths + F.col("n") - 1)
    posterior = F.col("evidence") + _logit(F.col("site")) - _logit(base)
    judged = rows.join(under, ["host", "path"]).withColumn("site", site).withColumn("quality", 1 / (1 + F.exp(-posterior)))
    return judged.withColumn("kept", F.col("quality") >= keep)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text_sha256")
