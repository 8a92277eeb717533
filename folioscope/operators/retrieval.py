"""Exact cosine retrieval over an index (row_idx, embedding)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vectors


class BadScore(ValueError):
    """A score or an index entry is not finite."""


def clamp(k: int, n: int) -> int:
    return max(1, min(k, n))


def _literal(query) -> Column:
    return query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])


def scores(index: DataFrame, query, *keys: str) -> DataFrame:
    """Keys and ``score`` of every row; a non-finite score raises when it is computed."""
    score = vectors.cosine(F.col("embedding"), _literal(query))
    checked = F.when(F.isnan(score) | (F.abs(score) == float("inf")), F.raise_error(F.lit("non-finite score")).cast("double")).otherwise(score)
    return index.select(*(keys or ("row_idx",)), checked.alias("score"))


def topk(index: DataFrame, query, k: int = 100, key: str = "row_idx") -> DataFrame:
    """(rank, key, score) of the ``k`` best rows, ties by key; each task keeps its own best first."""
    best = scores(index, query, key).orderBy(F.desc("score"), key).limit(max(1, k))
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key))).select("rank", key, "score")


ROWS, QUERIES, BROADCAST = 65_536, 2_048, 64 << 20


def by_blocks(index: DataFrame, queries: DataFrame, compare: Callable[[pa.Table, np.ndarray, pa.Table, np.ndarray], pa.Table], schema: str, rows: int = ROWS, asked: int = QUERIES) -> DataFrame:
    """``compare`` of every block of ``index`` with every block of ``queries``, each pair of blocks in a task's group.

    The first column of either names its rows; ``v`` holds the vectors, which are given
    normalised. Both are cut into blocks of a fixed size by a hash, so what a task holds is
    bounded however many queries there are, and nothing comes to the driver but two counts.
    """
    n, m = max(1, -(-index.count() // rows)), max(1, -(-queries.count() // asked))

    def dealt(own: DataFrame, mine: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64(own.columns[0]), F.lit(blocks)).cast("int")
        return own.select("*", block.alias(mine), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    def unit(own: pa.Table) -> np.ndarray:
        v = own.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, -1)
        return v / (np.linalg.norm(v, axis=1, keepdims=True) + vectors.EPSILON)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            left, right = left.slice(0, 0), right.slice(0, 0)
            return compare(left, np.zeros((0, 1)), right, np.zeros((0, 1)))
        return compare(left, unit(left), right, unit(right))

    own = dealt(index, "b1", n, "b2", m).groupBy("b1", "b2")
    return own.cogroup(dealt(queries, "b2", m, "b1", n).groupBy("b1", "b2")).applyInArrow(run, schema)


def topk_batch(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "row_idx", query_key: str = "query_id", block: int = QUERIES) -> DataFrame:
    """(query, rank, key, score) for many queries against all rows.

    Each pair of blocks gives its own best ``k`` of each query, and a window ranks those.
    """

    def best(left: pa.Table, rows: np.ndarray, right: pa.Table, asked: np.ndarray) -> pa.Table:
        keys, names = left.column(0).to_numpy(), right.column(0).to_numpy()
        scores = asked @ rows.T if len(keys) else np.zeros((0, 0))
        least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
        q, i = np.nonzero(scores >= least[:, None])  # ties with the last one included
        order = np.lexsort((keys[i], -scores[q, i], q))
        q, i = q[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, i = q[place < k], i[place < k]
        return pa.table({query_key: pa.array(names[q], pa.int64()), key: pa.array(keys[i], pa.int64()), "score": pa.array(scores[q, i], pa.float64())})

    def plain(own: DataFrame, name: str) -> DataFrame:
        return own.select(F.col(name).cast("long").alias(name), vectors.doubles(F.col("embedding")).alias("v"))

    found = by_blocks(plain(index, key), plain(queries, query_key), best, f"{query_key} long, {key} long, score double", asked=block)
    own = Window.partitionBy(query_key).orderBy(F.desc("score"), key)
    return found.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select(query_key, "rank", key, "score")


def topk_native(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "row_idx", query_key: str = "query_id") -> DataFrame:
    """``topk_batch`` in native expressions, for as many queries as may be broadcast (``BROADCAST`` bytes); else by blocks."""
    size = queries.agg(F.coalesce(F.sum(8 * F.size("embedding") + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    if size > BROADCAST:
        return topk_batch(index, queries, k, key, query_key)
    asked = queries.select(query_key, F.col("embedding").alias("asked"))
    pairs = index.select(key, "embedding").join(F.broadcast(asked))
    scored = pairs.select(query_key, key, vectors.cosine(F.col("embedding"), F.col("asked")).alias("score"))
    own = Window.partitionBy(query_key).orderBy(F.desc("score"), key)
    return scored.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select(query_key, "rank", key, "score")


def best_by_kind(index: DataFrame, probes: DataFrame) -> DataFrame:
    """(query_id, kind, top1_score): each probe's best score among rows of its own label (in-domain) and of others, itself left out.

    ``index`` has (row_idx, label, v), ``probes`` (query_id, label, v).
    """

    def best(left: pa.Table, rows: np.ndarray, right: pa.Table, asked: np.ndarray) -> pa.Table:
        keys, names = left.column(0).to_numpy(), right.column(0).to_numpy()
        scores = asked @ rows.T if len(keys) else np.zeros((0, 0))
        scores[names[:, None] == keys[None, :]] = -np.inf
        same = right.column("label").to_numpy()[:, None] == left.column("label").to_numpy()[None, :]
        parts = [np.where(which, scores, -np.inf).max(axis=1, initial=-np.inf) for which in (same, ~same)]
        table = pa.table({"query_id": pa.array(np.r_[names, names], pa.int64()), "kind": pa.array(["in-domain"] * len(names) + ["out-of-domain"] * len(names), pa.string()), "top1_score": pa.array(np.concatenate(parts), pa.float64())})
        return table.filter(pa.array(np.isfinite(np.concatenate(parts))))

    found = by_blocks(index, probes, best, "query_id long, kind string, top1_score double")
    return found.groupBy("query_id", "kind").agg(F.max("top1_score").alias("top1_score"))


def hydrate(ranking: DataFrame, corpus: DataFrame, snippet: int = 110) -> DataFrame:
    """A ranking with id, title, image count, bar and snippet, which are made of the joined rows only."""
    joined = corpus.select("row_idx", "id", "title", "content", "image_refs").join(F.broadcast(ranking), "row_idx")  # ``k`` rows
    shown = text.display_title(F.col("title"), F.col("content"), F.col("id"))
    made = joined.select(*[c for c in ranking.columns], "id", shown.alias("title"), F.size("image_refs").alias("n_images"), text.snippet(F.col("content"), snippet).alias("snippet"))
    return made.withColumn("bar", text.score_bar(F.col("score"))).orderBy("rank")


def rank_of(ranking: DataFrame, row_idx: int) -> DataFrame:
    """One row: the rank of a row in a ranking, -1 if it is not there."""
    return ranking.agg(F.coalesce(F.min(F.when(F.col("row_idx") == row_idx, F.col("rank"))), F.lit(-1)).alias("rank"))


def verdict(tops: DataFrame) -> DataFrame:
    """From (kind, top1_score): in_domain_top1, out_of_domain_top1, passed (strictly lower outside)."""
    inside = F.min(F.when(F.col("kind") == "in-domain", F.col("top1_score")))
    outside = F.max(F.when(F.col("kind") == "out-of-domain", F.col("top1_score")))
    return tops.agg(inside.alias("in_domain_top1"), outside.alias("out_of_domain_top1")).withColumn("passed", F.coalesce(F.col("out_of_domain_top1") < F.col("in_domain_top1"), F.lit(False)))


def smoke(index: DataFrame, articles: DataFrame, encoder, probes: list[dict], k: int = 100, top: int = 5) -> dict:
    """Text probes in and out of domain, one image probe, and the verdict."""
    results, reasons = [], []
    for probe in probes:
        found = topk(index, encoder.encode_queries([probe["query"]])[0], k).filter(F.col("rank") <= top)
        titled = found.join(articles.select("row_idx", "id", "title"), "row_idx").withColumn("hit", text.plausible(probe["keywords"], F.col("id"), F.col("title"))).orderBy("rank").collect()
        rows = [{"rank": r["rank"], "index": r["row_idx"], "id": r["id"], "title": r["title"], "score": round(r["score"], 4)} for r in titled]
        hit = next((r["hit"] for r in titled if r["hit"]), None)
        results.append({**probe, "top": [r["index"] for r in rows], "top1_score": titled[0]["score"] if titled else None, "top5": rows, "keyword_hit": hit})
    tops = index.sparkSession.createDataFrame([(r["kind"], r["top1_score"]) for r in results], "kind string, top1_score double")
    said = verdict(tops).first()
    pictured = articles.filter(F.size("images") > 0).orderBy("row_idx").limit(1).select("row_idx", "id", F.get("images", F.lit(0))["bytes"].alias("png")).first()
    image = None
    if pictured is None:
        reasons.append("no row has an image to ask for")
    else:
        found = topk(index, encoder.encode_documents(None, [bytes(pictured["png"])])[0], k).collect()
        ranks = {r["row_idx"]: r["rank"] for r in found}
        image = {"kind": "image", "source_row": pictured["row_idx"], "source_id": pictured["id"], "top": [r["row_idx"] for r in found[:top]], "top1_score": round(found[0]["score"], 4), "source_rank_top_k": ranks.get(pictured["row_idx"], -1), "ok": True}
    if not said["passed"]:
        reasons.append(f"best score outside the domain is {said['out_of_domain_top1']}, within it {said['in_domain_top1']}: the first must be less")
    return {"passed": not reasons, "fail_reasons": reasons, "out_of_domain_top1": said["out_of_domain_top1"], "in_domain_top1": said["in_domain_top1"], "probes": results, "image_query": image}
