"""Connected components by randomised contraction, on DataFrames.

Each round every node takes as its parent the one of itself and its neighbours that
comes first in a pseudo-random order of the nodes, parents are followed once, and
edges are rewritten between parents; edges that became loops or repeats go. The
order is a hash of the node and is drawn anew every second round, so it does not
depend on how nodes are numbered: in expectation a constant part of the nodes goes
in two rounds, whatever the graph, and the number of rounds grows with the logarithm
of the nodes. (With the nodes' own order a path of ascending ids would lose two
nodes a round.) A star is done in two rounds, since its hub finds the least leaf in
the first and all follow it in the second.

Every table is written before it is joined: a hot parent is then an ordinary skewed
join, which adaptive execution splits, and nothing is recomputed after a loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import drop, save


def _ordered(node: str, rounds: int) -> Column:
    return F.struct(F.xxhash64(F.lit(rounds // 2), F.col(node)).alias("rank"), F.col(node).alias("node"))


def contracted(edges: DataFrame) -> tuple[DataFrame, int]:
    """(node, root) of every node of ``edges`` (a, b), and the rounds it took; a root is some node of its component."""
    live = save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    roots, rounds = None, 0
    while True:
        ends = live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*")
        first = ends.groupBy("node").agg(F.min(_ordered("other", rounds)).alias("first"))
        parents = save(first.select("node", F.least(_ordered("node", rounds), "first")["node"].alias("parent")), "parents")
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grandparent"))
        jumped = save(parents.join(above, "parent").select("node", F.col("grandparent").alias("parent")), "jumped")
        drop(parents)
        rounds += 1
        if roots is None:
            roots = save(jumped.withColumnRenamed("parent", "root"), "roots")
        else:
            up = jumped.select(F.col("node").alias("root"), F.col("parent").alias("next"))
            before, roots = roots, save(roots.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
            drop(before)
        onto_a = jumped.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        onto_b = jumped.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        half = save(live.join(onto_a, "a").select("pa", "b"), "half")
        after = half.join(onto_b, "b").filter("pa <> pb").select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct()
        left = save(after, "edges")
        for table in (live, half, jumped):
            drop(table)
        live = left
        if live.isEmpty():
            drop(live)
            return roots, rounds


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the smallest node reachable.

    Loops, repeats and rows with a null end are ignored.
    """
    roots, _ = contracted(edges)
    least = save(roots.groupBy("root").agg(F.min("node").alias("component")), "components")
    return roots.join(least, "root").select("node", "component")
