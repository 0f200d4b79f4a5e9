"""Connected components over an edge table, in rounds of grouping and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arpent.plans.staging import staged, unstage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Rows ``(node, component)`` for every node of an edge; ``component`` is the smallest node that it reaches.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each round hooks neighbours on the smallest
    node known nearby, so the number of rounds grows with the logarithm of the diameter. Grouping only takes minima,
    which combine before the shuffle, so a node with very many edges is no hot task. Edges with a null end or with
    equal ends carry no link and are left out; repeated edges count once.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    now = staged(_oriented(pairs).distinct(), "edges")
    total = None
    for _ in range(max_rounds):
        large = _star(now, larger_only=True)
        after = staged(_star(large, larger_only=False), "edges")
        # A star forest keeps its edges from one round to the next: the checksum of the edge set stands still.
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        unstage(now)
        now = after
        if mark == total:
            break
        total = mark
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    # Now every edge goes from a node (a) to the root of its component (b).
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One round. ``edges`` runs from larger a to smaller b. Large star: a node's larger neighbours hook on the least
    of all its neighbours and itself. Small star: its smaller neighbours and itself hook on the least of them."""
    if larger_only:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            edges.select(F.col("b").alias("n"), F.col("a").alias("m"))
        )
    else:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m"))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("root"))
    hooked = both.join(least, "n")
    if larger_only:
        out = hooked.where("m > n").select(F.col("m").alias("a"), F.col("root").alias("b"))
    else:
        out = hooked.select(F.col("m").alias("a"), F.col("root").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("root").alias("b"))
        )
    return out.where("a <> b").distinct()
