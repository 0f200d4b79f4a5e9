"""Ranks, samples and lists that come out the same however the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from arpent.plans.staging import staged


def hash_order(seed: str, key: str) -> Column:
    """Pseudo-random order that depends on seed and key alone."""
    return F.sha2(F.concat(F.lit(seed), F.lit(":"), F.col(key).cast("string")), 256)


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key, the first in order."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def stratified_sample(rows: DataFrame, strata: Sequence[str], key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows of each stratum in hash order, with their place."""
    return rows.withColumn("draw", F.row_number().over(Window.partitionBy(*strata).orderBy(hash_order(seed, key), key))).where(F.col("draw") <= n)


def numbered(rows: DataFrame, key: str, seed: str, name: str) -> DataFrame:
    """The rows numbered from 1 in hash order, as a column ``name``. Numbers run within the 4,096 blocks of a hash prefix;
    the counts of the blocks ahead, a table of 4,096 rows, are added, so no task holds all rows."""
    placed = rows.withColumn("_h", hash_order(seed, key)).withColumn("_block", F.substring("_h", 1, 3))
    counts = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.join(counts.select("_block", ahead.alias("_ahead")), "_block")
    own = F.row_number().over(Window.partitionBy("_block").orderBy("_h", key))
    return placed.select(*rows.columns, (own + F.col("_ahead")).alias(name))


def running_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For each group and value: how many rows of the group come before it (``before``), share it (``ties``), are there at
    all (``all``). Values are sorted over all groups in ranges; counts run within a range, and those of a group's ranges
    ahead are added, so no task holds a group. A null value comes first; the group is the struct ``_g`` of the keys."""
    own = rows.groupBy(F.struct(*keys).alias("_g"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("ties"))
    own = staged(own.repartitionByRange("_g", "_v").withColumn("_block", F.spark_partition_id()), "ranks")
    ahead = Window.partitionBy("_g").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("_g", "_block").agg(F.sum("ties").alias("_n")).select("_g", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_n").over(Window.partitionBy("_g")).alias("all"))
    inside = Window.partitionBy("_g", "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_inside", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
    return own.join(blocks, ["_g", "_block"]).select("_g", "_v", (F.col("_inside") + F.col("_ahead")).alias("before"), "ties", "all")


def mean_rank(rows: DataFrame, key: str, signals: dict[str, bool]) -> DataFrame:
    """Mean normalised rank over the signals that a row has, ties sharing theirs; 1 for none. ``signals``: descending?

    Ranks come from the running counts of a signal's values, which no task holds as a whole."""
    parts = [F.struct(F.lit(s).alias("signal"), (F.col(s).cast("double") * (-1 if down else 1)).alias("v")) for s, down in signals.items()]
    long = rows.select(key, F.explode(F.array(*parts)).alias("s")).select(key, "s.signal", "s.v").where("v is not null")
    shared = running_counts(long, ["signal"], "v").select("_g.signal", F.col("_v").alias("v"), ((F.col("before") + (F.col("ties") + 1) / 2) / F.col("all")).alias("share"))
    ranks = long.join(shared, ["signal", "v"]).groupBy(key).agg(F.avg("share").alias("_m"), F.count(F.lit(1)).alias("_n"))
    return rows.select(key).join(ranks, key, "left").select(key, F.coalesce("_m", F.lit(1.0)).alias("mean_rank"), F.coalesce("_n", F.lit(0)).alias("signals"))


def keyset_page(rows: DataFrame, score: str, key: str, after: tuple[float, int] | None, n: int) -> DataFrame:
    """The page after a cursor, by score downwards and key upwards."""
    if after:
        s, k = after
        rows = rows.where((F.col(score) < s) | ((F.col(score) == s) & (F.col(key) > k)))
    return rows.orderBy(F.desc(score), key).limit(n)


def precision_at(rows: DataFrame, segment: str, score: str, key: str, label: str, k: int) -> DataFrame:
    """By segment: share of positive labels among the k best, over the share among all, and their ratio."""
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(segment).orderBy(F.desc(score), key)))
    out = ranked.groupBy(segment).agg(F.avg(F.when(F.col("_k") <= k, F.col(label).cast("double"))).alias("_p"), F.avg(F.col(label).cast("double")).alias("_b"), F.count(F.lit(1)).alias("candidates"))
    return out.select(segment, "candidates", F.round("_p", 6).alias("precision_at_k"), F.round("_b", 6).alias("base_rate"), F.round(F.try_divide("_p", "_b"), 6).alias("lift_at_k"))


def top_k_stability(one: DataFrame, two: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """Jaccard index of two top-k sets."""
    a = one.orderBy(F.desc(score), key).limit(k).select(key, F.lit(1).alias("a"))
    b = two.orderBy(F.desc(score), key).limit(k).select(key, F.lit(1).alias("b"))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"), F.count(F.lit(1)).alias("either")).withColumn("jaccard", F.round(F.col("shared") / F.col("either"), 6))


def blind_merge(one: DataFrame, two: DataFrame, key: str, names: tuple[str, str], seed: str) -> DataFrame:
    """Two lists as one, a row a unit with both origins, numbered in hash order."""
    a, b = one.select(key, F.lit(names[0]).alias("_a")), two.select(key, F.lit(names[1]).alias("_b"))
    both = a.join(b, key, "full_outer").select(key, F.concat_ws("+", "_a", "_b").alias("origin"))
    return numbered(both, key, seed, "blind_no")
