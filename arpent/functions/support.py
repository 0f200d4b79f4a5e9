"""Values with their support: a rate or quantile appears only with enough observations, and its count always does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Keys that the values of a group are dealt to.
SLOTS = 64

DEPARTMENT, EPCI, COMMUNE = "department", "epci", "commune"


def missing_support(count: Column, minimum: int) -> Column:
    """Why a value is absent, or null where the support is reached."""
    return F.when(count < minimum, F.format_string("insufficient support: %d < %d", count, F.lit(minimum)))


def supported(value: Column, count: Column, minimum: int) -> Column:
    """``value``, or null below the support."""
    return F.when(count >= minimum, value)


def quantile(value: str | Column, fraction: float) -> Column:
    """Exact quantile with linear interpolation between order statistics."""
    return F.percentile(value, F.lit(fraction))


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage rounded half to even; null on an empty whole."""
    return F.bround(F.try_divide(100.0 * part, whole), digits)


def with_scopes(rows: DataFrame, territories: DataFrame, department: str, levels: Sequence[str], commune: str = "commune_code") -> DataFrame:
    """Each row once a scope that it belongs to: department, intercommunal area, commune. A commune without area counts
    in no area. The commune table is small and fixed by geography, so Spark may broadcast it by its size."""
    known = territories.select(F.col("commune_code").alias("_commune"), "epci_code")
    joined = rows.join(known, rows[commune] == F.col("_commune"), "left")
    all_scopes = {
        DEPARTMENT: F.struct(F.lit(DEPARTMENT).alias("scope_type"), F.lit(department).alias("scope_code")),
        EPCI: F.struct(F.lit(EPCI).alias("scope_type"), F.col("epci_code").alias("scope_code")),
        COMMUNE: F.struct(F.lit(COMMUNE).alias("scope_type"), F.col(commune).alias("scope_code")),
    }
    scopes = F.filter(F.array(*[all_scopes[x] for x in levels]), lambda s: s["scope_code"].isNotNull())
    return joined.withColumn("_scope", F.explode(scopes)).select(*rows.columns, "_scope.*")


def weighted_quantile(rows: DataFrame, keys: Sequence[str], value: str, weight: str, fraction: float, name: str = "weighted_quantile") -> DataFrame:
    """For each group the least value whose running weight reaches ``fraction`` of the whole; ties by weight.

    The running sum needs a group's rows in order; groups are subjects with a handful of comparables each."""
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(value, weight).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    run = rows.withColumns({"_run": F.sum(weight).over(order), "_all": F.sum(weight).over(whole)})
    return run.where(F.col("_run") >= fraction * F.col("_all")).groupBy(*keys).agg(F.min(value).alias(name))


def grouped_quantiles(
    rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column], values: dict[str, Column], wanted: dict[str, tuple[str, float]], ranges: int = 1024, held: int = 50_000
) -> DataFrame:
    """``rows.groupBy(*keys).agg(*aggs)`` with exact quantiles of the named values, for groups of any size.

    The extent of a group's values is cut into ``ranges``; the counts of the ranges tell in which of them a wanted rank
    lies, and only the values of that range are sorted. A range of more than ``held`` values is cut again. So what one task
    sorts is bounded by ``held`` and what it counts by ``ranges``, however large the group is; a value that many rows share
    is one row with a count. Quantiles interpolate between order statistics. Null values count nothing, a group without
    values has null quantiles, a null key is a group; values must be finite. ``rows`` should be narrow, since it is staged.
    """
    from pyspark.sql import Window

    from arpent.plans.staging import staged, unstage

    names = list(values)
    fractions = {i: sorted({f for v, f in wanted.values() if v == name}) for i, name in enumerate(names)}
    rows = staged(rows.withColumns({f"_v{i}": values[v].cast("double") for i, v in enumerate(names)}).withColumn("_g", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))), "values")
    per = [f(f"_v{i}").alias(f"_{n}{i}") for i in fractions for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    groups = staged(rows.groupBy("_g").agg(*aggs, *per), "groups")
    one = lambda i: F.struct(F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_n"), F.col(f"_lo{i}").alias("_lo"), F.col(f"_hi{i}").alias("_hi"))
    limits = groups.select("_g", F.explode(F.array(*[one(i) for i in fractions])).alias("x")).select("_g", "x.*").where("_n > 0")
    limits = limits.withColumns({"_p": F.lit(""), "_before": F.lit(0).cast("long")})
    long = rows.select("_g", F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_v{i}").alias("_v")) for i in fractions])).alias("x")).select("_g", "x.*").where("_v is not null")
    long = long.withColumn("_p", F.lit(""))
    place = lambda f: F.lit(f) * (F.col("_n") - 1)
    ranks = F.lit(None)
    for i, fs in fractions.items():
        ranks = F.when(F.col("_i") == i, F.array_distinct(F.array(*[g(place(f)).cast("long") for f in fs for g in (F.floor, F.ceil)]))).otherwise(ranks)
    old = None
    while True:
        cut = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * ranges), F.lit(ranges - 1))).otherwise(0)
        dealt = long.join(limits, ["_g", "_i", "_p"]).withColumn("_p", F.concat("_p", F.lit("/"), cut.cast("string"))).withColumn("_r", cut.cast("long"))
        counts = dealt.groupBy("_g", "_i", "_p", "_n", "_before", "_r").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        above = F.regexp_replace("_p", "/[0-9]+$", "")
        ahead = F.sum("_c").over(Window.partitionBy("_g", "_i", above).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("_before", F.col("_before") + F.coalesce(ahead, F.lit(0)))
        limits = staged(counts.where(F.exists(ranks, lambda k: (k >= F.col("_before")) & (k < F.col("_before") + F.col("_c")))), "ranges")
        long = dealt.select("_g", "_i", "_v", "_p").join(limits.select("_g", "_i", "_p"), ["_g", "_i", "_p"], "left_semi")
        if limits.where((F.col("_c") > held) & (F.col("_lo") < F.col("_hi"))).isEmpty():
            break
        long = staged(long, "inside")
        if old is not None:
            unstage(old)
        old = long
        limits = limits.drop("_r", "_c")
    tied = long.groupBy("_g", "_i", "_p", "_v").agg(F.count(F.lit(1)).alias("_t")).join(limits.select("_g", "_i", "_p", "_n", "_before"), ["_g", "_i", "_p"])
    ahead = F.coalesce(F.sum("_t").over(Window.partitionBy("_g", "_i", "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tied = tied.withColumn("_first", F.col("_before") + ahead)
    hit = F.filter(ranks, lambda k: (k >= F.col("_first")) & (k < F.col("_first") + F.col("_t")))
    found = tied.select("_g", "_i", "_v", F.explode(hit).alias("_k")).groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("_i", "_k"), "_v"))).alias("_found"))  # two a quantile
    out = groups.join(found, "_g", "left")
    for name, (value, f) in wanted.items():
        i = names.index(value)
        at = F.lit(f) * (F.col(f"_n{i}") - 1)
        low, high = F.floor(at).cast("long"), F.ceil(at).cast("long")
        v = lambda k: F.col("_found")[F.struct(F.lit(i).alias("_i"), k.alias("_k"))]  # noqa: E731, B023
        out = out.withColumn(name, F.when(F.col(f"_n{i}") > 0, F.when(low == high, v(low)).otherwise((high - at) * v(low) + (at - low) * v(high))))
    drop = ["_found", *[f"_{n}{i}" for i in fractions for n in ("n", "lo", "hi")]]
    return out.drop(*drop).select(*[F.col(f"_g.{k}").alias(k) for k in keys], "*").drop("_g")


def distribution(rows: DataFrame, group: str, value: str, decision: str, discrete: int = 12, low: float = 0.0, high: float = 1.0, buckets: int = 10) -> DataFrame:
    """How the values of each group spread, by decision: a row a value where the group has at most ``discrete`` distinct
    ones, else a row a bucket of equal width, with the least and greatest value seen. Values below ``low`` are in the bucket
    before the first, those from ``high`` on in the one after the last; nulls are a row without a bound."""
    from arpent.plans.staging import staged

    # Equal values are one row with a count before they meet the number of values of their group, which is there once a slot,
    # so a group's values are dealt to ``SLOTS`` keys.
    counted = rows.groupBy(group, decision, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counted = staged(counted, "values")
    shapes = counted.groupBy(F.col(group).alias("_g")).agg(F.count_distinct("_v").alias("_n")).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    width = (high - low) / buckets
    bucket = (F.width_bucket("_v", F.lit(low), F.lit(high), F.lit(buckets)) - 1) * width + low
    kind = F.when(F.col("_n") <= discrete, "value").otherwise("bucket").alias("kind")
    bound = F.when(F.col("_n") <= discrete, F.col("_v")).otherwise(F.round(bucket, 9)).alias("lower_bound")
    slot = F.pmod(F.hash("_v", decision), F.lit(SLOTS))
    out = counted.join(shapes, F.col(group).eqNullSafe(F.col("_g")) & (slot == F.col("_slot"))).groupBy(group, decision, kind, bound)
    return out.agg(F.sum("_c").alias("volume"), F.round(F.min("_v"), 5).alias("observed_min"), F.round(F.max("_v"), 5).alias("observed_max"))
