"""Quantiles and ranks of groups of any size against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arpent.functions.support import grouped_quantiles
from arpent.operators.ranking import running_counts
from arpent.plans.scoring import local_percentiles

ROWS = "k string, v double, _g int, _i string, _n double"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    rows = [("hot", rnd.lognormvariate(0, 3)) for _ in range(3000)] + [("hot", 1e12), ("hot", None)]
    rows += [(None, float(rnd.randrange(4))) for _ in range(50)] + [("one", 3.5), ("empty", None), ("ties", 2.0), ("ties", 2.0), ("neg", -5.0), ("neg", 1.0)]
    return rows


@pytest.mark.parametrize("ranges,held", [(1024, 50_000), (4, 10)])
def test_quantiles_equal_sorting(spark, rows, ranges, held):
    """Ties, one row, no value, a null key, a far value that crowds the rest into one range; cut again and again."""
    df = spark.createDataFrame([(k, v, 1, "x", 0.5) for k, v in rows], ROWS).repartition(3)
    wanted = {"a": ("v", 0.25), "b": ("v", 0.5), "c": ("w", 0.9), "d": ("v", 1.0)}
    out = grouped_quantiles(df.select("k", "v"), ["k"], [F.count(F.lit(1)).alias("n")], {"v": F.col("v"), "w": -F.col("v")}, wanted, ranges, held)
    made = {r["k"]: r for r in out.collect()}
    assert set(made) == {k for k, _ in rows}
    for key, r in made.items():
        assert r["n"] == sum(k == key for k, _ in rows)
        v = np.array([x for k, x in rows if k == key and x is not None])
        for name, (value, f) in wanted.items():
            assert r[name] == (pytest.approx(np.quantile(v if value == "v" else -v, f), rel=1e-12) if len(v) else None)


def test_quantiles_of_all_and_of_nothing(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    args = [F.count(F.lit(1)).alias("n")], {"v": F.col("v")}, {"q": ("v", 0.3)}
    whole = grouped_quantiles(df, [], *args).collect()
    assert len(whole) == 1 and whole[0]["q"] == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.3), rel=1e-12)
    assert grouped_quantiles(df.limit(0), ["k"], *args).collect() == []


def test_running_counts_equal_sorting(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    made = {(r["_g"]["k"], r["_v"]): (r["before"], r["ties"], r["all"]) for r in running_counts(df, ["k"], "v").collect()}
    low = lambda v: (v is not None, v or 0)
    assert set(made) == set(rows)
    for k, v in set(rows):
        own = [low(x) for g, x in rows if g == k]
        assert made[k, v] == (sum(x < low(v) for x in own), sum(x == low(v) for x in own), len(own))


def test_local_percentiles_equal_the_window(spark, rows):
    from pyspark.sql import Window

    df = spark.createDataFrame([(k, "f", v) for k, v in rows], "segment string, feature string, value double")
    want = df.withColumn("local_percentile", F.percent_rank().over(Window.partitionBy("segment", "feature").orderBy("value")))
    key = lambda d: sorted(map(str, d.select("segment", "value", "local_percentile").collect()))
    assert key(local_percentiles(df, "segment", "feature", "value")) == key(want)
