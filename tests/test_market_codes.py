"""Market features by code and coverage of sources, against hand-made cases and plain loops."""

import datetime as dt
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from arpent.functions.support import distribution
from arpent.plans import features as FT, releases as RL

DECIDED = "subject long, reason string, mutation_date date, age_months int, normalized_price_m2 double, weight double, strategy string, recent int"
SUBJECTS = "subject long, strategy string, source_accepted boolean, observable_stock int, scenario_surface_m2 double, value string"


def quantile(prices, f):
    """The smallest price at which the running weight reaches the share ``f``."""
    run, whole = 0.0, sum(w for _, w in prices)
    for p, w in sorted(prices):
        run += w
        if run >= f * whole:
            return p


def plain(rows, strategy, accepted, stock, surface):
    """code: (value, lower, upper, reason)"""
    codes = list(FT.MARKET_CODES.get(strategy, {}))
    if not accepted:
        return {c: (None, None, None, "source_not_accepted") for c in codes}
    prices, n = [(r[3], r[4]) for r in rows], len(rows)
    level, spread = (quantile(prices, 0.5) if n else None), (quantile(prices, 0.75) - quantile(prices, 0.25) if n >= 4 else None)
    dated = sorted((r[1], r[3]) for r in rows)
    days = (dated[-1][0] - dated[0][0]).days if dated else 0
    trend = None
    if n >= 6 and days >= 365:
        trend = (median(p for _, p in dated[n // 2 :]) / median(p for _, p in dated[: n // 2])) ** (365.25 / days) - 1
    low, high = (quantile(prices, 0.25) * surface, quantile(prices, 0.75) * surface) if n and surface and surface > 0 else (None, None)
    liquidity = sum(r[2] <= 12 for r in rows) / stock if stock and stock > 0 else None
    out = {"MKT-001": level, "MKT-003": n, "MKT-004": spread, "MKT-005": liquidity, "MKT-101": level, "MKT-102": n, "MKT-103": spread, "MKT-104": median(r[2] for r in rows) if n else None, "MKT-105": trend}
    of = lambda c: (None, low, high, None if low is not None else "source_value_missing") if c == "MKT-002" else (out[c], None, None, None if out[c] is not None else "source_value_missing")
    return {c: of(c) for c in codes}


def near(a, b):
    return a == b if not isinstance(a, float) or b is None else abs(a - b) < 1e-6 * max(1.0, abs(a))


def test_market_codes_against_plain_loops(spark):
    rnd, rows, subjects = random.Random(3), {}, []
    for s in range(24):
        rows[s] = [(s, dt.date(1998, 1, 1) + dt.timedelta(rnd.randrange(90 if s % 5 == 0 else 1400)), rnd.randrange(60), float(rnd.randrange(900, 1100)), rnd.choice([0.1, 0.5, 0.5, 1.0])) for _ in range([0, 1, 3, 4, 5, 6, 40][s % 7])]
        for strategy in ("division_extension", "renovation_resale", "neither", None):
            subjects.append((s, strategy, [True, True, True, False, None][s % 5 if s % 3 else 0], [None, 0, 4, 7][s % 4], [None, 0.0, 120.0][s % 3], "x"))
    subjects.append((None, "division_extension", True, 3, 50.0, "x"))
    decided = [(s, "included", d, a, p, w, "x", 1) for s in rows for _, d, a, p, w in rows[s]] + [(s, "too_old", dt.date(1990, 1, 1), 99, None, None, "x", 1) for s in rows]
    got = FT.market_codes(spark.createDataFrame(decided, DECIDED).repartition(5), spark.createDataFrame(subjects, SUBJECTS), "subject").collect()
    found = {(r["subject"], r["strategy"], r["code"]): (r["value"], r["lower_eur"], r["upper_eur"], r["missing_reason"]) for r in got}
    want = {(s, strategy, c): v for s, strategy, ok, stock, surface, _ in subjects for c, v in plain(rows.get(s, []), strategy, ok, stock, surface).items()}
    assert len(got) == len(found) and set(found) == set(want)
    for k, v in want.items():
        assert all(near(None if x is None else float(x) if not isinstance(x, str) else x, y) for x, y in zip(v, found[k])), (k, v, found[k])
    assert all((r["missing_reason"] is None) == (r["value"] is not None or r["lower_eur"] is not None) for r in got)


def test_market_codes_of_no_subject(spark):
    none = FT.market_codes(spark.createDataFrame([], DECIDED), spark.createDataFrame([], SUBJECTS), "subject")
    assert none.columns == ["subject", "strategy", "code", "value", "lower_eur", "upper_eur", "missing_reason"] and none.collect() == []


def test_coverage(spark):
    areas = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,), ("d",)], "area string")
    rows = [("a", "x", "r1"), ("a", "x", "r2"), ("a", "y", "r2"), ("b", "x", None), ("b", "z", "r9"), ("e", "x", "r1"), (None, "x", "r1"), ("c", None, "r1")]
    rows = spark.createDataFrame([(*r, "k") for r in rows], "area string, source string, release string, missing string")
    out = {r["area"]: tuple(r)[1:] for r in RL.coverage(areas, rows, "area", "source", ["y", "x"], least=2, release="release").collect()}
    assert out == {
        "a": (2, [], ["y"], 1, "covered"), "b": (1, ["y"], ["x", "y"], 0, "partial"), "c": (0, ["x", "y"], ["x", "y"], 0, "not_covered"), "d": (0, ["x", "y"], ["x", "y"], 0, "not_covered"),
    }
    assert RL.coverage(areas.limit(0), rows, "area", "source", ["x"]).collect() == []
    assert RL.coverage(areas, rows.where(F.lit(False)), "area", "source", ["x"]).where("members > 0").collect() == []


def test_distribution_of_discrete_and_continuous_values(spark):
    rnd = random.Random(8)
    rows = [("d", rnd.choice([0.0, 0.5, 1.0]), "yes") for _ in range(50)] + [("c", rnd.uniform(-0.2, 1.3), rnd.choice(["yes", "no"])) for _ in range(300)] + [("c", None, "no"), (None, 0.5, None), (None, 0.5, None)]
    got = distribution(spark.createDataFrame([(*r, 1) for r in rows], "g string, v double, d string, kind int"), "g", "v", "d").collect()
    want = {}
    for g, v, d in rows:
        k = v if g != "c" or v is None else round((-1 if v < 0 else 10 if v >= 1 else int(v * 10)) / 10, 9)
        want.setdefault((g, d, "bucket" if g == "c" else "value", k), []).append(v)
    assert {(r["g"], r["d"], r["kind"], r["lower_bound"]): (r["volume"], r["observed_min"]) for r in got} == {
        k: (len(v), None if v[0] is None else round(min(v), 5)) for k, v in want.items()
    }


def test_attestations(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "area string, fingerprint string")
    written = spark.createDataFrame([("1", 1), ("1", 3), ("1", 2), ("9", 4)], "fingerprint string, number int")
    assert sorted(map(tuple, RL.attested(m, written).select("area", "number", "recounted").collect())) == [("a", 3, True), ("b", None, False), ("c", None, False)]
    with pytest.raises(ValueError):
        RL.attested(m, written.unionByName(spark.createDataFrame([("1", None)], written.schema)))


def test_evidence_of_snapshots(spark):
    day = dt.date
    snaps = spark.createDataFrame([(1, day(2020, 1, 1), ["r1", "r2"]), (2, day(2020, 1, 1), None)], "snapshot int, snapshot_at date, release_ids array<string>")
    rows = [("ok", 1, day(2020, 1, 1), ["r2", "r1"]), ("undated", 1, None, []), ("late", 1, day(2020, 1, 2), ["r9"]), ("outside", 1, None, ["r1", "r9"]), ("lost", 3, None, None), ("none", 2, None, ["r1"]), ("bare", 2, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, snapshot int, observed_at date, release_ids array<string>, _set int")
    got = {r["id"]: r["violation"] for r in RL.evidence_violations(df, snaps, "id").collect()}
    assert got == {"late": "newer_than_snapshot", "outside": "release_outside_snapshot", "lost": "unknown_snapshot", "none": "release_outside_snapshot"}
