"""Every registered query outside the training-data subpackage against its SQL in DuckDB, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from arpent.plans import catalog, q_barometer, q_core, q_extra, q_features, q_more, q_shapes, q_spatial, q_streaming  # noqa: F401

SF = "/root/testdata/sf0.001"
#: A few of each module here; the driver holds all of them against their SQL.
NAMES = sorted(catalog.ORACLES)[::4]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in catalog.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return float(f"{float(v):.7g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T00:00:00", "")
    return v


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    found = duck.sql(catalog.ORACLES[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert ours == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_names_are_registered_once():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
