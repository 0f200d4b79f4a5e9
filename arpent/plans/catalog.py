"""Registry of queries on the star tables, and the relations that those tables stand in for."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relation(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A SELECT over the tables of a folder. Tables stand as bare words."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", text)}
    return spark.sql(re.sub(rf"\b({'|'.join(used)})\b", r"{\1}", text), **used) if used else spark.sql(text)


# The property-market relations, read off the star tables. Both Spark and DuckDB run these texts.

#: One row an act: a parcel (customer) in a commune (nation) sold on a day. The surface belongs to the parcel, and every
#: tenth act has an extended one.
SALES = """SELECT CAST(o_custkey AS STRING) AS parcel_id, CAST(c_nationkey AS STRING) AS commune_code, CAST(o_orderdate AS DATE) AS mutation_date,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Maison' ELSE 'Appartement' END AS property_type,
  o_totalprice AS price_eur, CAST(40 + o_custkey % 60 + CASE WHEN o_orderkey % 10 = 0 THEN 20 ELSE 0 END AS DOUBLE) AS surface_m2, o_orderkey AS sale_id
FROM orders JOIN customer ON o_custkey = c_custkey"""

#: One row a diagnostic: a lot of an act, deposited 900 days before its shipping date.
DIAGNOSTICS = """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS dpe_number,
  CAST(o_custkey AS STRING) AS parcel_id, CAST(c_nationkey AS STRING) AS commune_code, CAST(l_shipdate AS DATE) - INTERVAL '900' DAY AS deposited_ts,
  CASE WHEN l_quantity = 50 THEN NULL ELSE substr('ABCDEFG', CAST(l_quantity AS INT) % 7 + 1, 1) END AS label,
  CASE WHEN l_returnflag = 'A' THEN 'appartement' ELSE 'maison' END AS building_type, (l_returnflag = 'N' AND l_linestatus = 'O') AS from_immeuble
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
DIAGNOSTICS = f"""SELECT dpe_number, parcel_id, commune_code, CAST(deposited_ts AS DATE) AS deposited_on, label, building_type, from_immeuble
FROM ({DIAGNOSTICS}) AS raw_diagnostics"""

#: Commune to intercommunal area; the communes of the last area belong to none.
TERRITORIES = """SELECT CAST(n_nationkey AS STRING) AS commune_code, CASE WHEN n_regionkey = 4 THEN NULL ELSE CAST(n_regionkey AS STRING) END AS epci_code, n_name AS name
FROM nation"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, SALES)


def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, DIAGNOSTICS)


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, TERRITORIES)
