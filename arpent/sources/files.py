"""Readers of the domain's file layouts, with explicit schemas, and writers of its results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from arpent.functions.scalars import decimal_comma, french_or_iso_date, price


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that a header lacks."""
    return sorted(set(required) - set(df.columns))


def require(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame, or an error before anything is written."""
    if absent := missing_columns(df, required):
        raise ValueError(f"columns missing: {', '.join(absent)}")
    return df


def read_lots(spark: SparkSession, path: str) -> DataFrame:
    """Sale lots as comma-separated text with a header, gzip or plain, dealt out by sale since gzip cannot be split."""
    raw = spark.read.csv(path, header=True)
    require(raw, ["id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "code_commune", "id_parcelle", "type_local", "surface_reelle_bati", "surface_terrain"])
    n = lambda c: F.col(c).try_cast("double")
    has = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    text = lambda c: F.nullif(F.trim(has(c)), F.lit(""))
    return raw.select(
        F.col("id_mutation").alias("sale_id"), F.try_to_date("date_mutation").alias("mutation_date"), F.col("nature_mutation").alias("nature"), n("valeur_fonciere").alias("value_eur"),
        F.col("code_commune").alias("commune_code"), text("id_parcelle").alias("parcel_id"), text("type_local").alias("local_type"), n("surface_reelle_bati").alias("built_m2"),
        n("surface_terrain").alias("land_m2"), text("nombre_pieces_principales").alias("rooms"), text("lot1_numero").alias("lot_label"), text("nature_culture").alias("culture"),
        F.monotonically_increasing_id().alias("lot_no"),
    ).repartition("sale_id")


def read_archive(spark: SparkSession, path: str, department: str) -> DataFrame:
    """The pipe-separated archive, one department, brought to the layout of ``read_lots``."""
    c = lambda name: F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
    raw = spark.read.csv(path, sep="|", header=True)
    require(raw, ["No disposition", "Date mutation", "Valeur fonciere", "Code departement", "Code commune", "Section", "No plan"])
    commune = F.concat(F.lpad(c("Code departement"), 2, "0"), F.lpad(c("Code commune"), 3, "0"))
    parcel = F.concat(commune, F.lpad(F.coalesce(c("Prefixe de section"), F.lit("")), 3, "0"), F.lpad(c("Section"), 2, "0"), F.lpad(c("No plan"), 4, "0"))
    day = french_or_iso_date(c("Date mutation"))
    key = F.concat_ws(":", day.cast("string"), commune, F.coalesce(c("Valeur fonciere"), F.lit("")), F.coalesce(c("No disposition"), F.lit("")))
    return raw.where(c("Code departement") == department).select(
        key.alias("sale_id"), day.alias("mutation_date"), c("Nature mutation").alias("nature"), price(c("Valeur fonciere")).alias("value_eur"), commune.alias("commune_code"),
        F.when(c("Section").isNotNull() & c("No plan").isNotNull(), parcel).alias("parcel_id"), c("Type local").alias("local_type"), decimal_comma(c("Surface reelle bati")).alias("built_m2"),
        decimal_comma(c("Surface terrain")).alias("land_m2"), c("Nombre pieces principales").alias("rooms"), c("1er lot").alias("lot_label"), F.lit(None).cast("string").alias("culture"),
        F.monotonically_increasing_id().alias("lot_no"),
    )


def read_diagnostics(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A wide comma-separated extract whose cells may hold line breaks; only the named columns go on."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    first = raw.columns[0].lstrip("﻿")
    raw = raw.withColumnRenamed(raw.columns[0], first)
    return require(raw, columns).select(*columns)


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated addresses, with their parcels as an array."""
    raw = require(spark.read.csv(path, sep=";", header=True), ["id", "numero", "nom_voie", "code_postal", "code_insee", "nom_commune", "x", "y"])
    parcels = F.filter(F.split(F.coalesce(F.col("cad_parcelles"), F.lit("")), r"\|"), lambda p: p != "") if "cad_parcelles" in raw.columns else F.array().cast("array<string>")
    return raw.withColumns({"x": F.col("x").try_cast("double"), "y": F.col("y").try_cast("double"), "parcels": parcels})


BUILDING_CELLS = {
    "ext_ids": T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("id", "source", "source_version")])),
    "addresses": T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("cle_interop_ban", "street")])),
    "plots": T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("bdg_cover_ratio", T.DoubleType())])),
}


def read_buildings(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated buildings whose cells hold JSON arrays; a cell that does not parse marks its row."""
    raw = require(spark.read.csv(path, sep=";", header=True, quote='"', escape='"'), ["rnb_id", *BUILDING_CELLS])
    parsed = raw.withColumns({f"_{c}": F.from_json(c, t) for c, t in BUILDING_CELLS.items()})
    bad = [F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), c) for c in BUILDING_CELLS]
    out = parsed.withColumn("unparsed", F.array_compact(F.array(*bad)))
    for c in BUILDING_CELLS:
        out = out.withColumn(c, F.col(f"_{c}")).drop(f"_{c}")
    return out


RINGS = "array<array<array<double>>>"
FEATURE = "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"


def read_features(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """A GeoJSON collection: properties (a map of texts), the rings of a polygon, all polygons of either kind, a point's
    place, and why a geometry is not read. With ``by_line``, features stand one a line, bare or within a collection, so that a
    large file is read in splits; the other lines are its frame."""
    if by_line:
        lines = spark.read.text(path).select(F.from_json(F.rtrim(F.col("value"), F.lit(", \r\t")), FEATURE).alias("f"))
        rows = lines.where("f.type = 'Feature'")
    else:
        rows = spark.read.json(path, schema=f"features array<{FEATURE}>", multiLine=True).select(F.explode("features").alias("f"))
    kind, coordinates = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one = F.when(kind == "Polygon", F.from_json(coordinates, RINGS))
    several = F.when(kind == "MultiPolygon", F.from_json(coordinates, f"array<{RINGS}>"))
    place = F.when(kind == "Point", F.from_json(coordinates, "array<double>"))
    out = rows.select("f.properties", kind.alias("geometry_type"), one.alias("rings"), F.coalesce(several, F.when(one.isNotNull(), F.array(one))).alias("polygons"), F.get(place, 0).alias("x"), F.get(place, 1).alias("y"))
    open_ring = lambda r: r.isNull() | (F.size(r) < 4) | F.exists(r, lambda p: F.get(p, 0).isNull() | F.get(p, 1).isNull())
    whole = (F.size("polygons") > 0) & ~F.exists("polygons", lambda p: p.isNull() | (F.size(p) < 1) | F.exists(p, open_ring))
    read = F.when(F.col("geometry_type") == "Point", F.col("x").isNotNull() & F.col("y").isNotNull()).otherwise(F.coalesce(whole, F.lit(False)))
    known = F.col("geometry_type").isin("Point", "Polygon", "MultiPolygon")
    return out.withColumn("unread", F.when(F.col("geometry_type").isNull(), "geometry_missing").when(~known, "geometry_type_unsupported").when(~read, "coordinates_unreadable"))


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    """A statistical cube, its commune rows only."""
    return require(spark.read.csv(path, sep=";", header=True), ["GEO", "GEO_OBJECT", "OBS_VALUE"]).where("GEO_OBJECT = 'COM'").withColumn("OBS_VALUE", F.col("OBS_VALUE").try_cast("double"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Labels of codes (variable, code, label) from the semicolon-separated dictionary of a cube; the last line of a code
    counts, by label where lines cannot be told apart."""
    raw = require(spark.read.csv(path, header=True, sep=";"), ["COD_VAR", "COD_MOD", "LIB_MOD"])
    return raw.groupBy(F.col("COD_VAR").alias("variable"), F.col("COD_MOD").alias("code")).agg(F.max("LIB_MOD").alias("label"))


def publish(rows: DataFrame, path: str, partition: str = "release_id") -> None:
    """Replace only the partitions that ``rows`` has, so that other releases stay."""
    rows.write.mode("overwrite").partitionBy(partition).option("partitionOverwriteMode", "dynamic").parquet(path)


def write_measure(rows: DataFrame, path: str, columns: Sequence[str], order: Sequence[str]) -> None:
    """A published aggregate as one comma-separated file with fixed columns. No column may carry a parcel or address."""
    if private := [c for c in columns if "parcel_id" in c or "address" in c]:
        raise ValueError(f"not publishable: {', '.join(private)}")
    rows.select(*columns).orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True)


RISK_PAGE = "data array<struct<code_insee:string,longitude:double,latitude:double,risques_detail:array<struct<num_risque:string,libelle_risque_long:string>>>>"


def read_risk_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of risk records as JSON documents, one row a commune and risk; a record without details keeps its row."""
    rows = spark.read.json(path, schema=RISK_PAGE, multiLine=True).select(F.explode("data").alias("r"))
    out = rows.select(F.col("r.code_insee").alias("commune_code"), "r.longitude", "r.latitude", F.explode_outer("r.risques_detail").alias("d"))
    return out.select("commune_code", "longitude", "latitude", F.col("d.num_risque").alias("risk_code"), F.col("d.libelle_risque_long").alias("risk_label"))
