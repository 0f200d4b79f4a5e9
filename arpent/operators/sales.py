"""From lots to sales: which lots a price may refer to, and why it may not.

Lots: sale_id, lot_no (order in the source), local_type (null for land), built_m2, land_m2, rooms, lot_label, parcel_id,
culture, value_eur. One row a lot and land culture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from arpent.plans.staging import staged

LOT_KEYS = ["local_type", "built_m2", "rooms", "lot_label", "parcel_id"]


def with_surface(lots: DataFrame) -> DataFrame:
    """The lot's own surface: built for a building, land for land, never the other; zero or less is absent."""
    raw = F.when(F.col("local_type").isNull(), F.col("land_m2")).otherwise(F.col("built_m2"))
    return lots.withColumn("surface_m2", F.when(raw > 0, raw))


def distinct_lots(lots: DataFrame) -> DataFrame:
    """One row for lots that repeat within a sale, the first in source order."""
    order = Window.partitionBy("sale_id", *LOT_KEYS).orderBy("lot_no")
    return lots.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def land_surfaces(lots: DataFrame) -> DataFrame:
    """By sale and parcel: the sum and number of distinct (culture, surface) of its land lots."""
    land = with_surface(lots).where("local_type is null and surface_m2 is not null")
    one = land.select("sale_id", "parcel_id", "culture", "surface_m2").distinct()
    return one.groupBy("sale_id", "parcel_id").agg(F.sum("surface_m2").alias("land_total_m2"), F.count(F.lit(1)).alias("cultures"))


def priced_lots(lots: DataFrame) -> DataFrame:
    """Distinct lots that a price may refer to: the built ones if any, else land lots with a surface."""
    rows = with_surface(lots)
    built = F.max(F.col("local_type").isNotNull()).over(Window.partitionBy("sale_id"))
    rows = rows.withColumn("_built", built).where(F.when(F.col("_built"), F.col("local_type").isNotNull()).otherwise(F.col("surface_m2").isNotNull()))
    lots_ = distinct_lots(rows.drop("_built")).alias("l")
    land = land_surfaces(lots).alias("a")
    same = (F.col("l.sale_id") == F.col("a.sale_id")) & F.col("l.parcel_id").eqNullSafe(F.col("a.parcel_id"))
    joined = lots_.join(land, same, "left")
    surface = F.when(F.col("local_type").isNull(), F.col("land_total_m2")).otherwise(F.col("surface_m2"))
    return joined.select("l.*", surface.alias("priced_m2"), F.coalesce("cultures", F.lit(0)).alias("cultures")).drop("surface_m2")


def sale_verdicts(lots: DataFrame) -> DataFrame:
    """One row a sale: its price if the source gives exactly one, counts, and the most precise reason that keeps the
    price from being allocated, or null."""
    facts = lots.groupBy("sale_id").agg(F.collect_set("value_eur").alias("_v"), F.count_distinct("parcel_id").alias("parcels"), F.count(F.lit(1)).alias("lines"))
    priced = priced_lots(lots).groupBy("sale_id").agg(F.count(F.lit(1)).alias("priced_lots"), F.max("priced_m2").alias("_m2"), F.max(F.col("local_type").isNotNull()).alias("_built"))
    out = facts.join(priced, "sale_id", "left").withColumn("price_eur", F.when(F.size("_v") == 1, F.get("_v", F.lit(0))))
    n = F.coalesce("priced_lots", F.lit(0))
    reason = (
        F.when(F.col("price_eur").isNull(), "price_missing")
        .when(n == 0, "no_priced_lot")
        .when(n > 1, "multiple_priced_lots")
        .when(F.col("_m2").isNull(), "surface_missing")
        .when((F.col("parcels") > 1) & ~F.col("_built"), "multiple_parcels")
    )
    return out.select("sale_id", "price_eur", "parcels", "lines", n.alias("priced_lots"), reason.alias("complexity"))


def properties(lots: DataFrame) -> DataFrame:
    """Priced lots with the sale's price on the one lot of a simple sale, and how it was given."""
    verdict = sale_verdicts(lots).where("complexity is null").select("sale_id", "price_eur")
    method = F.when(F.col("local_type").isNull() & (F.col("cultures") > 1), "single_land_lot_all_cultures").otherwise("single_property_full_price")
    out = priced_lots(lots).join(verdict, "sale_id", "left")
    return out.withColumn("allocation_method", F.when(F.col("price_eur").isNotNull(), method)).withColumnRenamed("price_eur", "allocated_price_eur")


def rule_change_profile(lots: DataFrame) -> DataFrame:
    """Sales by the reason of the former rule, which tested the number of parcels first, and of the present one."""
    v = sale_verdicts(lots)
    former = F.when(F.col("price_eur").isNull(), "price_missing").when(F.col("parcels") > 1, "multiple_parcels").otherwise(F.col("complexity"))
    return v.groupBy(F.coalesce(former, F.lit("simple")).alias("former"), F.coalesce("complexity", F.lit("simple")).alias("present")).agg(F.count(F.lit(1)).alias("sales"))


def shared_counts(rows: DataFrame, item: str, basket: str, held: int = 1_000_000) -> DataFrame:
    """How many baskets each pair of items shares: ``a_id`` < ``b_id``, ``shared``. Repeated rows count once, null ones not at all.

    Baskets and pairs are dealt to as many parts as hold ``held`` rows each, so a task sorts and counts a bounded number of
    them however many there are. A basket's items are an array: a basket with very many has the square of them as pairs."""
    c = F.col
    given = rows.select(c(item).alias("_i"), c(basket).alias("_b")).where("_i is not null and _b is not null")
    parts = lambda n: max(1, -(-n // held))
    sets = given.repartition(parts(rows.count()), "_b").groupBy("_b").agg(F.sort_array(F.collect_set("_i")).alias("_s")).where(F.size("_s") > 1).select("_s")
    sets = staged(sets, "baskets")
    n = sets.agg(F.sum(F.size("_s").cast("long") * (F.size("_s") - 1) / 2)).first()[0]
    pairs = sets.select("_s", F.posexplode("_s").alias("_k", "a_id")).select("a_id", F.explode(F.slice("_s", c("_k") + 2, F.size("_s"))).alias("b_id"))
    return pairs.repartition(parts(int(n or 0)), "a_id", "b_id").groupBy("a_id", "b_id").agg(F.count(F.lit(1)).alias("shared"))
