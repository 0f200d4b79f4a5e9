"""The market barometer: volumes and prices, repeat-sale margins, energy labels, deed delays, conversion, coverage.

Every measure is a function from relations to one aggregate table. Relations: sales (parcel_id, commune_code,
mutation_date, property_type, price_eur, surface_m2), diagnostics (dpe_number, parcel_id, commune_code, deposited_on,
label, building_type, from_immeuble), territories (commune_code, epci_code). Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from arpent.functions.support import COMMUNE, DEPARTMENT, EPCI, grouped_quantiles, missing_support, quantile, share_pct, supported, with_scopes
from arpent.operators.asof import first_after, latest_before

ALL_LEVELS, WIDE_LEVELS = (DEPARTMENT, EPCI, COMMUNE), (DEPARTMENT, EPCI)


@dataclass(frozen=True)
class Parameters:
    """Supports and windows of the measures."""

    sales_per_cell: int = 15
    repeat_pairs: int = 15
    label_sales: int = 15
    cohort_parcels: int = 30
    repeat_min_days: int = 181
    repeat_max_days: int = 1095
    conversion_days: int = 365
    label_lookback_days: int = 730
    label_from_year: int = 2022
    entry_bands: tuple[float, ...] = (0.6, 0.8, 1.0)
    excess_threshold: float = 1.4
    curve_months: tuple[int, ...] = (1, 2, 3, 6, 9, 12)
    month_days: int = 30


def price_m2() -> Column:
    return F.col("price_eur") / F.col("surface_m2")


def usable_sales(sales: DataFrame) -> DataFrame:
    """Acts with a house or flat, a parcel, and a price and surface above zero."""
    return sales.where("property_type in ('Maison', 'Appartement') and parcel_id is not null and price_eur > 0 and surface_m2 > 0")


def volumes_and_prices(sales: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Volumes and quartiles of the price per square metre by scope, year and type."""
    cells = with_scopes(sales.withColumns({"year": F.year("mutation_date"), "_m2": price_m2()}), territories, department, ALL_LEVELS)
    keys = ["scope_type", "scope_code", "year", "property_type"]
    quartiles = {f"_q{i}": ("m2", f) for i, f in enumerate((0.25, 0.5, 0.75))}
    out = grouped_quantiles(cells.select(*keys, "_m2"), keys, [F.count(F.lit(1)).alias("sales")], {"m2": F.col("_m2")}, quartiles)
    n = F.col("sales")
    q = lambda i: supported(F.bround(F.col(f"_q{i}"), 0), n, p.sales_per_cell)
    return out.select(
        "scope_type", "scope_code", "year", "property_type", "sales", q(1).alias("median_eur_m2"), q(0).alias("q1_eur_m2"), q(2).alias("q3_eur_m2"),
        missing_support(n, p.sales_per_cell).alias("reason"),
    )


def reference_medians(sales: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """Median price per square metre of houses by commune and year, where the support is reached."""
    houses = sales.where("property_type = 'Maison'").withColumns({"year": F.year("mutation_date"), "_m2": price_m2()})
    return houses.groupBy("commune_code", "year").agg(quantile("_m2", 0.5).alias("reference_eur_m2"), F.count(F.lit(1)).alias("reference_sales")).where(
        F.col("reference_sales") >= p.sales_per_cell
    )


def successive_pairs(sales: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """Neighbouring acts of a parcel in order of day, price and surface, at least ``repeat_min_days`` apart."""
    order = Window.partitionBy("parcel_id").orderBy("mutation_date", "price_eur", "surface_m2")
    after = F.lead(F.struct("commune_code", "mutation_date", "price_eur", "surface_m2")).over(order)
    pairs = sales.withColumn("_x", after).where(F.col("_x").isNotNull())
    out = pairs.select(
        "parcel_id", F.col("_x.commune_code").alias("commune_code"), F.col("mutation_date").alias("bought_on"), F.col("_x.mutation_date").alias("sold_on"),
        F.col("price_eur").alias("entry_price_eur"), F.col("_x.price_eur").alias("exit_price_eur"), F.col("surface_m2").alias("entry_surface_m2"),
        F.col("_x.surface_m2").alias("exit_surface_m2"), F.datediff("_x.mutation_date", "mutation_date").alias("days"),
    )
    return out.where(F.col("days") >= p.repeat_min_days)


def same_day_ties(sales: DataFrame) -> DataFrame:
    """How many (parcel, day) pairs carry several acts."""
    return sales.groupBy("parcel_id", "mutation_date").count().agg(F.count_if(F.col("count") > 1).alias("same_day_ties"))


def all_combinations(sales: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """How many pairs of acts of a parcel are far enough apart, neighbours or not. Days of a parcel are counted first, and
    the pairs are days within one parcel."""
    days = sales.groupBy("parcel_id", "mutation_date").agg(F.count(F.lit(1)).alias("n"))
    a, b = days.alias("a"), days.alias("b")
    far = F.datediff(F.col("b.mutation_date"), F.col("a.mutation_date")) >= p.repeat_min_days
    both = a.join(b, (F.col("a.parcel_id") == F.col("b.parcel_id")) & far)
    return both.agg(F.coalesce(F.sum(F.col("a.n") * F.col("b.n")), F.lit(0)).cast("long").alias("all_combinations"))


def share_text(x: float) -> str:
    return f"{round(x * 100)} %"


def band_names(edges: tuple[float, ...]) -> list[str]:
    middle = [f"{share_text(a)} to {share_text(b)}" for a, b in zip(edges, edges[1:])]
    return [f"under {share_text(edges[0])} of the median", *middle, f"{share_text(edges[-1])} and more"]


def entry_band(relative: Column, edges: tuple[float, ...]) -> Column:
    """Number of the band of an entry price relative to the median."""
    out = F.lit(len(edges))
    for k in range(len(edges) - 1, -1, -1):
        out = F.when(relative < edges[k], k).otherwise(out)
    return out


def adjusted_pairs(pairs: DataFrame, references: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """Pairs with their fate in the funnel, and for kept ones the excess over the market and the relative entry price."""
    r = lambda side: references.select(
        F.col("commune_code").alias(f"_c{side}"), F.col("year").alias(f"_y{side}"), F.col("reference_eur_m2").alias(f"_r{side}")
    )
    joined = pairs.join(r("in"), (F.col("commune_code") == F.col("_cin")) & (F.year("bought_on") == F.col("_yin")), "left")
    joined = joined.join(r("out"), (F.col("commune_code") == F.col("_cout")) & (F.year("sold_on") == F.col("_yout")), "left")
    fate = (
        F.when(F.col("days") > p.repeat_max_days, "beyond the window")
        .when(F.col("entry_surface_m2") != F.col("exit_surface_m2"), "surface changed")
        .when(F.col("_rin").isNull() | F.col("_rout").isNull(), "no reference")
        .otherwise("kept")
    )
    excess = (F.col("exit_price_eur") / F.col("entry_price_eur")) / (F.col("_rout") / F.col("_rin"))
    relative = (F.col("entry_price_eur") / F.col("entry_surface_m2")) / F.col("_rin")
    return joined.select(*pairs.columns, fate.alias("fate"), excess.alias("excess"), relative.alias("relative_entry"))


def margin_funnel(adjusted: DataFrame) -> DataFrame:
    """Counts of successive pairs by fate, as one row."""
    n = lambda f: F.count_if(F.col("fate") == f)
    return adjusted.agg(
        F.count(F.lit(1)).alias("successive_pairs"), n("beyond the window").alias("beyond_window"), n("surface changed").alias("surface_changed"),
        n("no reference").alias("without_reference"), n("kept").alias("kept"),
    )


def _spine(grouped: DataFrame, values: DataFrame) -> DataFrame:
    """Every scope with every value of a small list, so that empty cells appear."""
    return grouped.select("scope_type", "scope_code").distinct().crossJoin(values)


def margin_by_entry_price(adjusted: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Excess over the market by band of entry price; every band of a scope appears, empty or not."""
    spark = adjusted.sparkSession
    kept = adjusted.where("fate = 'kept'").withColumn("band", entry_band(F.col("relative_entry"), p.entry_bands))
    scoped = with_scopes(kept, territories, department, WIDE_LEVELS)
    bands = spark.createDataFrame(list(enumerate(band_names(p.entry_bands))), "band int, entry_band string")
    keys = ["scope_type", "scope_code", "band"]
    counts = [F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("excess") > p.excess_threshold).alias("_above")]
    cells = grouped_quantiles(scoped.select(*keys, "excess"), keys, counts, {"excess": F.col("excess")}, {"_m": ("excess", 0.5), "_q": ("excess", 0.75)})
    out = _spine(cells, bands).join(cells, ["scope_type", "scope_code", "band"], "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))
    n = F.col("pairs")
    return out.select(
        "scope_type", "scope_code", "entry_band", "pairs", supported(F.bround("_m", 2), n, p.repeat_pairs).alias("median_excess"),
        supported(F.bround("_q", 2), n, p.repeat_pairs).alias("q3_excess"), supported(share_pct(F.col("_above"), n), n, p.repeat_pairs).alias("share_above_threshold_pct"),
        missing_support(n, p.repeat_pairs).alias("reason"),
    )


def label_premium(sales: DataFrame, diagnostics: DataFrame, references: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters(), row_id: str = "sale_id") -> DataFrame:
    """Ratio of a house's price to its commune and year median, by the label of the last diagnostic before the act."""
    houses = sales.where((F.col("property_type") == "Maison") & (F.year("mutation_date") >= p.label_from_year))
    labelled = latest_before(houses, diagnostics.where("building_type = 'maison'"), "parcel_id", "mutation_date", "deposited_on", "label", "dpe_number", p.label_lookback_days, "energy_label")
    labelled = labelled.where("energy_label is not null").withColumn("year", F.year("mutation_date")).join(references, ["commune_code", "year"])
    scoped = with_scopes(labelled.withColumn("ratio", price_m2() / F.col("reference_eur_m2")), territories, department, WIDE_LEVELS)
    keys = ["scope_type", "scope_code", "energy_label"]
    quartiles = {f"_{n}": ("ratio", f) for n, f in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    cells = grouped_quantiles(scoped.select(*keys, "ratio"), keys, [F.count(F.lit(1)).alias("sales")], {"ratio": F.col("ratio")}, quartiles)
    labels = sales.sparkSession.createDataFrame([(x,) for x in "ABCDEFG"], "energy_label string")
    out = _spine(cells, labels).join(cells, ["scope_type", "scope_code", "energy_label"], "left").withColumn("sales", F.coalesce("sales", F.lit(0)))
    n = F.col("sales")
    return out.select(
        "scope_type", "scope_code", "energy_label", "sales", *[supported(F.bround(f"_{x}", 2), n, p.label_sales).alias(f"{x}_ratio") for x in ("q1", "median", "q3")],
        missing_support(n, p.label_sales).alias("reason"),
    )


def first_diagnostics(diagnostics: DataFrame) -> DataFrame:
    """The first diagnostic of each parcel, ties by number."""
    rest = [c for c in diagnostics.columns if c != "parcel_id"]
    first = diagnostics.groupBy("parcel_id").agg(F.min_by(F.struct(*rest), F.struct("deposited_on", "dpe_number")).alias("_d"))
    return first.select("parcel_id", "_d.*")


def cohort(first: DataFrame, sales: DataFrame, years: list[int] | None = None, from_immeuble: bool = False) -> DataFrame:
    """First diagnostics with the days to the first act strictly after; those made from a whole building are apart."""
    chosen = first.where(F.col("from_immeuble") == from_immeuble)
    if years is not None:
        chosen = chosen.where(F.year("deposited_on").isin(years))
    out = first_after(chosen, sales, "parcel_id", "deposited_on", "mutation_date", "first_sale")
    return out.withColumns({"days_to_deed": F.datediff("first_sale", "deposited_on"), "cohort_year": F.year("deposited_on")})


def cohort_year_ceiling(sales: DataFrame) -> DataFrame:
    """The last yearly cohort with twelve months of acts after it."""
    last = sales.agg(F.max("mutation_date").alias("last_mutation"))
    whole = F.date_format("last_mutation", "MM-dd") == "12-31"
    return last.select("last_mutation", (F.year("last_mutation") - F.when(whole, 1).otherwise(2)).alias("ceiling"))


def deed_delay(rows: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Quartiles of days from deposit to act among parcels sold in the window; the support counts the cohort."""
    scoped = with_scopes(rows, territories, department, ALL_LEVELS)
    sold = F.when(F.col("days_to_deed") <= p.conversion_days, F.col("days_to_deed").cast("double"))
    out = scoped.groupBy("scope_type", "scope_code").agg(F.count(F.lit(1)).alias("cohort_parcels"), F.count(sold).alias("sold_within_window"), *[F.percentile(sold, F.lit(f)).alias(f"_{x}") for x, f in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    n = F.col("cohort_parcels")
    return out.select("scope_type", "scope_code", "cohort_parcels", "sold_within_window", *[supported(F.bround(f"_{x}", 0), n, p.cohort_parcels).alias(f"{x}_days") for x in ("q1", "median", "q3")], missing_support(n, p.cohort_parcels).alias("reason"))


def conversion_rate(rows: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Share of each yearly cohort sold within the window, by scope."""
    scoped = with_scopes(rows, territories, department, ALL_LEVELS)
    out = scoped.groupBy("scope_type", "scope_code", "cohort_year").agg(F.count(F.lit(1)).alias("cohort_parcels"), F.count_if(F.col("days_to_deed") <= p.conversion_days).alias("sold_within_12_months"))
    n = F.col("cohort_parcels")
    return out.select("*", supported(share_pct(F.col("sold_within_12_months"), n), n, p.cohort_parcels).alias("rate_pct"), missing_support(n, p.cohort_parcels).alias("reason"))


def conversion_curve(rows: DataFrame, territories: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Cumulative share sold after each horizon of 30-day months. One pass counts all horizons."""
    scoped = with_scopes(rows, territories, department, WIDE_LEVELS)
    sold = [F.count_if(F.col("days_to_deed") <= m * p.month_days).alias(f"_m{m}") for m in p.curve_months]
    out = scoped.groupBy("scope_type", "scope_code", "cohort_year").agg(F.count(F.lit(1)).alias("cohort_parcels"), *sold)
    points = F.array(*[F.struct(F.lit(m).alias("month"), F.col(f"_m{m}").alias("sold_cumulative")) for m in p.curve_months])
    out = out.withColumn("_p", F.explode(points)).select("scope_type", "scope_code", "cohort_year", "_p.month", "cohort_parcels", "_p.sold_cumulative")
    n = F.col("cohort_parcels")
    return out.select("*", supported(share_pct(F.col("sold_cumulative"), n), n, p.cohort_parcels).alias("cumulative_pct"), missing_support(n, p.cohort_parcels).alias("reason"))


def extension_effect(pairs: DataFrame, department: str, p: Parameters = Parameters()) -> DataFrame:
    """Price ratios of resales with a larger surface, within the window and over all durations."""
    windows = F.array(F.when(F.col("days") <= p.repeat_max_days, F.lit("short")), F.lit("all"))
    wider = pairs.where("exit_surface_m2 > entry_surface_m2").withColumn("window", F.explode(windows)).where("window is not null")
    m2 = (F.col("exit_price_eur") / F.col("exit_surface_m2")) / (F.col("entry_price_eur") / F.col("entry_surface_m2"))
    ratios = wider.select("window", (F.col("exit_price_eur") / F.col("entry_price_eur")).alias("r"), m2.alias("m"))
    cells = grouped_quantiles(ratios, ["window"], [F.count(F.lit(1)).alias("pairs")], {"r": F.col("r"), "m": F.col("m")}, {"_r": ("r", 0.5), "_m": ("m", 0.5)})
    spine = pairs.sparkSession.createDataFrame([("short",), ("all",)], "window string")
    out = spine.join(cells, "window", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))
    n = F.col("pairs")
    return out.select(F.lit(DEPARTMENT).alias("scope_type"), F.lit(department).alias("scope_code"), "window", "pairs", supported(F.bround("_r", 2), n, p.repeat_pairs).alias("median_price_ratio"), supported(F.bround("_m", 2), n, p.repeat_pairs).alias("median_price_per_m2_ratio"), missing_support(n, p.repeat_pairs).alias("reason"))


def coverage_gaps(acts: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """What the barometer does not see, by commune: acts (``allocatable``) and diagnostics (``attached``) left out."""
    a = acts.groupBy("commune_code").agg(F.count(F.lit(1)).alias("mutations"), F.count_if(~F.col("allocatable")).alias("unallocatable"))
    d = diagnostics.groupBy("commune_code").agg(F.count(F.lit(1)).alias("diagnostics"), F.count_if(~F.col("attached")).alias("unattached"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = a.join(d, "commune_code", "full_outer").select("commune_code", *[zero(c).alias(c) for c in ("mutations", "unallocatable", "diagnostics", "unattached")])
    return out.select(
        F.lit(COMMUNE).alias("scope_type"), F.col("commune_code").alias("scope_code"), "mutations", F.col("unallocatable").alias("mutations_without_allocatable_price"),
        share_pct(F.col("unallocatable"), F.col("mutations")).alias("share_without_allocatable_price_pct"), "diagnostics", F.col("unattached").alias("diagnostics_without_building"),
        share_pct(F.col("unattached"), F.col("diagnostics")).alias("share_without_building_pct"), F.when((F.col("mutations") == 0) | (F.col("diagnostics") == 0), "no observation").alias("reason"),
    )
