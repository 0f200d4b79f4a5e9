"""Barometer queries on the star tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.plans import barometer as B
from arpent.plans.catalog import DIAGNOSTICS, SALES, TERRITORIES, diagnostics, query, sales, table, territories

DEP = "35"
P = B.Parameters(sales_per_cell=45, repeat_pairs=40, label_sales=20, cohort_parcels=60, label_from_year=1996)
BASE = f"WITH sales AS ({SALES}), diagnostics AS ({DIAGNOSTICS}), territories AS ({TERRITORIES})"


def scoped(name: str, wide: bool = False) -> str:
    """SQL of the rows of a relation by scope."""
    parts = [
        f"SELECT *, 'department' AS scope_type, '{DEP}' AS scope_code FROM {name}",
        f"SELECT {name}.*, 'epci', epci_code FROM {name} JOIN territories ON {name}.commune_code = territories.commune_code WHERE epci_code IS NOT NULL",
    ]
    return " UNION ALL ".join(parts if wide else [*parts, f"SELECT *, 'commune', commune_code FROM {name}"])


def reason(n: str, least: int) -> str:
    return f"CASE WHEN {n} < {least} THEN 'insufficient support: ' || {n} || ' < {least}' END AS reason"


REFERENCES = f"""refs AS (SELECT commune_code, year(mutation_date) AS year, quantile_cont(price_eur / surface_m2, 0.5) AS reference_eur_m2, count(*) AS reference_sales
  FROM sales WHERE property_type = 'Maison' GROUP BY ALL HAVING count(*) >= {P.sales_per_cell})"""
PAIRS = f"""pairs AS (SELECT * FROM (SELECT parcel_id, lead(commune_code) OVER w AS commune_code, mutation_date AS bought_on, lead(mutation_date) OVER w AS sold_on,
    price_eur AS entry_price_eur, lead(price_eur) OVER w AS exit_price_eur, surface_m2 AS entry_surface_m2, lead(surface_m2) OVER w AS exit_surface_m2,
    date_diff('day', mutation_date, lead(mutation_date) OVER w) AS days
  FROM sales WINDOW w AS (PARTITION BY parcel_id ORDER BY mutation_date, price_eur, surface_m2)) WHERE days >= {P.repeat_min_days})"""
FIRST = """firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY deposited_on, dpe_number) AS k FROM diagnostics) WHERE k = 1)"""
COHORT = f"""{FIRST}, cohort AS (SELECT f.parcel_id, f.commune_code, f.label, year(f.deposited_on) AS cohort_year, f.deposited_on, f.dpe_number, f.building_type,
    (SELECT min(mutation_date) FROM sales s WHERE s.parcel_id = f.parcel_id AND s.mutation_date > f.deposited_on) AS first_sale,
    date_diff('day', f.deposited_on, (SELECT min(mutation_date) FROM sales s WHERE s.parcel_id = f.parcel_id AND s.mutation_date > f.deposited_on)) AS days_to_deed
  FROM firsts f WHERE NOT from_immeuble)"""
ADJUSTED = f"""adjusted AS (SELECT p.*, CASE WHEN days > {P.repeat_max_days} THEN 'beyond the window' WHEN entry_surface_m2 <> exit_surface_m2 THEN 'surface changed'
    WHEN a.reference_eur_m2 IS NULL OR b.reference_eur_m2 IS NULL THEN 'no reference' ELSE 'kept' END AS fate,
    (exit_price_eur / entry_price_eur) / (b.reference_eur_m2 / a.reference_eur_m2) AS excess, (entry_price_eur / entry_surface_m2) / a.reference_eur_m2 AS relative_entry
  FROM pairs p LEFT JOIN refs a ON p.commune_code = a.commune_code AND year(p.bought_on) = a.year LEFT JOIN refs b ON p.commune_code = b.commune_code AND year(p.sold_on) = b.year)"""


def _pairs(s, d):
    return B.successive_pairs(B.usable_sales(sales(s, d)), P)


def _cohort(s, d):
    return B.cohort(B.first_diagnostics(diagnostics(s, d)), sales(s, d))


@query("bar_volumes_prices", f"""{BASE}, x AS (SELECT commune_code, property_type, year(mutation_date) AS year, price_eur / surface_m2 AS v FROM sales), s AS ({scoped("x")})
SELECT scope_type, scope_code, year::INT AS year, property_type, count(*) AS sales,
  CASE WHEN count(*) >= {P.sales_per_cell} THEN round_even(quantile_cont(v, 0.5), 0) END AS median_eur_m2, CASE WHEN count(*) >= {P.sales_per_cell} THEN round_even(quantile_cont(v, 0.25), 0) END AS q1_eur_m2,
  CASE WHEN count(*) >= {P.sales_per_cell} THEN round_even(quantile_cont(v, 0.75), 0) END AS q3_eur_m2, {reason("count(*)", P.sales_per_cell)}
FROM s GROUP BY scope_type, scope_code, year, property_type""")  # fmt: skip
def bar_volumes_prices(spark, sf):
    return B.volumes_and_prices(B.usable_sales(sales(spark, sf)), territories(spark, sf), DEP, P)


@query("bar_reference_medians", f"{BASE}, {REFERENCES} SELECT commune_code, year::INT AS year, round(reference_eur_m2, 2) AS reference_eur_m2, reference_sales FROM refs")
def bar_reference_medians(spark, sf):
    return B.reference_medians(sales(spark, sf), P).withColumn("reference_eur_m2", F.round("reference_eur_m2", 2))


@query("bar_successive_pairs", f"{BASE}, {PAIRS} SELECT * REPLACE (days::INT AS days) FROM pairs")
def bar_successive_pairs(spark, sf):
    return _pairs(spark, sf)


@query("bar_pair_controls", f"""{BASE}, {PAIRS}, t AS (SELECT count(*) AS n FROM (SELECT 1 FROM sales GROUP BY parcel_id, mutation_date HAVING count(*) > 1)),
c AS (SELECT count(*) AS n FROM sales a JOIN sales b ON a.parcel_id = b.parcel_id AND date_diff('day', a.mutation_date, b.mutation_date) >= {P.repeat_min_days})
SELECT t.n AS same_day_ties, c.n AS all_combinations, (SELECT count(*) FROM pairs) AS successive_pairs FROM t, c""")  # fmt: skip
def bar_pair_controls(spark, sf):
    s = sales(spark, sf)
    pairs = B.successive_pairs(s, P).agg(F.count(F.lit(1)).alias("successive_pairs"))
    return B.same_day_ties(s).crossJoin(B.all_combinations(s, P)).crossJoin(pairs)  # three tables of one row


@query("bar_margin_funnel", f"""{BASE}, {REFERENCES}, {PAIRS}, {ADJUSTED} SELECT count(*) AS successive_pairs, count(*) FILTER (WHERE fate = 'beyond the window') AS beyond_window,
count(*) FILTER (WHERE fate = 'surface changed') AS surface_changed, count(*) FILTER (WHERE fate = 'no reference') AS without_reference, count(*) FILTER (WHERE fate = 'kept') AS kept FROM adjusted""")  # fmt: skip
def bar_margin_funnel(spark, sf):
    return B.margin_funnel(B.adjusted_pairs(_pairs(spark, sf), B.reference_medians(sales(spark, sf), P), P))


@query("bar_margin_by_entry", f"""{BASE}, {REFERENCES}, {PAIRS}, {ADJUSTED}, k AS (SELECT * FROM adjusted WHERE fate = 'kept'), s AS ({scoped("k", True)}),
bands(band, lo, hi) AS (VALUES ('under 60 % of the median', -1e18, 0.6), ('60 % to 80 %', 0.6, 0.8), ('80 % to 100 %', 0.8, 1.0), ('100 % and more', 1.0, 1e18)),
g AS (SELECT DISTINCT scope_type, scope_code FROM s)
SELECT g.scope_type, g.scope_code, band AS entry_band, count(excess) AS pairs, CASE WHEN count(excess) >= {P.repeat_pairs} THEN round_even(quantile_cont(excess, 0.5), 2) END AS median_excess,
  CASE WHEN count(excess) >= {P.repeat_pairs} THEN round_even(quantile_cont(excess, 0.75), 2) END AS q3_excess,
  CASE WHEN count(excess) >= {P.repeat_pairs} THEN round_even(100.0::DOUBLE * count(*) FILTER (WHERE excess > {P.excess_threshold}) / count(excess), 1) END AS share_above_threshold_pct, {reason("count(excess)", P.repeat_pairs)}
FROM g CROSS JOIN bands LEFT JOIN s ON s.scope_type = g.scope_type AND s.scope_code = g.scope_code AND s.relative_entry >= lo AND s.relative_entry < hi GROUP BY g.scope_type, g.scope_code, band""")  # fmt: skip
def bar_margin_by_entry(spark, sf):
    adjusted = B.adjusted_pairs(_pairs(spark, sf), B.reference_medians(sales(spark, sf), P), P)
    return B.margin_by_entry_price(adjusted, territories(spark, sf), DEP, P)


@query("bar_label_premium", f"""{BASE}, {REFERENCES}, l AS (
  SELECT s.sale_id, s.commune_code, s.price_eur / s.surface_m2 / r.reference_eur_m2 AS ratio, arg_max(d.label, (d.deposited_on, d.dpe_number)) AS energy_label
  FROM sales s JOIN diagnostics d ON d.parcel_id = s.parcel_id AND d.label IS NOT NULL AND d.building_type = 'maison' AND d.deposited_on <= s.mutation_date AND d.deposited_on > s.mutation_date - {P.label_lookback_days}
  JOIN refs r ON r.commune_code = s.commune_code AND r.year = year(s.mutation_date)
  WHERE s.property_type = 'Maison' AND year(s.mutation_date) >= {P.label_from_year} GROUP BY ALL), s AS ({scoped("l", True)}), g AS (SELECT DISTINCT scope_type, scope_code FROM s)
SELECT g.scope_type, g.scope_code, e.energy_label, count(ratio) AS sales, CASE WHEN count(ratio) >= {P.label_sales} THEN round_even(quantile_cont(ratio, 0.25), 2) END AS q1_ratio,
  CASE WHEN count(ratio) >= {P.label_sales} THEN round_even(quantile_cont(ratio, 0.5), 2) END AS median_ratio, CASE WHEN count(ratio) >= {P.label_sales} THEN round_even(quantile_cont(ratio, 0.75), 2) END AS q3_ratio,
  {reason("count(ratio)", P.label_sales)}
FROM g CROSS JOIN (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G']) AS energy_label) e LEFT JOIN s ON s.scope_type = g.scope_type AND s.scope_code = g.scope_code AND s.energy_label = e.energy_label
GROUP BY g.scope_type, g.scope_code, e.energy_label""")  # fmt: skip
def bar_label_premium(spark, sf):
    s = B.usable_sales(sales(spark, sf))
    return B.label_premium(s, diagnostics(spark, sf), B.reference_medians(s, P), territories(spark, sf), DEP, P)


@query("bar_first_diagnostics", f"{BASE}, {FIRST} SELECT * EXCLUDE (k) FROM firsts")
def bar_first_diagnostics(spark, sf):
    return B.first_diagnostics(diagnostics(spark, sf))


@query("bar_cohort", f"{BASE}, {COHORT} SELECT parcel_id, commune_code, label, cohort_year::INT AS cohort_year, deposited_on, first_sale, days_to_deed::INT AS days_to_deed FROM cohort")
def bar_cohort(spark, sf):
    return _cohort(spark, sf).select("parcel_id", "commune_code", "label", "cohort_year", "deposited_on", "first_sale", "days_to_deed")


@query("bar_excluded_cohort", f"""{BASE}, {FIRST} SELECT year(deposited_on)::INT AS cohort_year, count(*) FILTER (WHERE from_immeuble) AS excluded, count(*) FILTER (WHERE NOT from_immeuble) AS kept FROM firsts GROUP BY ALL""")
def bar_excluded_cohort(spark, sf):
    first = B.first_diagnostics(diagnostics(spark, sf))
    return first.groupBy(F.year("deposited_on").alias("cohort_year")).agg(F.count_if("from_immeuble").alias("excluded"), F.count_if(~F.col("from_immeuble")).alias("kept"))


@query("bar_cohort_ceiling", f"{BASE} SELECT max(mutation_date) AS last_mutation, (year(max(mutation_date)) - CASE WHEN strftime(max(mutation_date), '%m-%d') = '12-31' THEN 1 ELSE 2 END)::INT AS ceiling FROM sales")
def bar_cohort_ceiling(spark, sf):
    return B.cohort_year_ceiling(sales(spark, sf))


_Q = lambda f: f"CASE WHEN count(*) >= {P.cohort_parcels} THEN round_even(quantile_cont(CASE WHEN days_to_deed <= {P.conversion_days} THEN days_to_deed::DOUBLE END, {f}), 0) END"


@query("bar_deed_delay", f"""{BASE}, {COHORT}, s AS ({scoped("cohort")}) SELECT scope_type, scope_code, count(*) AS cohort_parcels, count(*) FILTER (WHERE days_to_deed <= {P.conversion_days}) AS sold_within_window,
{_Q(0.25)} AS q1_days, {_Q(0.5)} AS median_days, {_Q(0.75)} AS q3_days, {reason("count(*)", P.cohort_parcels)} FROM s GROUP BY scope_type, scope_code""")  # fmt: skip
def bar_deed_delay(spark, sf):
    return B.deed_delay(_cohort(spark, sf), territories(spark, sf), DEP, P)


@query("bar_conversion_rate", f"""{BASE}, {COHORT}, s AS ({scoped("cohort")}) SELECT scope_type, scope_code, cohort_year::INT AS cohort_year, count(*) AS cohort_parcels,
count(*) FILTER (WHERE days_to_deed <= {P.conversion_days}) AS sold_within_12_months, CASE WHEN count(*) >= {P.cohort_parcels} THEN round_even(100.0::DOUBLE * count(*) FILTER (WHERE days_to_deed <= {P.conversion_days}) / count(*), 1) END AS rate_pct,
{reason("count(*)", P.cohort_parcels)} FROM s GROUP BY scope_type, scope_code, cohort_year""")  # fmt: skip
def bar_conversion_rate(spark, sf):
    return B.conversion_rate(_cohort(spark, sf), territories(spark, sf), DEP, P)


@query("bar_conversion_curve", f"""{BASE}, {COHORT}, s AS ({scoped("cohort", True)}) SELECT scope_type, scope_code, cohort_year::INT AS cohort_year, month, count(*) AS cohort_parcels,
count(*) FILTER (WHERE days_to_deed <= 30 * month) AS sold_cumulative, CASE WHEN count(*) >= {P.cohort_parcels} THEN round_even(100.0::DOUBLE * count(*) FILTER (WHERE days_to_deed <= 30 * month) / count(*), 1) END AS cumulative_pct,
{reason("count(*)", P.cohort_parcels)} FROM s, (SELECT unnest([1, 2, 3, 6, 9, 12])::INT AS month) GROUP BY scope_type, scope_code, cohort_year, month""")  # fmt: skip
def bar_conversion_curve(spark, sf):
    return B.conversion_curve(_cohort(spark, sf), territories(spark, sf), DEP, P)


@query("bar_extension_effect", f"""{BASE}, {PAIRS}, x AS (SELECT *, unnest(CASE WHEN days <= {P.repeat_max_days} THEN ['short', 'all'] ELSE ['all'] END) AS window_name FROM pairs WHERE exit_surface_m2 > entry_surface_m2)
SELECT 'department' AS scope_type, '{DEP}' AS scope_code, w.name AS "window", count(x.days) AS pairs, CASE WHEN count(x.days) >= {P.repeat_pairs} THEN round_even(quantile_cont(exit_price_eur / entry_price_eur, 0.5), 2) END AS median_price_ratio,
CASE WHEN count(x.days) >= {P.repeat_pairs} THEN round_even(quantile_cont((exit_price_eur / exit_surface_m2) / (entry_price_eur / entry_surface_m2), 0.5), 2) END AS median_price_per_m2_ratio, {reason("count(x.days)", P.repeat_pairs)}
FROM (VALUES ('short'), ('all')) w(name) LEFT JOIN x ON x.window_name = w.name GROUP BY w.name""")  # fmt: skip
def bar_extension_effect(spark, sf):
    return B.extension_effect(_pairs(spark, sf), DEP, P)


@query("bar_coverage_gaps", f"""{BASE}, a AS (SELECT commune_code, count(*) AS m, count(*) FILTER (WHERE sale_id % 9 = 0) AS u FROM sales GROUP BY ALL),
d AS (SELECT commune_code, count(*) AS n, count(*) FILTER (WHERE label IS NULL) AS u FROM diagnostics GROUP BY ALL),
j AS (SELECT coalesce(a.commune_code, d.commune_code) AS c, coalesce(m, 0) AS m, coalesce(a.u, 0) AS mu, coalesce(n, 0) AS n, coalesce(d.u, 0) AS nu FROM a FULL JOIN d ON a.commune_code = d.commune_code)
SELECT 'commune' AS scope_type, c AS scope_code, m AS mutations, mu AS mutations_without_allocatable_price, CASE WHEN m > 0 THEN round_even(100.0::DOUBLE * mu / m, 1) END AS share_without_allocatable_price_pct,
n AS diagnostics, nu AS diagnostics_without_building, CASE WHEN n > 0 THEN round_even(100.0::DOUBLE * nu / n, 1) END AS share_without_building_pct, CASE WHEN m = 0 OR n = 0 THEN 'no observation' END AS reason FROM j""")  # fmt: skip
def bar_coverage_gaps(spark, sf):
    acts = sales(spark, sf).withColumn("allocatable", F.col("sale_id") % 9 != 0)
    return B.coverage_gaps(acts, diagnostics(spark, sf).withColumn("attached", F.col("label").isNotNull()))


@query("bar_strict_conversion", f"""{BASE.replace("WITH sales AS", "WITH every_sale AS")}, sales AS (SELECT * FROM every_sale WHERE property_type = 'Maison'), {COHORT}, s AS ({scoped("cohort")})
SELECT scope_type, scope_code, cohort_year::INT AS cohort_year, count(*) AS cohort_parcels, count(*) FILTER (WHERE days_to_deed <= {P.conversion_days}) AS sold_within_12_months,
CASE WHEN count(*) >= {P.cohort_parcels} THEN round_even(100.0::DOUBLE * count(*) FILTER (WHERE days_to_deed <= {P.conversion_days}) / count(*), 1) END AS rate_pct, {reason("count(*)", P.cohort_parcels)} FROM s GROUP BY scope_type, scope_code, cohort_year""")  # fmt: skip
def bar_strict_conversion(spark, sf):
    rows = B.cohort(B.first_diagnostics(diagnostics(spark, sf)), sales(spark, sf).where("property_type = 'Maison'"))
    return B.conversion_rate(rows, territories(spark, sf), DEP, P)


@query("bar_publishable_scopes", f"""{BASE}, x AS (SELECT commune_code, property_type, year(mutation_date) AS year FROM sales), s AS ({scoped("x", True)})
SELECT DISTINCT scope_type, scope_code FROM (SELECT scope_type, scope_code, year, property_type FROM s GROUP BY ALL HAVING count(*) >= {P.sales_per_cell})""")  # fmt: skip
def bar_publishable_scopes(spark, sf):
    """Department and areas with support on at least one measure."""
    rows = B.volumes_and_prices(sales(spark, sf), territories(spark, sf), DEP, P)
    return rows.where("reason is null and scope_type <> 'commune'").select("scope_type", "scope_code").distinct()


# --- Probes: the same relations under other groupings -------------------------------------------------------------


@query("probe_conversion_by_label", f"""{BASE}, {COHORT} SELECT coalesce(label, '?') AS label, count(*) AS n, count(*) FILTER (WHERE days_to_deed <= 365) AS sold, round_even(100.0::DOUBLE * count(*) FILTER (WHERE days_to_deed <= 365) / count(*), 1) AS rate_pct FROM cohort GROUP BY 1""")
def probe_conversion_by_label(spark, sf):
    rows = _cohort(spark, sf).groupBy(F.coalesce("label", F.lit("?")).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("days_to_deed") <= 365).alias("sold"))
    return rows.withColumn("rate_pct", B.share_pct(F.col("sold"), F.col("n")))


@query("probe_unequal_followup_curve", f"""{BASE}, {COHORT} SELECT cohort_year::INT AS cohort_year, horizon, count(*) AS n, count(*) FILTER (WHERE days_to_deed <= horizon) AS sold
FROM cohort, (VALUES (90), (180), (365), (730)) h(horizon) WHERE horizon <= CASE WHEN cohort_year < 1998 THEN 730 ELSE 365 END GROUP BY ALL""")  # fmt: skip
def probe_unequal_followup_curve(spark, sf):
    horizons = spark.createDataFrame([(90,), (180,), (365,), (730,)], "horizon int")
    followed = F.col("horizon") <= F.when(F.col("cohort_year") < 1998, 730).otherwise(365)
    rows = _cohort(spark, sf).crossJoin(horizons).where(followed)  # four horizons
    return rows.groupBy("cohort_year", "horizon").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("days_to_deed") <= F.col("horizon")).alias("sold"))


@query("probe_monthly_deposits", f"""{BASE}, {COHORT}, d AS (SELECT date_trunc('month', deposited_on)::DATE AS deposit_month, count(*) AS deposits FROM diagnostics GROUP BY 1),
f AS (SELECT date_trunc('month', deposited_on)::DATE AS deposit_month, count(*) AS first_deposits, count(*) FILTER (WHERE days_to_deed <= 365) AS sold FROM cohort GROUP BY 1)
SELECT d.deposit_month, deposits, coalesce(first_deposits, 0) AS first_deposits, coalesce(sold, 0) AS sold FROM d LEFT JOIN f ON d.deposit_month = f.deposit_month""")  # fmt: skip
def probe_monthly_deposits(spark, sf):
    month = F.trunc("deposited_on", "month").alias("deposit_month")
    every = diagnostics(spark, sf).groupBy(month).agg(F.count(F.lit(1)).alias("deposits"))
    firsts = _cohort(spark, sf).groupBy(month).agg(F.count(F.lit(1)).alias("first_deposits"), F.count_if(F.col("days_to_deed") <= 365).alias("sold"))
    return every.join(firsts, "deposit_month", "left").select("deposit_month", "deposits", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("first_deposits", "sold")])


@query("probe_filtered_cohorts", f"""{BASE}, {FIRST} SELECT 'certain' AS filter_name, count(*) AS n FROM firsts WHERE NOT from_immeuble UNION ALL SELECT 'all relations', count(*) FROM firsts
UNION ALL SELECT 'not first', count(*) FROM diagnostics d WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.parcel_id = d.parcel_id AND f.deposited_on = d.deposited_on)""")  # fmt: skip
def probe_filtered_cohorts(spark, sf):
    d = diagnostics(spark, sf)
    first = B.first_diagnostics(d)
    n = lambda rows, name: rows.agg(F.lit(name).alias("filter_name"), F.count(F.lit(1)).alias("n"))
    later = d.join(first, ["parcel_id", "deposited_on"], "left_anti")
    return n(first.where("not from_immeuble"), "certain").unionByName(n(first, "all relations")).unionByName(n(later, "not first"))


@query("probe_largest_communes_delay", f"""{BASE}, {COHORT} SELECT commune_code, count(*) AS n, quantile_cont(CASE WHEN days_to_deed <= 365 THEN days_to_deed::DOUBLE END, 0.5) AS median_days,
round_even(100.0::DOUBLE * count(*) FILTER (WHERE days_to_deed <= 365) / count(*), 1) AS rate_pct FROM cohort GROUP BY 1 ORDER BY n DESC, commune_code LIMIT 10""")  # fmt: skip
def probe_largest_communes_delay(spark, sf):
    sold = F.when(F.col("days_to_deed") <= 365, F.col("days_to_deed").cast("double"))
    rows = _cohort(spark, sf).groupBy("commune_code").agg(F.count(F.lit(1)).alias("n"), F.percentile(sold, F.lit(0.5)).alias("median_days"), F.count(sold).alias("_sold"))
    return rows.orderBy(F.desc("n"), "commune_code").limit(10).select("commune_code", "n", "median_days", B.share_pct(F.col("_sold"), F.col("n")).alias("rate_pct"))


_YEARS = "(days / 365.25)"


@query("probe_repeat_sales", f"""{BASE}, {PAIRS} SELECT count(*) AS n, round(quantile_cont({_YEARS}, 0.5), 4) AS median_years, round(quantile_cont(exit_price_eur / entry_price_eur, 0.5), 4) AS median_ratio,
round(quantile_cont(pow(exit_price_eur / entry_price_eur, 1 / {_YEARS}), 0.5), 4) AS median_annual FROM pairs""")  # fmt: skip
def probe_repeat_sales(spark, sf):
    years, ratio = F.col("days") / 365.25, F.col("exit_price_eur") / F.col("entry_price_eur")
    rows = _pairs(spark, sf).select(years.alias("years"), ratio.alias("ratio"))
    values = {"years": F.col("years"), "ratio": F.col("ratio"), "annual": F.pow("ratio", 1 / F.col("years"))}
    out = B.grouped_quantiles(rows, [], [F.count(F.lit(1)).alias("n")], values, {f"median_{v}": (v, 0.5) for v in values})
    return out.select("n", *[F.round(f"median_{v}", 4).alias(f"median_{v}") for v in values])


_BAND = f"CASE WHEN {_YEARS} < 1 THEN 'under 1' WHEN {_YEARS} < 3 THEN '1 to 3' ELSE '3 and more' END"


@query("probe_holding_bands", f"""{BASE}, {PAIRS} SELECT {_BAND} AS holding_band, count(*) AS n, round(quantile_cont(exit_price_eur / entry_price_eur, 0.25), 4) AS q1, round(quantile_cont(exit_price_eur / entry_price_eur, 0.75), 4) AS q3,
round_even(100.0::DOUBLE * count(*) FILTER (WHERE entry_surface_m2 <> exit_surface_m2) / count(*), 1) AS changed_surface_pct FROM pairs GROUP BY 1""")  # fmt: skip
def probe_holding_bands(spark, sf):
    ratio = F.col("exit_price_eur") / F.col("entry_price_eur")
    rows = _pairs(spark, sf).select(F.expr(_BAND).alias("holding_band"), ratio.alias("ratio"), (F.col("entry_surface_m2") != F.col("exit_surface_m2")).alias("changed"))
    counts = [F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("_c")]
    out = B.grouped_quantiles(rows, ["holding_band"], counts, {"ratio": F.col("ratio")}, {"q1": ("ratio", 0.25), "q3": ("ratio", 0.75)})
    return out.select("holding_band", "n", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"), B.share_pct(F.col("_c"), F.col("n")).alias("changed_surface_pct"))


@query("probe_excess_by_holding", f"""{BASE}, {REFERENCES}, {PAIRS}, {ADJUSTED} SELECT {_BAND} AS holding_band, count(*) AS n, round(quantile_cont(excess, 0.5), 4) AS median_excess FROM adjusted WHERE excess IS NOT NULL GROUP BY 1""")
def probe_excess_by_holding(spark, sf):
    rows = B.adjusted_pairs(_pairs(spark, sf), B.reference_medians(sales(spark, sf), P), P).where("excess is not null").withColumn("holding_band", F.expr(_BAND))
    out = B.grouped_quantiles(rows.select("holding_band", "excess"), ["holding_band"], [F.count(F.lit(1)).alias("n")], {"excess": F.col("excess")}, {"m": ("excess", 0.5)})
    return out.select("holding_band", "n", F.round("m", 4).alias("median_excess"))


@query("probe_supported_communes", f"{BASE}, {PAIRS}, n AS (SELECT commune_code, count(*) AS n FROM pairs GROUP BY 1) SELECT count(*) AS communes, count(*) FILTER (WHERE n >= 300) AS at_least_300, count(*) FILTER (WHERE n >= 330) AS at_least_330 FROM n")
def probe_supported_communes(spark, sf):
    n = _pairs(spark, sf).groupBy("commune_code").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("communes"), F.count_if(F.col("n") >= 300).alias("at_least_300"), F.count_if(F.col("n") >= 330).alias("at_least_330"))
