"""Transparent rule-based scores: rules as a table, components as weighted sums, every point with its evidence.

Rules: feature, component (null: shown only), weight, requirement, transformation, direction. Components: component,
component_weight. Inputs: subject, feature, value, local_percentile, profiled_score. The rule and component tables are
short, fixed lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arpent.operators.ranking import running_counts

NEUTRAL = 0.5


def local_percentiles(inputs: DataFrame, segment: str, feature: str, value: str) -> DataFrame:
    """Percentile of each value among those of its segment and feature: the rows before it over all rows but one. A null
    value comes first; a segment may be of any size."""
    ranks = running_counts(inputs, [segment, feature], value).select("_g", "_v", F.coalesce(F.try_divide("before", F.col("all") - 1), F.lit(0.0)).alias("local_percentile"))
    rows = inputs.withColumn("_s", F.struct(segment, feature))
    return rows.join(ranks, (F.col("_s") == F.col("_g")) & F.col(value).eqNullSafe(F.col("_v")), "left").drop("_s", "_g", "_v")


def normalised() -> Column:
    """A feature's value on 0 to 1 by its rule, null where it gives none."""
    raw = (
        F.when(F.col("value").isNull(), None)
        .when(F.col("transformation") == "local_percentile", F.col("local_percentile"))
        .when(F.col("transformation") == "profiled_score", F.col("profiled_score"))
        .otherwise(F.least(F.greatest(F.col("value"), F.lit(0.0)), F.lit(1.0)))
    )
    return F.when(F.col("direction") == "decreasing", 1 - raw).otherwise(raw)


def evidence(subjects: DataFrame, inputs: DataFrame, rules: DataFrame, components: DataFrame, neutral: float = NEUTRAL) -> DataFrame:
    """A row a subject and rule: normalised value (neutral where missing) and impact on the score."""
    grid = subjects.select("subject").distinct().crossJoin(rules.join(components, "component", "left"))  # each subject by the rules of a definition
    rows = grid.join(inputs, ["subject", "feature"], "left").withColumn("_n", normalised())
    only = (F.col("requirement") == "confidence_only") | (F.col("direction") == "confidence_only")
    value = F.when(F.col("_n").isNull() | only, F.lit(neutral)).otherwise(F.col("_n"))
    rows = rows.withColumns({"normalized": value, "missing": F.col("_n").isNull()})
    impact = F.coalesce((F.col("normalized") - neutral) * F.col("component_weight") * F.col("weight") * 100, F.lit(0.0))
    direction = F.when(impact > 1e-12, "positive").when(impact < -1e-12, "negative").otherwise("neutral")
    return rows.select("subject", "feature", "component", "weight", "component_weight", "requirement", "value", "normalized", "missing", F.round(impact, 6).alias("impact"), direction.alias("impact_direction"))


def scores(facts: DataFrame, confidence: DataFrame, confidence_weights: dict[str, float], needed: list[str], publishable: bool = True) -> DataFrame:
    """A row a subject: eligibility, score and class, confidence and level, blockers, missing features. ``facts`` is the
    evidence; ``confidence`` has a column a factor; ``needed`` are the features that eligibility asks for."""
    present = F.col("value").isNotNull()
    critical = F.col("requirement").isin("required", "confidence_only")
    names = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("feature"))))
    out = facts.groupBy("subject").agg(
        F.sum(F.col("normalized") * F.col("weight") * F.col("component_weight") * 100).alias("_score"), names(F.col("missing")).alias("_missing"),
        names(F.col("missing") & (F.col("requirement") == "required")).alias("_required"), names(F.col("feature").isin(needed) & ~present).alias("_failed"),
        F.try_divide(F.count_if(critical & present).cast("double"), F.count_if(critical)).alias("critical_coverage"),
    ).join(confidence, "subject", "left")
    out = out.withColumn("critical_coverage", F.coalesce("critical_coverage", F.lit(1.0)))
    total = F.lit(0.0)
    for factor, weight in sorted(confidence_weights.items()):
        total = total + F.col(factor) * weight
    eligible = F.size("_failed") == 0
    ok = eligible & (F.size("_required") == 0) & F.lit(publishable)
    score = F.when(eligible, F.round(F.least(F.greatest(F.col("_score"), F.lit(0.0)), F.lit(100.0)), 6))
    blockers = F.concat(F.transform("_failed", lambda x: F.concat(F.lit("eligibility:"), x)), F.transform("_required", lambda x: F.concat(F.lit("required:"), x)))
    out = out.select("subject", eligible.alias("eligible"), ok.alias("publishable"), score.alias("score"), F.round(100 * total, 6).alias("confidence"), F.array_join(blockers, ",").alias("blockers"), F.array_join("_missing", ",").alias("missing_features"))
    band = F.when(F.col("score") < 40, "low").when(F.col("score") < 60, "review").when(F.col("score") < 80, "interesting").when(F.col("score").isNotNull(), "high_priority")
    level = F.when(~F.col("publishable"), "not_publishable").when(F.col("confidence") >= 80, "high").when(F.col("confidence") >= 60, "medium").otherwise("low")
    return out.withColumns({"score_class": band, "confidence_level": level})


def without(inputs: DataFrame, features: list[str]) -> DataFrame:
    """The inputs with all values of some features taken away."""
    kept = lambda c: F.when(~F.col("feature").isin(features), F.col(c)).alias(c)
    return inputs.select(*[kept(c) if c in ("value", "local_percentile", "profiled_score") else c for c in inputs.columns]) if features else inputs


def ablation(full: DataFrame, ablated: DataFrame) -> DataFrame:
    """Two scorings of the same subjects, with and without a set of features (``without``): both scores, their difference,
    null where either has none, and whether the second may still be published."""
    one = full.select("subject", F.col("score").alias("full_score"))
    two = ablated.select("subject", F.col("score").alias("ablated_score"), F.col("publishable").alias("ablated_publishable"), F.col("blockers").alias("ablated_blockers"))
    return one.join(two, "subject").withColumn("score_delta", F.round(F.col("ablated_score") - F.col("full_score"), 6))


def definition_gate(rules: DataFrame, components: DataFrame) -> DataFrame:
    """Blockers of a score definition: no rules, weights that do not sum to one."""
    off = lambda c: F.abs(c - 1) > 1e-6
    per = rules.where("component is not null").groupBy("definition", "component").agg(F.sum("weight").alias("w"))
    bad = per.groupBy("definition").agg(F.count_if(off(F.col("w"))).alias("bad_components"))
    c = components.groupBy("definition").agg(F.sum("component_weight").alias("_c"))
    out = c.join(bad, "definition", "left")
    list_ = F.array_compact(F.array(F.when(F.col("bad_components").isNull(), "no_rules"), F.when(off(F.col("_c")), "component_weights"), F.when(F.col("bad_components") > 0, "feature_weights")))
    return out.select("definition", F.array_join(list_, ",").alias("blockers"), (F.size(list_) == 0).alias("publishable"))


COSTS = ("purchase", "works", "fees", "financing", "holding")


def scenarios(rows: DataFrame, target_return: float = 0.15) -> DataFrame:
    """Three financial cases from low, central and high amounts of the costs and the resale: total cost, net margin, return
    on cost (0 without cost), and the purchase price at which the target return is just met."""
    cases = [("prudent", "high", "low"), ("central", "central", "central"), ("optimistic", "low", "high")]
    other = lambda c: sum((F.col(f"{k}_{c}") for k in COSTS[2:]), F.col(f"works_{c}"))
    parts = [F.struct(F.lit(n).alias("case"), F.col(f"purchase_{c}").alias("_p"), other(c).alias("_o"), F.col(f"resale_{r}").alias("resale_eur")) for n, c, r in cases]
    long = rows.select("subject", F.explode(F.array(*parts)).alias("s")).select("subject", "s.*")
    cost, margin = F.col("_p") + F.col("_o"), F.col("resale_eur") - F.col("_p") - F.col("_o")
    return long.select(
        "subject", "case", F.round(cost, 4).alias("total_cost_eur"), "resale_eur", F.round(margin, 4).alias("net_margin_eur"),
        F.when(cost > 0, F.round(margin / cost, 6)).otherwise(0.0).alias("return_on_cost"),
        F.round(F.greatest(F.col("resale_eur") / (1 + target_return) - F.col("_o"), F.lit(0.0)), 4).alias("break_even_purchase_price_eur"),
    )


def input_digest(inputs: DataFrame, subject: str, columns: list[str]) -> DataFrame:
    """A digest of all inputs of a subject, the same in whatever order they come."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return inputs.groupBy(subject).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))
