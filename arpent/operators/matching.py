"""Candidates to decisions: certain, ambiguous or rejected, never an arbitrary winner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def resolve(candidates: DataFrame, group: str, confidence: str, tie: str, certain: float = 0.9, reject: float = 0.5, delta: float = 0.05, allow_multiple: bool = False, critical: str | None = None) -> DataFrame:
    """A decision for each candidate of a group. The best is certain from ``certain`` on, ambiguous from ``reject`` on;
    candidates within ``delta`` of a best that has a rival that close are all ambiguous. With ``critical``, a column of truth
    values, ``blocks_publication`` marks the critical candidates that stay ambiguous; null is not critical."""
    order = Window.partitionBy(group).orderBy(F.desc(confidence), tie)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = candidates.withColumns({"_k": F.row_number().over(order), "_top": F.max(confidence).over(whole), "_second": F.nth_value(confidence, 2).over(whole)})
    c, top = F.col(confidence), F.col("_top")
    close = F.lit(not allow_multiple) & F.coalesce(F.round(top - F.col("_second"), 9) <= delta, F.lit(False))
    decision = (
        F.when(F.lit(allow_multiple) & (c >= certain), "certain")
        .when(close & (F.round(top - c, 9) <= delta), "ambiguous")
        .when((F.col("_k") == 1) & (c >= certain), "certain")
        .when((F.col("_k") == 1) & (c >= reject), "ambiguous")
        .otherwise("rejected")
    )
    rows = rows.withColumn("decision", decision).drop("_k", "_top", "_second")
    return rows.withColumn("blocks_publication", F.coalesce(critical, F.lit(False)) & (F.col("decision") == "ambiguous")) if critical else rows


def unique_winner(shares: DataFrame, key: str, share: str) -> DataFrame:
    """The first rank with no tie is certain; a tie at the top, or a share of zero or null, is never."""
    rank = F.rank().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(share)))
    ties = F.count(F.lit(1)).over(Window.partitionBy(key, share))
    rows = shares.withColumns({"_rank": rank, "_ties": ties})
    some = F.coalesce(F.col(share) > 0, F.lit(False))
    first = F.col("_rank") == 1
    decision = F.when(first & some & (F.col("_ties") == 1), "certain").when(first & some, "ambiguous").otherwise("rejected")
    rationale = (
        F.when(F.col(share).isNull(), "share_missing").when(~some, "share_zero").when(first & (F.col("_ties") == 1), "unique_maximum").when(first, "tied_maximum").otherwise("smaller_share")
    )
    return rows.select(*shares.columns, decision.alias("decision"), rationale.alias("rationale"))


def decision_metrics(candidates: DataFrame, entities: DataFrame, entity: str, area: str, decision: str = "decision") -> DataFrame:
    """By area: entities in four classes, the best decision of each counting; areas and entities without any stay."""
    has = lambda d: F.coalesce(F.bool_or(F.col(decision) == d), F.lit(False))
    best = candidates.groupBy(entity).agg(*[has(d).alias(f"_{d}") for d in ("certain", "ambiguous", "rejected")])
    state = F.when(F.col("_certain"), "certain").when(F.col("_ambiguous"), "ambiguous").when(F.col("_rejected"), "rejected").otherwise("unmatched")
    rows = entities.join(best, entity, "left").withColumn("_state", state)
    n = [F.count_if((F.col("_state") == s) & F.col(entity).isNotNull()).alias(s) for s in ("certain", "ambiguous", "rejected", "unmatched")]
    out = rows.groupBy(area).agg(F.count(entity).alias("entities"), *n)
    return out.withColumn("match_rate", F.round(F.try_divide(F.col("certain").cast("double"), F.col("entities")), 4))


def adopt_identifier(links: DataFrame, entity: str, identifier: str) -> DataFrame:
    """An entity takes an identifier when exactly one certain link offers one."""
    certain = links.where("decision = 'certain'").groupBy(entity).agg(F.count_distinct(identifier).alias("_n"), F.min(identifier).alias("adopted_id"))
    return certain.where("_n = 1").drop("_n")


def attachment_chain(entities: DataFrame, entity: str, steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Links of the first step that has any for an entity; later steps only see entities without one."""
    out, left = None, entities.select(entity)
    for method, links in steps:
        found = links.join(left, entity, "left_semi").withColumn("method", F.lit(method))
        out = found if out is None else out.unionByName(found)
        left = left.join(links.select(entity).distinct(), entity, "left_anti")
    return out
