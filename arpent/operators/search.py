"""Ranked fuzzy search over labelled entities of several kinds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from arpent.functions.scalars import address_label, id_key, similarity, trigrams

EXACT, PREFIX, LEAST = 1.0, 0.95, 0.3


def search_entities(entities: DataFrame, queries: Sequence[str], limit: int, least: float = LEAST) -> DataFrame:
    """The ``limit`` best entities (kind, entity_id, label) of each query text: 1 for its very label, 0.95 where the label
    or the letters and digits of the id begin with it, else the share of common trigrams; ties by label, kind and id.

    The queries are a short list of texts that stand in the plan as constants, so all of them take one scan; what they do
    not reach is filtered there, before the rows of a query meet."""
    labels = entities.select("kind", "entity_id", "label", address_label(F.col("label")).alias("_l"), id_key(F.col("entity_id")).alias("_id"))
    labels = labels.withColumn("_t", trigrams(F.col("label")))
    asked = entities.sparkSession.createDataFrame([(q,) for q in queries], "q string")
    asked = asked.select("q", address_label(F.col("q")).alias("_ql"), id_key(F.col("q")).alias("_qid"), trigrams(F.col("q")).alias("_qt")).collect()  # the queries themselves
    tests = []
    for r in asked:
        begins = (F.lit(r["_ql"] != "") & F.col("_l").startswith(r["_ql"])) | (F.lit(r["_qid"] != "") & F.col("_id").startswith(r["_qid"]))
        grams = F.array(*[F.lit(t) for t in r["_qt"]]).cast("array<string>")
        score = F.when(F.col("_l") == r["_ql"], EXACT).when(begins, PREFIX).otherwise(F.round(similarity(F.col("_t"), grams), 6))
        tests.append(F.struct(F.lit(r["q"]).alias("q"), score.alias("score")))
    scored = labels.select("kind", "entity_id", "label", F.explode(F.array(*tests)).alias("s")).select("s.*", "kind", "entity_id", "label").where(F.col("score") >= least)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "label", "kind", "entity_id")
    return scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit)
