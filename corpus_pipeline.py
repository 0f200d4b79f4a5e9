"""Corpus pipeline over ``documents``: quality rules, near duplicates, personal data, mixing, tokens.

A stage's result is to be written before the next stage is called, as ``run`` does: each stage deletes the tables that
the stages before it have staged, but for those that its own input still reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from arpent.llm import mixing, neardup, pieces, pii, quality, queries
from arpent.plans.staging import clear_staged, staged, staged_so_far, unstage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _left:
            read = {f.rpartition("/")[0].rpartition("/")[2] for f in docs.inputFiles()}
            done = [p for p in _left if p.rpartition("/")[2] not in read]
            clear_staged(spark, done)
            _left[:] = [p for p in _left if p not in done]
        before = set(staged_so_far())
        out = work(spark, docs, sf_dir)
        _left.extend(p for p in staged_so_far() if p not in before)
        return out

    return stage


def _whole(docs: DataFrame) -> DataFrame:
    """A document as one column, beside what an operator reads."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text", "lang", "source")


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The verdict is computed beside the text and then filters it."""
    return quality.quality_rules(_whole(docs), keep=("_doc",)).where("kept").select("_doc.*")


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: its smallest id, and of rows that repeat that id and text the first by language, source and
    length. Rows without a text all stay."""
    found = neardup.classes(docs).where("kept and text_key is not null").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    found = staged(found, "kept").alias("k")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", neardup.text_key("text").alias("text_key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_key") == F.col("k.text_key"))
    out = rows.join(found.where("k.rows = 1"), same, "left_semi").select("_doc")
    if not found.where("k.rows > 1").isEmpty():
        again = rows.join(found.where("k.rows > 1"), same, "left_semi").groupBy("doc_id", "text_key")
        out = out.unionByName(again.agg(F.min_by("_doc", F.struct("_doc.lang", "_doc.source", "_doc.n_chars")).alias("_doc")).select("_doc"))
    return out.unionByName(rows.where("text_key is null").select("_doc")).select(*[F.col("_doc")[c].alias(c) for c in docs.columns])


@_stage
def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by the kind in brackets; n_chars follows the new text."""
    spans = pii.classified(staged(pii.found_spans(_whole(docs), keep=("_doc",)), "pii"))
    rows = spans.select("_doc", F.concat("base", "added").alias("_spans"), F.col("_doc.text").alias("_text"))
    rows = rows.withColumn("_text", pii.redacted("_text", "_spans"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return rows.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, whole and as often as it takes them, in the order of their training positions."""
    key = F.struct("doc_id", F.xxhash64("text", "source").alias("h"))
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), key.alias("_key"), "doc_id", "text", "source")
    plan = mixing.mix(rows.drop("_doc"), keep=("doc_id", "_key"), whole=True, every_copy=True).where("copies > 0")
    # Rows without id that are equal in text share a decision: one row a key.
    plan = plan.groupBy(F.col("_key.doc_id").alias("_id"), F.col("_key.h").alias("_h")).agg(F.max("positions").alias("positions"))
    taken = rows.select("_doc", "_key").join(plan, F.col("_key.doc_id").eqNullSafe(F.col("_id")) & (F.col("_key.h") == F.col("_h")))
    placed = taken.select("_doc", F.col("_id"), F.explode("positions").alias("_position"))
    return placed.repartitionByRange("_position", "_id").sortWithinPartitions("_position", "_id").select(*[F.col("_doc")[c].alias(c) for c in docs.columns])


@_stage
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text that they decode to."""
    return pieces.encoded(docs, queries.piece_model(), keep=("doc_id", "lang", "source"), with_ids=True).drop("decoded")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The stages hash, sample and tokenise; SQL has no form of them. The tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each writes Parquet that the next one reads."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage{k}")
            if before is not None:
                unstage(before)
            before = docs
    return docs
