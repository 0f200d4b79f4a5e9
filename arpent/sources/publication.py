"""Publication of releases in two steps, and the pointer that readers follow.

A release is first written to a folder of its own and counted; then one manifest file is put in place by a rename that
fails if the file is there already. Manifests of a scope are numbered; they are the log of its events, and the accepted one
with the highest number is the pointer. A job that dies before the rename leaves the old release as it was, two writers
cannot both take a number, and a release that is not accepted is logged but never read.

Root, scope and release are names of the caller; a root without manifests has no active release.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "scope string, number long, release string, path string, rows long, status string"


class Conflict(RuntimeError):
    """Another writer has taken the number of this event."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where, conf = jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration()
    return where, where.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf) if ":" in path else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)


def history(spark: SparkSession, root: str, scope: str) -> DataFrame:
    """The events of a scope, a row a manifest."""
    folder, fs, _ = _files(spark, f"{root}/manifests/{scope}")
    if not fs.exists(folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{root}/manifests/{scope}/*.json")


def _log(spark: SparkSession, root: str, event: dict) -> None:
    """Put the manifest of an event in place, or fail if its number is taken."""
    folder = f"{root}/manifests/{event['scope']}"
    draft, fs, context = _files(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray((json.dumps(event) + "\n").encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{event['number']:012d}.json")
    try:
        context.rename(draft, final, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"event {event['number']} of {event['scope']} is taken") from e
        raise


def stage(rows: DataFrame, root: str, release: str, partitions: tuple[str, ...] = ()) -> str:
    """Write a release to a new folder, which no reader knows yet."""
    path = f"{root}/releases/{release}-{uuid.uuid4().hex}"
    rows.write.partitionBy(*partitions).parquet(path)
    return path


def commit(spark: SparkSession, root: str, scope: str, release: str, path: str, expected: int, after: int | None = None) -> int:
    """Count a staged release, log it, and make it the active one if the count is right. Returns the number of the event.
    With ``after``, the event must directly follow that number: else somebody else was faster, a ``Conflict``."""
    rows = spark.read.parquet(path).count()
    last = history(spark, root, scope).agg(F.max("number")).first()[0] or 0
    number = (last if after is None else after) + 1
    _log(spark, root, {"scope": scope, "number": number, "release": release, "path": path, "rows": rows, "status": "accepted" if rows == expected else "refused"})
    if rows != expected:
        raise ValueError(f"{release} has {rows} rows, not {expected}")
    return number


def publish(rows: DataFrame, root: str, scope: str, release: str, expected: int, partitions: tuple[str, ...] = ()) -> int:
    """Both steps in turn. ``expected`` comes from the source, not from the rows that are written."""
    return commit(rows.sparkSession, root, scope, release, stage(rows, root, release, partitions), expected)


def active(spark: SparkSession, root: str, scope: str) -> DataFrame:
    """The rows of the active release of a scope: the last one accepted."""
    last = history(spark, root, scope).where("status = 'accepted'").orderBy(F.desc("number")).limit(1).collect()
    if not last:
        raise LookupError(f"{scope} has no accepted release")
    return spark.read.parquet(last[0]["path"])
