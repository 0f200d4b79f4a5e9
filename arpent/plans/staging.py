"""Intermediate tables in the folder that all machines share.

A staged table cuts the lineage: a lost executor costs the rereading of a file, not the work before it. The folder is
``spark.checkpoint.dir`` of the session. A local session without that setting gets a temporary folder of its own; a
cluster without it is an error, since its machines would not see each other's files.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a slash at the end."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a shared folder there")
        _own[app] = tempfile.mkdtemp(prefix="spark-arpent-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/arpent-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete the files of a table that ``staged`` has returned and that nothing will read again."""
    _delete(df.sparkSession, df._staged_at)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _written:
        _written.remove(path)


def staged_so_far() -> list[str]:
    """The paths of the staged tables that still exist."""
    return list(_written)


def clear_staged(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete the staged tables at ``paths``, or every one of this process. Call it once nothing will read them again."""
    for path in list(_written) if paths is None else paths:
        _delete(spark, path)
