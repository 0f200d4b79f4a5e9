"""The radar as streams: new deposits without repeats, and deposits with the acts that follow them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from arpent.plans.shipping import ship
from arpent.plans.staging import shared_dir

_PROVIDER, _KEPT = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.numRecentProgressUpdates"


def first_deposits(deposits: DataFrame, key: str, at: str, horizon: str = "31 days") -> DataFrame:
    """A deposit for each key within the horizon; state older than the horizon behind the newest event is dropped."""
    return deposits.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


class _Earliest(StatefulProcessor):
    """A key's earliest deposit so far and whether it was sent; a timer sends it once the watermark has passed it."""

    def __init__(self, key: str, id_type: str):
        self.key, self.id_type = key, id_type

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", f"micros bigint, id {self.id_type}, sent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.first.get() if self.first.exists() else None
        best = None if held is None else (held[0], held[1])
        for batch in rows:
            if held is None or not held[2]:
                least = min(zip(batch["micros"].tolist(), batch["id"].tolist()))
                best = least if best is None else min(best, least)
        if best is not None and (held is None or (not held[2] and best != (held[0], held[1]))):
            if held is not None:
                self.handle.deleteTimer(-(-held[0] // 1000))
            self.first.update((*best, False))
            self.handle.registerTimer(-(-best[0] // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        micros, id_, sent = self.first.get()
        if not sent:
            self.first.update((micros, id_, True))
            yield pd.DataFrame({self.key: [key[0]], "id": [id_], "micros": [micros]})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.first.update((int(row["micros"]), row["id"].item() if hasattr(row["id"], "item") else row["id"], True))


def delta(deposits: DataFrame, sent: DataFrame, key: str, id_: str, at: str, late: str) -> DataFrame:
    """The first deposit of each key that no earlier sending has carried: ``key``, ``id_``, ``at``, each key once ever.

    Files may come in any order: a key's earliest deposit (ties to the smaller id) is held until the watermark, ``late``
    behind the newest deposit, has passed it, so no row can come that is earlier still. A deposit that is later than that
    is dropped and counted (``work_off``). ``sent`` holds what was carried before (the same three columns); it is read when
    the stream starts for the first time. State is one narrow row a key and stays, since a key must never come again.
    Rows without key, id or time take no part."""
    spark = deposits.sparkSession
    ship(spark)
    kinds = {f.name: f.dataType.simpleString() for f in deposits.schema}
    known = F.col(key).isNotNull() & F.col(id_).isNotNull() & F.col(at).isNotNull()
    micros = F.unix_micros(F.col(at).cast("timestamp")).alias("micros")
    rows = deposits.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).where(known).select(key, F.col(id_).alias("id"), at, micros)
    before = sent.where(known).groupBy(F.col(key).cast(kinds[key]).alias(key)).agg(F.min(F.struct(micros, F.col(id_).cast(kinds[id_]).alias("id"))).alias("b")).select(key, "b.id", "b.micros")
    out = rows.groupBy(key).transformWithStateInPandas(
        _Earliest(key, kinds[id_]), f"`{key}` {kinds[key]}, id {kinds[id_]}, micros bigint", "append", "EventTime", initialState=before.groupBy(key)
    )
    return out.select(key, F.col("id").alias(id_), F.timestamp_micros("micros").alias(at))


def conversions(deposits: DataFrame, acts: DataFrame, key: str, deposit_at: str, act_at: str, within: str, late: str = "2 days", how: str = "inner") -> DataFrame:
    """Deposits with the acts of their key that follow within an interval. Both sides carry a watermark, so the state is
    bounded by the interval; with ``how="leftOuter"`` a deposit without act comes out once its interval has passed."""
    d = deposits.withWatermark(deposit_at, late).alias("d")
    a = acts.withWatermark(act_at, late).alias("a")
    at, then = F.col(f"d.{deposit_at}"), F.col(f"a.{act_at}")
    return d.join(a, (F.col(f"d.{key}") == F.col(f"a.{key}")) & (then > at) & (then <= at + F.expr(f"interval {within}")), how)


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def work_off(stream: DataFrame, home: str) -> int:
    """Work off what is there and append it to ``home``/rows; the number of rows that came behind the watermark and were
    dropped. State lies in ``home``/state, so a later call goes on where this one ended."""
    spark = stream.sparkSession
    ours = {_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", _KEPT: "1000000"}
    old = {c: spark.conf.get(c, None) for c in ours}
    for c, v in ours.items():
        spark.conf.set(c, v)
    try:
        run = stream.writeStream.format("parquet").option("path", f"{home}/rows").option("checkpointLocation", f"{home}/state").outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    return sum(op["numRowsDroppedByWatermark"] for p in run.recentProgress for op in p["stateOperators"])


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Work off what is there and return the rows. State and results lie in the shared folder; the file sink commits each
    batch once, so a restart repeats nothing."""
    spark = stream.sparkSession
    home = f"{shared_dir(spark)}/arpent-{label}-{uuid.uuid4().hex}"
    work_off(stream, home)
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")
