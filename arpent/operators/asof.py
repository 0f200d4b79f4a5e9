"""As-of joins by key and moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_after(left: DataFrame, right: DataFrame, key: str, moment: str, event: str, name: str) -> DataFrame:
    """Each row of ``left`` with the first ``event`` of ``right`` strictly after its ``moment``, same key, or null.

    Both sides are laid in one sequence a key and the next event is read backwards over it, so the work is linear in the
    events of a key where an equi-join would pair all of a key's moments with all of its events.
    """
    events = right.select(F.col(key).alias("_key"), F.col(event).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(_row_type(left)).alias("_row"))
    moments = left.select(F.col(key).alias("_key"), F.col(moment).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    # At the same moment events come first, so what follows a moment is strictly later.
    ahead = Window.partitionBy("_key").orderBy("_at", "_side").rowsBetween(1, Window.unboundedFollowing)
    # Rows before and after are one ordered pass: the running minimum of later events, by first() over non-null ones.
    both = events.unionByName(moments).withColumn("_next", F.first(F.when(F.col("_side") == 0, F.col("_at")), ignorenulls=True).over(ahead))
    return both.where(F.col("_side") == 1).select("_row.*", F.col("_next").alias(name))


def _row_type(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("_row")).schema["_row"].dataType


def latest_before(left: DataFrame, right: DataFrame, key: str, moment: str, event: str, value: str, tie: str, days: int, name: str) -> DataFrame:
    """Each row of ``left`` with ``value`` of the latest row of ``right`` in (moment - days, moment], ties by ``tie``.

    One sequence a key, as in ``first_after``: the last event up to a moment is the only one that can be in its span."""
    found = F.struct(F.col(event).alias("at"), F.col(value).alias("value"))
    events = right.where(F.col(event).isNotNull() & F.col(value).isNotNull()).select(
        F.col(key).alias("_key"), F.col(event).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), found.alias("_event"), F.lit(None).cast(_row_type(left)).alias("_row")
    )
    nothing = lambda c: F.lit(None).cast(events.schema[c].dataType).alias(c)
    moments = left.select(F.col(key).alias("_key"), F.col(moment).alias("_at"), F.lit(1).alias("_side"), nothing("_tie"), nothing("_event"), F.struct(*left.columns).alias("_row"))
    upto = Window.partitionBy("_key").orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    both = events.unionByName(moments).withColumn("_last", F.last("_event", ignorenulls=True).over(upto)).where("_side = 1")
    near = F.col("_last.at") > F.date_sub(F.col("_at"), days)
    return both.select("_row.*", F.when(near, F.col("_last.value")).alias(name))
