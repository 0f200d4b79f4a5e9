"""Mixing sources to target weights along a training run: a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, straight lines between knots. The integral of a schedule is
the source's share of all words. A source's documents form a stream in a fixed pseudo-random order, that of a digest of id and text, repeated when the
target exceeds the source; word number u of a target T is due when the integral of the schedule has reached u / T of its
whole, so inverting the integral gives the training position of each document, and a range sort by position is the mix.

Running sums are taken in two levels: within one of 4,096 blocks of a source, and over the blocks. No source, however
large, is a single task. Defined cases: a null text has size 0, takes nothing and has no position; the null source is a
source of its own, the last; repeated rows each hold their place; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from arpent.plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
#: No source is repeated more often than this.
MAX_REPEATS = 3
#: The schedules of weight classes 1, 2, 3: knots (time, weight). Their integrals are 1, 2 and 3; the first fades in,
#: the second stays, the third fades out.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 4.0), (0.5, 3.0), (1.0, 2.0)),
)


def integral(schedule: Sequence[tuple[float, float]]) -> float:
    """Area under a schedule."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def when_due(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of ``schedule`` reaches ``share`` (0 to 1) of its whole."""
    whole, out, before = integral(schedule), F.lit(schedule[-1][0]), []
    area = 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        need, slope = share * whole - area, (w1 - w0) / (t1 - t0)
        # Solve w0 x + slope x^2 / 2 = need, in the form that stays exact as the slope nears zero.
        x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))))
        area += (t1 - t0) * (w0 + w1) / 2
        before.append((share * whole <= area, F.lit(t0) + x))
    for reached, time in reversed(before):
        out = F.when(reached, time).otherwise(out)
    return out


def sized(docs: DataFrame, text: str = "text", source: str = "source", keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id") -> DataFrame:
    """Documents as (kept columns, source, size, order key, block): no text from here on."""
    order = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return docs.select(
        *keep, F.col(source).alias("_source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), order.alias("_order"),
    ).withColumn("_block", F.substring("_order", 1, 3))


def targets(sizes: DataFrame, classes: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row a source: its size, weight class, and target. ``sizes`` has (_source, source_size).

    Sharing all words by weight, with no target above ``max_repeats`` times its source and the excess shared again, ends
    at targets min(cap, level x weight); the level is read off the sources in order of cap / weight. The windows here run
    over one row a source.
    """
    weight = (F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1) % classes + 1
    one = sizes.withColumn("weight", weight.cast("double")).withColumn("_cap", F.col("source_size").cast("double") * max_repeats)
    upto = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    one = one.withColumns({
        "_total": F.sum("source_size").over(every).cast("double"), "_full": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)),
        "_rest": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)),
    })
    level = F.min(F.when((F.col("_total") - F.col("_full")) / F.col("_rest") <= F.col("_cap") / F.col("weight"), F.struct(F.col("_full"), F.col("_rest")))).over(every)
    one = one.withColumn("_level", level)
    share = (F.col("_total") - F.col("_level._full")) * F.col("weight") / F.col("_level._rest")
    return one.select("_source", "source_size", "weight", F.coalesce(F.least(F.col("_cap"), share), F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", keep: tuple[str, ...] = ("doc_id",),
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, max_repeats: int = MAX_REPEATS, whole: bool = False,
    every_copy: bool = False, doc_id: str = "doc_id",
) -> DataFrame:
    """Each document with ``taken`` words, ``copies`` and the ``position`` of its first word.

    With ``whole``, the last round over a source takes whole documents only: those whose middle lies before its end. With
    ``every_copy``, ``positions`` has the position of each copy.
    """
    rows = staged(sized(docs, text, source, keep, doc_id), "sizes")
    blocks = rows.groupBy("_source", "_block").agg(F.sum("size").alias("_sum"))
    goals = targets(blocks.groupBy("_source").agg(F.sum("_sum").alias("source_size")), len(schedules), max_repeats)
    ahead = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    starts = starts.alias("s").join(goals.alias("g"), same("s._source", "g._source")).select("s._source", "s._block", "_ahead", "source_size", "weight", "target")
    inside = Window.partitionBy("_source", "_block").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.alias("p").join(starts.alias("s"), same("p._source", "s._source") & same("p._block", "s._block")).select("p.*", "_ahead", "source_size", "weight", "target")
    placed = placed.withColumns({"_at": F.col("_before") + F.col("_ahead"), "_goal": F.floor(F.col("target") + 0.5)})
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("_goal") / F.col("source_size"))).otherwise(F.lit(0))
    placed = placed.withColumn("_rounds", rounds).withColumn("_left", F.col("_goal") - F.col("_rounds") * F.col("source_size"))
    if whole:
        last = F.when(2 * F.col("_left") > 2 * F.col("_at") + F.col("size"), F.col("size")).otherwise(F.lit(0))
    else:
        last = F.least(F.greatest(F.col("_left") - F.col("_at"), F.lit(0)), F.col("size"))
    placed = placed.withColumn("taken", F.col("_rounds") * F.col("size") + last)

    def due(word: Column) -> Column:
        """When a word of the source's repeated stream is due."""
        share, out = F.least(F.try_divide(word.cast("double"), F.col("_goal").cast("double")), F.lit(1.0)), F.lit(None).cast("double")
        for k, schedule in enumerate(schedules, 1):
            out = F.when(F.col("weight") == k, when_due(share, schedule)).otherwise(out)
        return F.round(out, 9)

    copies = F.when(F.col("size") > 0, F.col("_rounds") + F.when(last > 0, 1).otherwise(0)).otherwise(0).cast("int")
    later = F.transform(F.sequence(F.lit(0), copies - 1), lambda c: due(c * F.col("source_size") + F.col("_at")))
    return placed.select(
        *keep, "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), copies.alias("copies"),
        F.when(F.col("taken") > 0, due(F.col("_at"))).alias("position"), *([F.when(copies > 0, later).alias("positions")] * every_copy),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The mix range-sorted by position, ties by document; documents that it does not take come last."""
    keys = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return mixed.repartitionByRange(*keys).sortWithinPartitions(*keys)
