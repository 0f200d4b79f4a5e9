"""Streaming queries over the events table, run until everything available is worked off."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.plans.catalog import query, table
from arpent.streaming import radar


def _events(spark, sf, kind):
    schema = table(spark, sf, "events").schema
    rows = radar.read_stream(spark, f"{sf}/events.parque[t]", schema)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).where(F.col("event_type") == kind)


@query("stream_first_deposits", "SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'")
def stream_first_deposits(spark, sf):
    new = radar.first_deposits(_events(spark, sf, "signup").select("user_id", "ts"), "user_id", "ts", "40 days")
    return radar.run_available(new, "deposits").select("user_id")


_SENT = "2024-01-03 00:00:00"


@query("stream_radar_delta", f"""WITH s AS (SELECT * FROM events WHERE event_type = 'signup'), n AS (SELECT * FROM s WHERE ts >= TIMESTAMP '{_SENT}')
SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts FROM n WHERE user_id NOT IN (SELECT user_id FROM s WHERE ts < TIMESTAMP '{_SENT}') GROUP BY 1
HAVING min(ts) <= (SELECT date_trunc('milliseconds', max(ts)) FROM n) - INTERVAL 10 DAY""")
def stream_radar_delta(spark, sf):
    """First deposits since the last sending, of keys that it did not carry, as far as ten days of lateness make them certain."""
    rows, sent = _events(spark, sf, "signup").select("user_id", "event_id", "ts"), table(spark, sf, "events").where("event_type = 'signup'").select("user_id", "event_id", "ts")
    cut = F.lit(_SENT).cast("timestamp")
    new = radar.delta(rows.where(F.col("ts") >= cut), sent.where(F.col("ts") < cut), "user_id", "event_id", "ts", "10 days")
    return radar.run_available(new, "delta")


@query("stream_time_to_conversion", "SELECT d.event_id, min(a.ts) AS converted_at FROM events d JOIN events a ON a.user_id = d.user_id AND a.event_type = 'purchase' AND a.ts > d.ts AND a.ts <= d.ts + INTERVAL 12 HOUR WHERE d.event_type = 'signup' GROUP BY 1")
def stream_time_to_conversion(spark, sf):
    d = _events(spark, sf, "signup").select("event_id", "user_id", F.col("ts").alias("deposited_at"))
    a = _events(spark, sf, "purchase").select("user_id", F.col("ts").alias("act_at"))
    pairs = radar.conversions(d, a, "user_id", "deposited_at", "act_at", "12 hours").select("d.event_id", "act_at")
    return radar.run_available(pairs, "conversions").groupBy("event_id").agg(F.min("act_at").alias("converted_at"))
