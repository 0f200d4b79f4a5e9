"""The radar as a stream: files out of order, late rows, a restart, and what was sent before."""

from datetime import datetime, timedelta

from arpent.streaming import radar

SCHEMA = "parcel string, number long, at timestamp"


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def test_delta_holds_in_any_order(spark, tmp_path):
    inbox, home = str(tmp_path / "in"), str(tmp_path / "home")
    send = lambda *rows: spark.createDataFrame([(p, i, None if d is None else day(d)) for p, i, d in rows], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    before = spark.createDataFrame([("D", 1, day(0)), ("D", 2, day(1))], SCHEMA)

    def work():
        stream = radar.read_stream(spark, inbox, before.schema, files_per_batch=1)
        late = radar.work_off(radar.delta(stream, before, "parcel", "number", "at", "10 days"), home)
        return late, sorted((r["parcel"], r["number"], (r["at"] - day(0)).days) for r in spark.read.parquet(f"{home}/rows").collect())

    send(("A", 50, 5), ("B", 61, 6), ("B", 60, 6), ("D", 70, 7), (None, 1, 5), ("E", None, 5), ("E", 2, None))
    send(("A", 30, 3), ("A", 80, 8))  # the earlier deposit comes in a later file
    send(("Z", 99, 20))  # the watermark goes to day 10
    send(("Y", 98, 21))  # a batch at that watermark
    send(("A", 20, 2), ("C", 15, 15), ("C", 15, 15))  # a row behind the watermark
    late, rows = work()
    assert late == 1
    assert rows == [("A", 30, 3), ("B", 60, 6)]  # C and Z are not certain yet, D was sent before
    send(("A", 31, 40), ("C", 14, 14), ("D", 90, 41))
    late, rows = work()
    assert late == 0
    assert rows == [("A", 30, 3), ("B", 60, 6), ("C", 14, 14), ("Y", 98, 21), ("Z", 99, 20)]
