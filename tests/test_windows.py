from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import fraud
from tillwatch.sources.tables import read_table
from tillwatch.streaming import flows, windows
from tillwatch.streaming.windows import DroppedRows, WindowTable


@pytest.fixture()
def feed(spark, tmp_path, txns):
    """A folder that grows by one file per call; returns a stream over it."""
    folder = str(tmp_path / "in")

    def add(rows):
        df = txns(rows).coalesce(1)
        df.write.mode("append").parquet(folder)
        return flows.read_stream(spark, folder, df.schema, max_files=1)

    return add


def _rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_open_windows_are_there_and_later_replaced(spark, tmp_path, feed, txns):
    table = WindowTable(spark, str(tmp_path / "w"))
    first = [("a", f"2025-03-01 10:0{i}:00", 1) for i in range(4)]
    table.run_to_end(feed(first))
    assert [(r.txn_count, r.open) for r in table.totals().collect()] == [(4, True)]
    assert windows.bursts(table).collect()[0].txn_count == 4
    second = [("a", "2025-03-01 10:09:59", 2), ("b", "2025-03-01 10:30:00", 1)]
    table.run_to_end(feed(second))
    assert _rows(windows.bursts(table)) == _rows(fraud.burst(txns(first + second)))
    assert {(r.account_number, r.txn_count, r.open) for r in table.totals().collect()} == {("a", 5, False), ("b", 1, True)}


def test_rows_in_are_rows_held_plus_late_plus_untimed(spark, tmp_path, feed):
    table = WindowTable(spark, str(tmp_path / "w"))
    table.run_to_end(feed([("a", "2025-03-01 10:00:00", 1), ("a", "2025-03-01 12:00:00", 1)]))
    late = [("a", "2025-03-01 10:01:00", 1), ("b", "2025-03-01 11:49:59", 5), ("b", "2025-03-01 11:50:00", 1), ("c", None, 3)]
    table.run_to_end(feed(late))
    came = table.progress().agg(*[F.sum(c).alias(c) for c in ("rows", "on_time", "late", "untimed")]).first()
    held = table.totals().agg(F.sum("rows").alias("n")).first().n
    assert tuple(came) == (6, 3, 2, 1)
    assert came.rows == held + came.late + came.untimed
    kept = {(r.account_number, r.amount, r.kind, r.batch) for r in table.late().collect()}
    assert kept == {("a", 1.0, "late", 1), ("b", 5.0, "late", 1), ("c", 3.0, "untimed", 1)}


def test_a_batch_that_broke_off_is_taken_once(spark, tmp_path, feed, txns, monkeypatch):
    table = WindowTable(spark, str(tmp_path / "w"), windows.DAY, "1 hour")
    rows = [("a", "2025-03-01 10:00:00", 600000), ("a", "2025-03-01 12:00:00", 600000)]
    stream = feed(rows)
    real = WindowTable._write

    def broken(self, df, entity):
        if entity.startswith("progress"):
            raise RuntimeError("lost")
        real(self, df, entity)

    monkeypatch.setattr(WindowTable, "_write", broken)
    with pytest.raises(Exception, match="lost"):
        table.run_to_end(stream)
    monkeypatch.undo()
    for _ in range(2):
        table.run_to_end(stream)
        assert _rows(windows.daily_spend(table)) == _rows(fraud.daily_spend(txns(rows)))


def test_a_batch_number_that_comes_again_is_passed_over(spark, tmp_path, txns):
    table = WindowTable(spark, str(tmp_path / "w"))
    batch = txns([("a", "2025-03-01 10:00:00", 1)])
    for _ in range(2):
        table.take(batch, 0)
    assert table.totals().first().txn_count == 1


def test_any_order_of_files_gives_the_batch_rules(spark, tmp_path, txns):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), f"2025-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} 10:{rng.randrange(60):02d}:00", 7) for _ in range(24)]
    rows += [("c", f"2025-06-01 10:0{i}:30", 1) for i in range(6)]
    rng.shuffle(rows)
    days = WindowTable(spark, str(tmp_path / "d"), windows.DAY, None, compact_after=2)
    moments = WindowTable(spark, str(tmp_path / "m"), None, None, compact_after=3)
    every = txns(rows)
    for number in range(5):
        part = every.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(5)) == number)
        days.take(part, number)
        moments.take(part, number)
    assert days._folds()[1] >= 3
    assert _rows(windows.reactivated(days, 30)) == _rows(fraud.reactivated(every, 30)) != []
    assert _rows(windows.sliding_bursts(moments)) == _rows(fraud.sliding_burst(every)) != []


def test_alerts_are_found_batch_by_batch(spark, tmp_path, txns):
    """In order of time the alerts of all batches are those of the rules; each shows with the batch that causes it."""
    months = [("a", f"2025-{m:02d}-05 10:00:00", m) for m in (1, 2, 8, 9)] + [("b", "2025-08-05 10:00:00", 1)]
    days = WindowTable(spark, str(tmp_path / "d"), windows.DAY, None, emit=windows.reactivated_now(100))
    clicks = [("a", f"2025-03-01 10:{m:02d}:00", m) for m in (0, 3, 6, 9, 30, 31, 32, 33)] + [("b", "2025-03-01 10:10:00", 1)]
    moments = WindowTable(spark, str(tmp_path / "m"), None, None, emit=windows.sliding_bursts_now(), back="10 minutes", compact_after=2)
    every = {days: txns(months), moments: txns(clicks)}
    for table, rows in every.items():
        at = F.col("transaction_timestamp")
        cuts = [at < "2025-03-01 10:07:00", (at >= "2025-03-01 10:07:00") & (at < "2025-08-01"), at >= "2025-08-01"]
        for number, cut in enumerate(cuts):
            table.take(rows.filter(cut), number)
    assert _rows(days.alerts().drop("batch")) == _rows(fraud.reactivated(every[days], 100)) != []
    assert {r.batch for r in days.alerts().collect()} == {2}
    assert _rows(moments.alerts().drop("batch")) == _rows(fraud.sliding_burst(every[moments])) != []


def test_days_follow_the_session_zone(spark, tmp_path, txns):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [("a", "2025-03-09 00:30:00", 700000), ("a", "2025-03-09 23:30:00", 700000)]  # 23 hours long
        table = WindowTable(spark, str(tmp_path / "w"), windows.DAY, "1 hour")
        table.take(txns(rows), 0)
        assert _rows(windows.daily_spend(table)) == _rows(fraud.daily_spend(txns(rows))) != []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_windows_cut_time_as_the_engine_does(spark, txns):
    rows = txns([("a", when, 1) for when in ("1969-12-31 23:59:59", "1970-01-01 00:00:00", "2025-03-01 10:09:59", "2025-03-01 10:10:00")])
    for width in ("10 minutes", "45 seconds", "1 hour", "7 minutes"):
        slot = WindowTable(spark, "unused", width)._slot(F.col("transaction_timestamp"))
        engine = F.window("transaction_timestamp", width)
        both = rows.withColumn("e", engine).select(slot.alias("s"), "e").collect()
        assert all(tuple(r.s) == tuple(r.e) for r in both)


def test_an_untaken_table_says_so(spark, tmp_path):
    table = WindowTable(spark, str(tmp_path / "w"))
    assert table.progress() is None and table.late() is None and table.watermark() is None
    with pytest.raises(ValueError, match="no batch"):
        table.totals()


def test_the_listener_counts_what_the_engine_drops(spark, tmp_path, feed):
    listener = DroppedRows()
    spark.streams.addListener(listener)
    try:
        out = str(tmp_path / "out")
        for rows in (
            [("a", f"2025-03-01 10:0{i}:00", 1) for i in range(3)],
            [("b", "2025-03-01 12:00:00", 1)],
            [("a", "2025-03-01 10:04:00", 1), ("b", "2025-03-01 13:00:00", 1)],
        ):
            flows.run_to_end(flows.stream_burst(feed(rows)), out, str(tmp_path / "checkpoint"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        counted = listener.table(spark).collect()
    finally:
        spark.streams.removeListener(listener)
    assert read_table(spark, out).count() == 0
    assert sum(r.rows_dropped for r in counted) == 1
    assert {r.query: r.rows_in for r in counted if r.rows_dropped} == {counted[0].query: 6}
