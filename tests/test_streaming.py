from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import fraud
from tillwatch.sources.tables import read_table
from tillwatch.streaming import flows


@pytest.fixture()
def feed(spark, tmp_path, txns):
    """A folder that grows by one file per call; returns a stream over it."""
    folder = str(tmp_path / "in")

    def add(rows):
        df = txns(rows).coalesce(1)
        df.write.mode("append").parquet(folder)
        return flows.read_stream(spark, folder, df.schema, max_files=1)

    return add


def _run(spark, tmp_path, stream, name="out"):
    out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    flows.run_to_end(stream, out, checkpoint)
    return read_table(spark, out)


def test_high_value_stream_equals_batch(spark, tmp_path, feed, txns):
    rows = [("a", "2025-03-01", 200000), ("b", "2025-03-02", 5)]
    out = _run(spark, tmp_path, flows.stream_high_value(feed(rows), detected_at="now"))
    batch = fraud.high_value(txns(rows), detected_at="now")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_a_running_stream_picks_up_new_files(spark, tmp_path, feed):
    out = str(tmp_path / "out")
    alerts = flows.stream_high_value(feed([("a", "2025-03-01", 200000)]))
    query = flows.start(alerts, out, str(tmp_path / "checkpoint"), every="0 seconds")
    try:
        query.processAllAvailable()
        assert read_table(spark, out).count() == 1
        feed([("b", "2025-03-02", 300000), ("c", "2025-03-02", 3)])
        query.processAllAvailable()
        assert sorted(r.account_number for r in read_table(spark, out).collect()) == ["a", "b"]
    finally:
        query.stop()


def test_burst_stream_emits_closed_windows_once(spark, tmp_path, feed):
    first = [("a", f"2025-03-01 10:0{i}:00", 1) for i in range(4)]
    stream = flows.stream_burst(feed(first))
    assert _run(spark, tmp_path, stream).count() == 0
    # The next file moves the watermark past the window and opens another one.
    feed([("a", "2025-03-01 11:00:00", 1)])
    for _ in range(2):
        row = _run(spark, tmp_path, stream).collect()
        assert [(r.account_number, r.txn_count, str(r.window_end)) for r in row] == [
            ("a", 4, "2025-03-01 10:10:00")
        ]


def test_rows_behind_the_watermark_do_not_reopen_a_window(spark, tmp_path, feed):
    stream = flows.stream_burst(feed([("a", f"2025-03-01 10:0{i}:00", 1) for i in range(3)]))
    _run(spark, tmp_path, stream)
    feed([("b", "2025-03-01 12:00:00", 1)])
    _run(spark, tmp_path, stream)
    feed([("a", "2025-03-01 10:04:00", 1), ("b", "2025-03-01 13:00:00", 1)])
    assert _run(spark, tmp_path, stream).count() == 0


def test_daily_spend_stream(spark, tmp_path, feed, txns):
    rows = [("a", "2025-03-01 01:00:00", 700000), ("a", "2025-03-01 23:00:00", 700000)]
    rows += [("b", "2025-03-01 05:00:00", 5), ("c", "2025-03-04 05:00:00", 5)]
    out = _run(spark, tmp_path, flows.stream_daily_spend(feed(rows)))
    batch = fraud.daily_spend(txns(rows))
    assert [r.asDict() for r in out.collect()] == [r.asDict() for r in batch.collect()]


def test_days_of_the_stream_follow_the_session_zone(spark, tmp_path, feed, txns):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # Both belong to March 1 in New York, but to different days in UTC.
        rows = [("a", "2025-03-01 12:00:00", 700000), ("a", "2025-03-01 22:00:00", 700000)]
        rows += [("b", "2025-03-05 05:00:00", 5)]
        out = _run(spark, tmp_path, flows.stream_daily_spend(feed(rows)))
        batch = fraud.daily_spend(txns(rows))
        assert [r.asDict() for r in out.collect()] == [r.asDict() for r in batch.collect()]
        assert batch.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dedup_stream_keeps_one_row_per_id(spark, tmp_path, feed):
    rows = [("a", f"2025-03-01 10:00:0{i}", i) for i in range(5)]
    feed(rows)
    feed(rows)
    # `feed` numbers ids per call, so every id arrives three times, in three batches.
    out = _run(spark, tmp_path, flows.stream_dedup(feed(rows), "transaction_id"))
    assert sorted(r.transaction_id for r in out.collect()) == [f"t0000{i}" for i in range(5)]
    assert out.columns == read_table(spark, str(tmp_path / "in")).columns


def test_dedup_stream_takes_an_id_again_after_the_delay(spark, tmp_path, feed):
    """Copies at 0, 9 and 15 minutes in batches of their own: the second does not extend the first's delay."""
    for minute in (0, 9):
        feed([("x", f"2025-03-01 10:{minute:02d}:00", 1)])
    feed([("y", "2025-03-01 09:00:00", 1), ("filler", "2025-03-01 10:22:00", 1)])
    out = _run(spark, tmp_path, flows.stream_dedup(feed([("x", "2025-03-01 10:15:00", 1)]), "transaction_id"))
    minutes = sorted(r.transaction_timestamp.minute for r in out.filter("account_number = 'x'").collect())
    assert minutes in ([0], [0, 15])
    assert 9 not in minutes


def test_file_stream_takes_each_file_once(spark, tmp_path, feed):
    stream = feed([("a", "2025-03-01 10:00:00", 1)])
    for expected in (1, 1):
        assert _run(spark, tmp_path, stream).count() == expected
    feed([("a", "2025-03-01 10:00:00", 1), ("b", "2025-03-01 10:00:00", 1)])
    out = _run(spark, tmp_path, stream)
    assert out.count() == 3
    assert out.agg(F.max("amount")).first()[0] == 1.0
