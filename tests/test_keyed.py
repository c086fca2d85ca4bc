from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillwatch.plans.incremental import incremental_load
from tillwatch.sources import keyed
from tillwatch.sources.keyed import REPLACE, KeyedTable, Loaded
from tillwatch.sources.tables import read_table, write_table

SCHEMA = "transaction_id string, amount double, changed int, transaction_date date"


@pytest.fixture()
def rows(spark):
    def build(*found):
        listed = [(k, float(a), v, None if d is None else date(2025, 1, d)) for k, a, v, d in found]
        return spark.createDataFrame(listed, SCHEMA).repartition(2)

    return build


def held(spark, path):
    return sorted(
        ((r.transaction_id, r.amount, r.transaction_date and r.transaction_date.day) for r in read_table(spark, path).collect()), key=repr
    )


def test_a_key_delivered_again_under_another_day_stays_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert incremental_load(rows(("t1", 1, 0, 1)), path) == Loaded(1, 0, 0, (date(2025, 1, 1),))
    assert incremental_load(rows(("t1", 1, 0, 5)), path) == Loaded(0, 0, 1, ())
    assert held(spark, path) == [("t1", 1.0, 1)]


def test_a_correction_moves_the_row_and_empties_its_day(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    incremental_load(rows(("t1", 1, 0, 1), ("t2", 2, 0, 2), ("t3", 3, 0, 2)), path)
    moved = rows(("t1", 9, 1, 5), ("t2", 2, 0, 2), ("t4", 4, 0, 5), ("t3", 3, 1, None))
    loaded = incremental_load(moved, path, on_conflict=REPLACE)
    assert (loaded.new, loaded.changed, loaded.same) == (1, 2, 1)
    assert loaded.days == (None, date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 5))
    want = [("t1", 9.0, 5), ("t2", 2.0, 2), ("t3", 3.0, None), ("t4", 4.0, 5)]
    assert held(spark, path) == want
    assert not (tmp_path / "t" / "transaction_date=2025-01-01").exists()
    again = incremental_load(moved, path, on_conflict=REPLACE)
    assert (again.new, again.changed, again.same, again.days) == (0, 0, 4, ())
    assert held(spark, path) == want


def test_an_older_version_does_not_replace_a_newer_one(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), version="changed")
    table.load(rows(("t1", 1, 1, 1), ("t1", 2, 3, 2), ("t1", 3, 2, 3)), REPLACE)
    assert held(spark, table.path) == [("t1", 2.0, 2)]
    table.load(rows(("t1", 4, 2, 4)), REPLACE)
    assert held(spark, table.path) == [("t1", 2.0, 2)]
    table.load(rows(("t1", 5, 4, 4)), REPLACE)
    assert held(spark, table.path) == [("t1", 5.0, 4)]


def test_load_stamps_do_not_make_a_row_another(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), unlike=("changed",))
    table.load(rows(("t1", 1, 1, 1), (None, 1, 1, 1)), REPLACE)
    assert table.load(rows(("t1", 1, 2, 1), (None, 1, 2, 1)), REPLACE).same == 2


def test_a_table_without_an_index_gets_one(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_table(rows(("t1", 1, 0, 1), (None, 2, 0, 1)), path, partition_by=["transaction_date"])
    assert incremental_load(rows(("t1", 1, 0, 7), (None, 2, 0, 1), (None, 2, 0, 2)), path).new == 1
    assert held(spark, path) == [("t1", 1.0, 1), (None, 2.0, 1), (None, 2.0, 2)]


def test_unpartitioned_tables_keep_but_do_not_replace(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for d in (1, 2):
        incremental_load(rows(("t1", 1, 0, d)), path, partition_by=())
    assert held(spark, path) == [("t1", 1.0, 1)]
    with pytest.raises(ValueError, match="folder per day"):
        incremental_load(rows(("t1", 1, 0, 3)), path, partition_by=(), on_conflict=REPLACE)


@pytest.mark.parametrize("breaks", ["_prepare", "replace_days", "write_table", "_write_index"])
def test_a_load_that_breaks_off_is_forgotten_or_completed(spark, tmp_path, rows, monkeypatch, breaks):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.load(rows(("t1", 1, 0, 1), ("t2", 2, 0, 2), ("t3", 3, 0, 3)), REPLACE)
    before = held(spark, table.path)
    delivery = rows(("t1", 9, 0, 2), ("t4", 4, 0, 4), ("t5", 5, 0, 2))
    owner = keyed if hasattr(keyed, breaks) else KeyedTable
    real = getattr(owner, breaks)

    def broken(*args, **named):
        if breaks in ("replace_days", "write_table"):
            real(*args, **named)  # breaks off after it has done its part
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, breaks, broken)
    with pytest.raises(RuntimeError, match="lost"):
        table.load(delivery, REPLACE)
    monkeypatch.undo()
    table.recover()
    after = [("t1", 9.0, 2), ("t2", 2.0, 2), ("t3", 3.0, 3), ("t4", 4.0, 4), ("t5", 5.0, 2)]
    assert held(spark, table.path) == (before if breaks == "_prepare" else after)
    table.load(delivery, REPLACE)
    assert held(spark, table.path) == after
    assert table.load(delivery, REPLACE).days == ()


def test_random_loads_keep_the_last_row_of_each_key(spark, tmp_path, rows):
    rng = random.Random(11)
    table = KeyedTable(spark, str(tmp_path / "t"), buckets=4, compact_after=3)
    want = {}
    for _ in range(7):
        delivery = {f"t{rng.randrange(12)}": (rng.randrange(3), rng.choice([1, 2, 3, None])) for _ in range(6)}
        table.load(rows(*[(k, a, 0, d) for k, (a, d) in delivery.items()]), REPLACE)
        want |= delivery
        assert held(spark, table.path) == sorted(((k, float(a), d) for k, (a, d) in want.items()), key=repr)
    assert len(table._sequences()) < 4
    assert table.index(read_table(spark, table.path).schema).groupBy("key").agg(F.max("seq")).count() == len(want)


def test_find_reads_only_the_days_of_the_keys(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.load(rows(*[(f"t{i}", i, 0, 1 + i % 20) for i in range(40)]))
    found = table.find(["t3", "t23", "nothing"])
    assert sorted(r.transaction_id for r in found.collect()) == ["t23", "t3"]
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "2025-01-04" in filters


def test_a_load_never_scans_the_rows_of_the_table(spark, tmp_path, rows):
    """Look-ups read the index alone, in the buckets that the delivery touches."""
    table = KeyedTable(spark, str(tmp_path / "t"), buckets=8)
    table.load(rows(*[(f"t{i}", i, 0, 1 + i % 20) for i in range(40)]))
    judged = table._judged(table._once(rows(("t3", 1, 0, 9))), rows().schema, REPLACE)
    assert all("/_keys/seq=" in f for f in judged.inputFiles())
    assert "bucket" in judged._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
