from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillwatch.operators import sketches


@pytest.fixture()
def moves(spark):
    """60,000 accounts of three branches, each on 1 to 7 of 30 days."""
    days = spark.range(60_000).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("id") % 7)))
    return days.select(
        F.col("id").cast("string").alias("account_number"),
        F.date_add(F.lit(date(2025, 1, 1)), F.pmod(F.xxhash64("id", "k"), F.lit(30)).cast("int")).alias("transaction_date"),
        F.lit("t").alias("transaction_id"),
    )


@pytest.fixture()
def owners(spark):
    return spark.range(59_000).select(F.col("id").cast("string").alias("account_number"), (F.col("id") % 3).alias("branch_id"))


@pytest.mark.parametrize(("since", "until"), [(None, None), (date(2025, 1, 10), date(2025, 1, 12)), (date(2025, 1, 30), None)])
def test_spans_of_days_are_close_to_exact(moves, owners, since, until):
    stored = sketches.day_sketches(sketches.account_days(moves), owners)
    got = {r.branch_id: r.distinct_accounts for r in sketches.distinct_accounts(stored, since, until).collect()}
    span = moves.filter(F.col("transaction_date").between(F.lit(since or date(2000, 1, 1)), F.lit(until or date(2030, 1, 1))))
    exact = span.join(owners, "account_number", "left").groupBy("branch_id").agg(F.count_distinct("account_number").alias("n"))
    want = {r.branch_id: r.n for r in exact.collect()}
    assert got.keys() == want.keys() == {0, 1, 2, None}
    assert all(abs(got[b] - n) <= 0.03 * n for b, n in want.items())


def test_merged_days_do_not_count_an_account_twice(moves, owners):
    days = sketches.account_days(moves.filter("account_number < '2'"))
    stored = sketches.day_sketches(days.unionByName(days), owners)
    whole = sketches.merged(stored).select(F.hll_sketch_estimate("accounts").alias("n")).first().n
    exact = days.select("account_number").distinct().count()
    assert abs(whole - exact) <= 0.03 * exact


def test_no_days_no_rows(moves, owners):
    assert sketches.distinct_accounts(sketches.day_sketches(moves, owners), since=date(2030, 1, 1)).collect() == []
