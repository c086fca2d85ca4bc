from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import CUST_SCHEMA
from tillwatch.operators import fraud, reports, summaries
from tillwatch.settings import BURST, DAILY_SPEND, DORMANT, HIGH_VALUE


def accounts(df):
    return sorted(r.account_number for r in df.collect())


def test_high_value_edge(txns):
    df = txns([("a", "2025-03-01", 100000), ("b", "2025-03-01", 100000.01, "CREDIT")])
    out = fraud.high_value(df, detected_at="now")
    assert accounts(out) == ["b"]
    assert out.columns[-2:] == ["fraud_type", "fraud_detected_at"]


def test_burst_edge(txns):
    rows = [("a", f"2025-03-01 10:0{i}:00", 1) for i in range(3)]
    rows += [("b", f"2025-03-01 10:0{i}:00", 2) for i in range(4)]
    row = fraud.burst(txns(rows)).collect()[0]
    assert (row.account_number, row.txn_count, row.total_amount) == ("b", 4, 8.0)
    assert (str(row.window_start), str(row.window_end)) == ("2025-03-01 10:00:00", "2025-03-01 10:10:00")


def test_burst_window_is_half_open(txns):
    rows = [("a", t, 1) for t in ("2025-03-01 09:50:00", "2025-03-01 09:59:59", "2025-03-01 10:00:00")]
    assert [r.txn_count for r in fraud.burst(txns(rows), max_count=1).collect()] == [2]


def test_split_burst_is_seen_by_the_sliding_rule_only(txns):
    times = ("09:58:00", "09:59:00", "10:01:00", "10:02:00")
    df = txns([("a", f"2025-03-01 {t}", 5) for t in times])
    assert fraud.burst(df).count() == 0
    row = fraud.sliding_burst(df).collect()[0]
    assert (str(row.window_end), row.txn_count, row.total_amount) == ("2025-03-01 10:02:00", 4, 20.0)


def test_sliding_window_includes_both_ends(txns):
    df = txns([("a", "2025-03-01 10:00:00", 1), ("a", "2025-03-01 10:10:00", 1), ("a", "2025-03-01 10:20:01", 1)])
    assert [str(r.window_end) for r in fraud.sliding_burst(df, max_count=1).collect()] == ["2025-03-01 10:10:00"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sliding_burst_against_brute_force(txns, seed):
    """One account holds a third of all rows, some at equal moments."""
    rng = random.Random(seed)
    start = datetime(2025, 3, 1)
    rows = []
    for i in range(600):
        account = "hot" if i % 3 == 0 else f"a{rng.randrange(20)}"
        when = start + timedelta(seconds=60 * rng.randrange(600))
        rows.append((account, str(when), rng.randrange(100)))
    expected = set()
    for account, when, _ in rows:
        end = datetime.fromisoformat(when)
        near = [
            amount
            for a, w, amount in rows
            if a == account and end - timedelta(minutes=10) <= datetime.fromisoformat(w) <= end
        ]
        if len(near) > 3:
            expected.add((account, when, len(near), float(sum(near))))
    got = {
        (r.account_number, str(r.window_end), r.txn_count, r.total_amount)
        for r in fraud.sliding_burst(txns(rows)).collect()
    }
    assert got == expected
    assert expected


def test_sliding_burst_at_bucket_edges(txns):
    """Two adjacent buckets together just reach the limit, or pass it; accounts may be null."""
    times = ("10:09:59", "10:10:00", "10:10:00", "10:19:59")
    rows = [(account, f"2025-03-01 {t}", 1) for account in ("a", None) for t in times]
    rows += [("b", f"2025-03-01 {t}", 1) for t in ("09:59:59", "10:10:00", "10:20:00", "10:30:00")]
    found = fraud.sliding_burst(txns(rows))
    assert {(r.account_number, str(r.window_end), r.txn_count) for r in found.collect()} == {
        ("a", "2025-03-01 10:19:59", 4),
        (None, "2025-03-01 10:19:59", 4),
    }


def test_totals_in_one_fold_equal_the_tables(txns):
    rng = random.Random(5)
    rows = []
    for _ in range(800):
        when = datetime(2025, 1, 1) + timedelta(minutes=rng.randrange(450_000))
        kind = rng.choice(["DEBIT", "DEBIT", "CREDIT"])
        rows.append((f"a{rng.randrange(60)}", str(when), rng.randrange(90_000, 101_000), kind))
    rows += [("burst", f"2025-03-01 10:0{i}:00", 300_000) for i in range(5)]
    df = txns(rows)
    quiet = fraud.RuleParams(dormant_max_txns=14)
    for rules in (quiet, fraud.DEFAULT_RULES):
        tables = fraud.alert_totals(fraud.all_rules(df, rules))
        expected = {tuple(r) for r in tables.collect()}
        assert {tuple(r) for r in fraud.rule_totals(df, rules).select(*tables.columns).collect()} == expected
        days = summaries.day_totals(df)
        again = fraud.rules_with_days(df, days, rules)
        for name, table in fraud.all_rules(df, rules).items():
            same = again[name].select(*table.columns)
            assert sorted(map(str, same.collect())) == sorted(map(str, table.collect())), name
    assert all(r.alerts for r in fraud.rule_totals(df, quiet).collect())
    nothing = {tuple(r)[1:] for r in fraud.rule_totals(df.filter("false")).collect()}
    assert nothing == {(0, None)}


def test_daily_spend_edge(txns):
    day = "2025-03-01 10:00:00"
    rows = [("a", day, 500000), ("a", day, 500000), ("b", day, 500000), ("b", day, 500000.01)]
    rows += [("c", day, 2000000, "CREDIT")]
    out = fraud.daily_spend(txns(rows)).collect()
    assert [(r.account_number, r.daily_spend, r.txn_count) for r in out] == [("b", 1000000.01, 2)]


def _visits(account, first, *gaps):
    day = datetime.fromisoformat(first)
    rows = [(account, str(day), 1)]
    for gap in gaps:
        day += timedelta(days=gap)
        rows.append((account, str(day), 1))
    return rows


def test_dormant_edges(txns):
    rows = _visits("span180", "2025-06-01", 180)
    rows += _visits("span181", "2025-06-01", 181)
    rows += _visits("ten", "2025-05-01", *[25] * 9)
    rows += _visits("eleven", "2025-05-01", *[25] * 10)
    rows += _visits("old", "2024-01-01", 300)
    out = fraud.dormant(txns(rows), detected_at="now")
    assert accounts(out) == ["span181", "ten"]
    assert out.columns == [
        "account_number",
        "first_txn_date",
        "last_txn_date",
        "total_txns",
        "gap_days",
        "fraud_type",
        "fraud_detected_at",
    ]


def test_recency_date_is_inclusive(txns):
    rows = _visits("on", "2025-01-01", 273) + _visits("before", "2025-01-01", 272)
    assert accounts(fraud.dormant(txns(rows))) == ["on"]


def test_dormant_measures_the_span_and_reactivated_the_pause(txns):
    steady = _visits("steady", "2025-05-01", *[25] * 8)
    paused = _visits("paused", "2025-01-01", 1, 180)
    df = txns(steady + paused + _visits("short", "2025-01-01", 179))
    assert accounts(fraud.dormant(df, active_since=datetime(2025, 1, 1).date())) == ["paused", "steady"]
    row = fraud.reactivated(df).collect()[0]
    assert (row.account_number, row.gap_days, str(row.previous_date)) == ("paused", 180, "2025-01-02")


def test_summary_adds_up_and_lists_silent_rules(txns):
    df = txns([("a", "2025-03-01", 200000), ("b", "2025-03-01", 2000000)])
    counts = {r.fraud_type: r.alerts for r in fraud.alert_summary(fraud.all_rules(df)).collect()}
    assert counts == {HIGH_VALUE: 2, BURST: 0, DAILY_SPEND: 1, DORMANT: 0, "TOTAL": 3}
    assert fraud.alerts_union(fraud.all_rules(df)).count() == 3


def test_cards_of_a_silent_rule(txns):
    quiet = fraud.all_rules(txns([("a", "2025-03-01", 1)]))
    cards = {r.rule: (r.alerts, r.display) for r in reports.fraud_cards(quiet).collect()}
    assert cards == {
        "High Value": (0, "₹0.0 Cr"),
        "Rapid Burst": (0, "₹0.0 Cr"),
        "High Daily Spend": (0, "₹0.0 Cr"),
        "Dormant Active": (0, "Suspicious"),
    }


def test_rules_aggregate_before_they_shuffle(spark, txns):
    df = txns([("a", "2025-03-01 10:00:00", 1)])
    for rule in (fraud.burst, fraud.daily_spend, fraud.dormant, fraud.sliding_burst, fraud.reactivated):
        plan = rule(df)._jdf.queryExecution().executedPlan().toString()
        lowest = plan.rindex("Exchange")
        assert "partial_" in plan[lowest:], rule.__name__


def test_pushdown_reaches_the_files(spark, tmp_path, txns):
    path = str(tmp_path / "txn")
    txns([("a", "2025-03-01", 200000)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = fraud.alert_counts({HIGH_VALUE: fraud.high_value(stored)})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(amount,100000.0)" in plan
    assert "ReadSchema: struct<amount:double>" in plan
    monthly = summaries.monthly_from_totals(summaries.month_totals(stored), spark.createDataFrame([], CUST_SCHEMA))
    plan = monthly._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_type,DEBIT)" in plan
    plan = fraud.daily_spend(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_type,DEBIT)" in plan
    assert "merchant_name" not in plan


def test_common_columns_of_all_alerts(txns):
    rows = [("a", f"2025-03-01 10:0{i}:00", 400000) for i in range(4)]
    out = fraud.alerts_union(fraud.all_rules(txns(rows)))
    assert out.columns == ["fraud_type", "account_number", "event_date", "amount", "txn_count"]
    by_type = {r.fraud_type: r["n"] for r in out.groupBy("fraud_type").agg(F.count("*").alias("n")).collect()}
    assert by_type == {HIGH_VALUE: 4, BURST: 1, DAILY_SPEND: 1}
