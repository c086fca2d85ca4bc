from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import BRANCH_SCHEMA, CUST_SCHEMA
from tillwatch.operators import quality, routing
from tillwatch.plans import layers

RAW = (
    "transaction_id string, account_number string, transaction_timestamp string, transaction_type string, "
    "amount string, merchant_name string, channel string, city string"
)


@pytest.fixture()
def raw(spark):
    def build(*rows):
        base = ("t1", "a1", "2025-03-01 10:00:00", "DEBIT", "10.0", "Shop", "UPI", "Pune")
        names = [part.split()[0] for part in RAW.split(", ")]
        full = [tuple(row.get(n, b) for n, b in zip(names, base, strict=True)) for row in rows]
        return spark.createDataFrame(full, RAW)

    return build


def report(df):
    return {r.metric: r.value for r in df.collect()}


def reasons(df):
    return sorted(r.rejection_reason for r in df.collect())


def test_zero_amount_is_on_neither_side(raw):
    clean, rejected = routing.split_transactions(raw({"amount": "0"}, {"amount": "5"}))
    assert (clean.count(), rejected.count()) == (1, 0)


def test_zero_amount_is_rejected_when_strict(raw):
    clean, rejected = routing.split_transactions(raw({"amount": "0"}, {"amount": "5"}), strict=True)
    assert clean.count() == 1
    assert reasons(rejected) == ["Zero amount"]


def test_strict_keeps_the_earlier_reasons(raw):
    df = raw({"amount": "0", "transaction_timestamp": "bad"})
    assert reasons(routing.split_transactions(df, strict=True)[1]) == ["Invalid timestamp"]


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ({"transaction_id": None, "amount": "-5"}, "Null transaction_id"),
        ({"account_number": None, "amount": None}, "Null account_number"),
        ({"amount": None, "transaction_timestamp": "bad"}, "Null amount"),
        ({"amount": "-1", "transaction_timestamp": "bad"}, "Negative amount"),
        ({"transaction_timestamp": "bad"}, "Invalid timestamp"),
        ({"transaction_timestamp": None}, "Invalid timestamp"),
        ({"amount": "ten"}, "Null amount"),
    ],
)
def test_first_reason_wins(raw, row, reason):
    clean, rejected = routing.split_transactions(raw(row), rejected_at="now")
    assert clean.count() == 0
    assert [(r.rejection_reason, r.rejected_timestamp) for r in rejected.collect()] == [(reason, "now")]


def test_every_row_is_accounted_for(raw):
    df = raw(
        {}, {}, {"transaction_id": "t2"}, {"amount": "0"}, {"amount": "-1"}, {"transaction_timestamp": "x"}
    )
    clean, rejected = routing.split_transactions(df)
    kept = routing.dedup(clean, ["transaction_id"]).count()
    assert kept + (clean.count() - kept) + rejected.count() + 1 == df.count()
    assert kept == 2


def test_domain_checks_skip_nulls_and_respect_case(spark):
    rows = [(t,) for t in ("SAVINGS", "savings", None, "OTHER")]
    df = spark.createDataFrame(rows, "account_type string")
    assert df.filter(quality.outside("account_type", quality.ACCOUNT_TYPES)).count() == 2


def test_report_of_transactions(raw):
    df = raw(
        {},
        {},
        {"transaction_id": None},
        {"transaction_id": None, "channel": None},
        {"transaction_id": "t2", "amount": "-3", "transaction_type": " debit"},
        {"transaction_id": "t3", "transaction_timestamp": "2031-01-01"},
        {"transaction_id": "t4", "amount": "ten", "channel": "upi"},
    )
    assert report(quality.transaction_quality(df, datetime(2030, 1, 1))) == {
        "total_records": 7,
        "null_transaction_id": 2,
        "null_account_number": 0,
        "null_amount": 0,
        "duplicate_transaction_id": 2,
        "negative_amount": 1,
        "future_transaction_timestamp": 1,
        "invalid_transaction_type": 1,
        "invalid_channel": 1,
    }


def test_report_of_an_empty_table(spark):
    df = spark.createDataFrame([], CUST_SCHEMA)
    assert set(report(quality.customer_quality(df)).values()) == {0}


def test_future_defaults_to_the_clock(raw):
    df = raw({"transaction_timestamp": "2999-01-01"}, {})
    assert report(quality.transaction_quality(df))["future_transaction_timestamp"] == 1


def test_null_account_type_rejects_but_null_region_does_not(spark):
    cust = spark.createDataFrame([("c", "a", "n", None, "b", "x", "y", "z")], CUST_SCHEMA)
    branch = spark.createDataFrame([("b", "n", "x", "y", None)], BRANCH_SCHEMA)
    assert routing.split_customers(cust)[1].count() == 1
    assert routing.split_branches(branch)[1].count() == 0


def test_dedup_is_repeatable_and_folds_null_keys(spark):
    rows = [("k", "b"), ("k", "a"), (None, "d"), (None, "c"), ("m", "e")]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "key string, value string").repartition(3)
        got = sorted(routing.dedup(df, ["key"]).collect(), key=repr)
        assert [tuple(r) for r in got] == [("k", "a"), ("m", "e"), (None, "c")]


def test_dedup_follows_a_given_order(spark):
    df = spark.createDataFrame([("k", 1), ("k", 3), ("k", 2)], "key string, value int")
    assert routing.dedup(df, ["key"], [F.desc("value")]).collect()[0].value == 3


def test_dedup_limits_copies_before_the_shuffle(spark):
    """A third of all rows are copies of one key; the plan drops them on the map side."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), "id")
    unique = routing.dedup(df, ["key"])
    assert unique.count() == 6001
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_silver_customer(spark):
    rows = [
        ("c1", "001", "Ann", " savings", "b", " pune", "mh ", " active"),
        ("c2", "002", "Bob", "NRI", "b", "x", "y", None),
        ("c3", None, "Cat", "NRI", "b", "x", "y", "ACTIVE"),
    ]
    out = layers.silver_customer(spark.createDataFrame(rows, CUST_SCHEMA), "now").orderBy("customer_id")
    first, second = out.collect()
    assert (first.account_number, first.account_type, first.city, first.state) == ("001", "SAVINGS", "PUNE", "MH")
    assert (first.is_active, second.is_active) == (True, False)
    assert first.silver_load_timestamp == "now"
    assert out.columns[-2:] == ["silver_load_timestamp", "is_active"]


def test_silver_branch_upper_cases_the_region(spark):
    df = spark.createDataFrame([("b", " Main ", "pune", "mh", " North")], BRANCH_SCHEMA)
    row = layers.silver_branch(df).collect()[0]
    assert (row.region, row.branch_name) == ("NORTH", " Main ")


def test_silver_transactions_are_typed(raw):
    df = layers.silver_transactions(raw({"merchant_name": "  Shop a ", "channel": " upi"}), load_ts="now")
    row = df.collect()[0]
    assert dict(df.dtypes)["amount"] == "double"
    assert dict(df.dtypes)["transaction_timestamp"] == "timestamp"
    assert (row.merchant_name, row.channel, str(row.transaction_date)) == ("Shop a", "UPI", "2025-03-01")


def test_describe_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert [tuple(r) for r in quality.describe_table(df).orderBy("position").collect()] == [
        (1, "a", "int", 2),
        (2, "b c", "string", 1),
    ]
