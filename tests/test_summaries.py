from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import BRANCH_SCHEMA, CUST_SCHEMA
from tillwatch.operators import reports, summaries


@pytest.fixture()
def star(spark, txns):
    txn = txns(
        [
            ("a1", "2025-01-05", 100.255),
            ("a1", "2025-01-09", 50, "CREDIT"),
            ("a1", "2025-02-01", 10),
            ("a2", "2025-01-07", 1000),
            ("a3", "2025-01-07", 7, "CREDIT"),
            ("lost", "2025-01-07", 5),
        ]
    )
    cust = spark.createDataFrame(
        [
            ("c1", "a1", "Ann", "SAVINGS", "b1", "PUNE", "MH", "ACTIVE"),
            ("c2", "a2", "Bob", "NRI", "b1", "PUNE", "MH", "ACTIVE"),
            ("c3", "a3", "Cat", "NRI", "nowhere", "GOA", None, "ACTIVE"),
            ("c4", "idle", "Dan", "NRI", "b2", "GOA", "GA", "ACTIVE"),
        ],
        CUST_SCHEMA,
    )
    branch = spark.createDataFrame(
        [("b1", "Main", "PUNE", "MH", "NORTH"), ("b2", "Side", "GOA", "GA", "SOUTH")], BRANCH_SCHEMA
    )
    return txn, cust, branch


def test_monthly_keeps_unknown_accounts(star):
    txn, cust, _ = star
    rows = {(r.account_number, r.txn_month): r for r in summaries.customer_monthly(txn, cust).collect()}
    assert set(rows) == {("a1", 1), ("a1", 2), ("a2", 1), ("lost", 1)}
    assert rows["lost", 1].customer_name is None
    assert (rows["a1", 1].monthly_spend, rows["a1", 1].txn_count) == (100.26, 1)


def test_kpi_columns_and_sums(star):
    txn, cust, _ = star
    kpi = summaries.customer_kpi(txn, cust, "now")
    assert kpi.columns == [
        "account_number",
        "customer_id",
        "customer_name",
        "account_type",
        "customer_city",
        "customer_state",
        "total_debit",
        "total_credit",
        "total_transactions",
        "avg_transaction_amount",
        "highest_transaction",
        "gold_load_timestamp",
    ]
    row = kpi.filter("account_number = 'a1'").collect()[0]
    assert (row.total_debit, row.total_credit, row.total_transactions) == (110.26, 50.0, 3)
    assert kpi.count() == 4


def test_month_totals_feed_every_summary(star):
    txn, cust, branch = star
    months = summaries.month_totals(txn)
    totals = summaries.account_totals_from_months(months)
    pairs = [
        (summaries.monthly_from_totals(months, cust), summaries.customer_monthly(txn, cust)),
        (summaries.kpi_from_totals(totals, cust), summaries.customer_kpi(txn, cust)),
        (summaries.branch_from_totals(totals, cust, branch), summaries.branch_summary(*star)),
        (summaries.region_from_totals(totals, cust, branch), summaries.region_summary(*star)),
    ]
    for got, expected in pairs:
        assert got.dtypes == expected.dtypes
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_link_keeps_every_transaction(star):
    linked = summaries.link_branch(*star)
    assert linked.count() == 6
    assert linked.columns[:2] == ["branch_id", "account_number"]
    assert linked.columns[-4:] == ["branch_name", "city", "state", "region"]
    assert linked.filter("branch_id = 'nowhere' and region is null").count() == 1
    assert linked.filter("account_number = 'lost' and branch_id is null").count() == 1


def test_branch_and_region_totals_agree(star):
    branches = {r.branch_id: r for r in summaries.branch_summary(*star).collect()}
    assert set(branches) == {"b1", "nowhere", None}
    assert (branches["b1"].unique_customers, branches["b1"].total_transactions) == (2, 4)
    regions = {r.region: r for r in summaries.region_summary(*star).collect()}
    assert set(regions) == {"NORTH", None}
    # The null region holds one unmatched branch id and one account without a customer.
    assert (regions[None].total_branches, regions[None].unique_customers) == (1, 2)
    total = sum(r.total_amount for r in branches.values())
    assert total == pytest.approx(sum(r.total_amount for r in regions.values()))
    assert total == pytest.approx(1172.26, abs=0.01)


def test_summaries_equal_join_first_forms(star):
    from pyspark.sql import functions as F

    linked = summaries.link_branch(*star)
    expected = linked.groupBy("region").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        F.countDistinct("account_number").alias("unique_customers"),
        F.countDistinct("branch_id").alias("total_branches"),
    )
    got = summaries.region_summary(*star)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_averages_of_accounts_without_amounts(spark, txns, star):
    from pyspark.sql import functions as F

    txn = txns([("a1", "2025-01-05", 1)]).withColumn("amount", F.lit(None).cast("double"))
    row = summaries.customer_kpi(txn, star[1]).collect()[0]
    assert (row.total_transactions, row.avg_transaction_amount) == (1, None)


def test_monthly_sum_is_the_debit_total(star):
    txn, cust, _ = star
    monthly = sum(r.monthly_spend for r in summaries.customer_monthly(txn, cust).collect())
    kpi = sum(r.total_debit for r in summaries.customer_kpi(txn, cust).collect())
    assert monthly == pytest.approx(kpi, abs=0.02)


def test_big_transactions_join_once(star):
    """Account totals, not transactions, meet the customers."""
    plan = summaries.branch_summary(*star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")


def test_a_busy_account_is_split_in_the_row_level_link(spark, star):
    """A third of the transactions belong to one account and nothing is small enough to broadcast."""
    from pyspark.sql import functions as F

    txn = spark.range(0, 900_000, 1, 8).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("a1"))
        .otherwise(F.concat(F.lit("x"), F.col("id") % 5000))
        .alias("account_number"),
        F.sha2(F.col("id").cast("string"), 256).alias("merchant_name"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        linked = summaries.link_branch(txn, star[1], star[2])
        linked = linked.agg(F.count_if(F.col("region") == "NORTH"), F.max("merchant_name"), F.count("*"))
        row = linked.collect()[0]
        plan = linked._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert (row[0], row[2]) == (300_000, 900_000)
    assert "SortMergeJoin(skew=true)" in plan


def test_reports_drop_null_groups_and_rank(star):
    txn, cust, branch = star
    kpi = summaries.customer_kpi(txn, cust)
    by_type = {r.account_type: r.total for r in reports.transactions_by_account_type(kpi).collect()}
    assert by_type == {"SAVINGS": 3, "NRI": 2}
    assert [r.customer_state for r in reports.top_states(kpi).collect()] == ["MH"]
    assert [r.customer_name for r in reports.top_customers(kpi, 2).collect()] == ["Bob", "Ann"]
    melted = reports.debit_credit_by_account_type(kpi)
    assert melted.columns == ["account_type", "type", "amount"]
    assert melted.count() == 4
    regions = summaries.region_summary(*star)
    ranked = reports.ranked_regions(regions)
    assert [r.region for r in ranked.collect()] == ["NORTH", None]
    assert sum(r.amount_share for r in ranked.collect()) == pytest.approx(1, abs=1e-3)
    nothing = reports.ranked_regions(regions.withColumn("total_amount", F.lit(0.0)))
    assert [r.amount_share for r in nothing.collect()] == [None, None]
    assert reports.region_metrics(regions).count() == 4


def test_monthly_reports(star):
    monthly = summaries.customer_monthly(star[0], star[1])
    cards = {r.card: (r.value, r.display) for r in reports.monthly_cards(monthly).collect()}
    assert cards["monthly_records"] == (4.0, "4")
    assert cards["max_monthly_spend"] == (1000.0, "₹1,000")
    periods = {(r.period, r.account_type): r.total_spend for r in reports.monthly_trend(monthly).collect()}
    assert periods == {
        ("2025-01", "SAVINGS"): 100.26,
        ("2025-01", "NRI"): 1000.0,
        ("2025-02", "SAVINGS"): 10.0,
    }
    assert [tuple(r) for r in reports.yearly_spend(monthly).collect()] == [("2025", 1115.26)]
    best = reports.top_monthly_spenders(monthly, 1).collect()[0]
    assert (best.customer_name, best.monthly_spend) == ("Bob", "₹1,000")


def test_top_rows_skip_nulls_and_break_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, v double")
    assert [r.k for r in reports.top_rows(df, "v", 3, "k").collect()] == ["d", "a", "b"]
    plan = reports.top_rows(df, "v", 3, "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
