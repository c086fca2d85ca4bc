"""Datasets of the reporting page, derived from gold tables.

Groups without a key are left out, as the page never showed them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.text import crore_text, money_text, period_text, whole_text
from tillwatch.functions.typed import money
from tillwatch.operators.fraud import alert_totals
from tillwatch.settings import BURST, DAILY_SPEND, DORMANT, HIGH_VALUE

# --- fixed values: display names of the rules, and the text shown instead of an amount ---
RULE_TITLES = {
    HIGH_VALUE: "High Value",
    BURST: "Rapid Burst",
    DAILY_SPEND: "High Daily Spend",
    DORMANT: "Dormant Active",
}
NO_AMOUNT = "Suspicious"
# --- end of fixed values ---


def top_rows(df: DataFrame, measure: str, n: int, *tie_break: str) -> DataFrame:
    """The n largest rows by `measure`; nulls never rank, ties go by `tie_break`.

    Each task keeps n rows and only those are merged.
    """
    return df.filter(F.col(measure).isNotNull()).orderBy(F.desc(measure), *tie_break).limit(n)


def _grouped_sum(df: DataFrame, key: str, **sums: str) -> DataFrame:
    """Null keys out, then one money sum per keyword (output name = input column)."""
    totals = [money(F.sum(source)).alias(target) for target, source in sums.items()]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*totals)


def _cards(df: DataFrame, **cards: tuple[Column, Column]) -> DataFrame:
    """One row per card from a single row: its numeric value and its display text."""
    entries = [
        F.struct(F.lit(name).alias("card"), value.cast("double").alias("value"), text.alias("display"))
        for name, (value, text) in cards.items()
    ]
    return df.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def _count_card(df: DataFrame, name: str, grouped: bool = True) -> DataFrame:
    n = F.col("n")
    text = whole_text(n) if grouped else n.cast("string")
    return _cards(df.agg(F.count(F.lit(1)).alias("n")), **{name: (n, text)})


def overview_cards(cust: DataFrame, kpi: DataFrame, alerts: Mapping[str, DataFrame]) -> DataFrame:
    """Customers, transactions, total debit and alerts; customers are counted, not assumed."""
    return overview_from_totals(cust, kpi, alert_totals(alerts))


def overview_from_totals(cust: DataFrame, kpi: DataFrame, alerts: DataFrame) -> DataFrame:
    """`kpi` needs total_transactions and total_debit only, `alerts` one row per rule."""
    sums = kpi.agg(F.sum("total_transactions").alias("txns"), money(F.sum("total_debit")).alias("debit"))
    from_kpi = _cards(
        sums,
        total_transactions=(F.col("txns"), whole_text(F.col("txns"))),
        total_debit=(F.col("debit"), crore_text(F.col("debit"))),
    )
    found = alerts.agg(F.sum("alerts").alias("n"))
    from_alerts = _cards(found, total_alerts=(F.col("n"), F.col("n").cast("string")))
    return _count_card(cust, "total_customers").unionByName(from_kpi).unionByName(from_alerts)


def top_customers(kpi: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(kpi, "total_debit", n, "account_number").select(
        "customer_name", "account_type", "total_debit"
    )


def transactions_by_account_type(kpi: DataFrame) -> DataFrame:
    known = kpi.filter(F.col("account_type").isNotNull())
    return known.groupBy("account_type").agg(F.sum("total_transactions").alias("total"))


def top_states(kpi: DataFrame, n: int = 10) -> DataFrame:
    by_state = _grouped_sum(kpi, "customer_state", total_debit="total_debit")
    return top_rows(by_state, "total_debit", n, "customer_state")


def debit_credit_by_account_type(kpi: DataFrame) -> DataFrame:
    wide = _grouped_sum(kpi, "account_type", Debit="total_debit", Credit="total_credit")
    return wide.unpivot("account_type", ["Debit", "Credit"], "type", "amount")


def fraud_cards(alerts: Mapping[str, DataFrame]) -> DataFrame:
    """Alerts and amount per rule; the dormant rule has no amount of its own."""
    return cards_from_totals(alert_totals(alerts))


def _titles() -> Column:
    return F.coalesce(*[F.when(F.col("fraud_type") == name, title) for name, title in RULE_TITLES.items()])


def cards_from_totals(totals: DataFrame) -> DataFrame:
    # A rule without alerts adds up to nothing, which is shown as zero.
    text = F.when(F.col("fraud_type") == DORMANT, NO_AMOUNT).otherwise(
        crore_text(F.coalesce("amount", F.lit(0.0)))
    )
    rounded = totals.withColumn("amount", money(F.col("amount")))
    return rounded.select(_titles().alias("rule"), "alerts", "amount", text.alias("display"))


def fraud_counts_by_type(alerts: Mapping[str, DataFrame]) -> DataFrame:
    return counts_from_totals(alert_totals(alerts))


def counts_from_totals(totals: DataFrame) -> DataFrame:
    return totals.select(_titles().alias("type"), F.col("alerts").alias("count"))


def high_value_by_channel(high_value_alerts: DataFrame) -> DataFrame:
    known = high_value_alerts.filter(F.col("channel").isNotNull())
    return known.groupBy("channel").agg(F.count("transaction_id").alias("count"))


def high_value_listing(high_value_alerts: DataFrame, n: int = 20) -> DataFrame:
    """The first n alerts by transaction id, amounts as text."""
    return (
        high_value_alerts.select(
            "transaction_id", "account_number", "amount", "channel", "transaction_timestamp"
        )
        .orderBy("transaction_id")
        .limit(n)
        .withColumn("amount", money_text(F.col("amount")))
    )


def branch_cards(branch: DataFrame, summary: DataFrame) -> DataFrame:
    """Branches, transactions and amount; branches are counted, not assumed."""
    sums = summary.agg(
        F.sum("total_transactions").alias("txns"), money(F.sum("total_amount")).alias("amount")
    )
    from_summary = _cards(
        sums,
        total_transactions=(F.col("txns"), whole_text(F.col("txns"))),
        total_amount=(F.col("amount"), crore_text(F.col("amount"))),
    )
    return _count_card(branch, "total_branches", grouped=False).unionByName(from_summary)


def top_branches(summary: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(summary, "total_amount", n, "branch_id")


def ranked_regions(summary: DataFrame) -> DataFrame:
    """All regions, the largest amount first, with their share of the whole amount.

    The share is null where the whole amount is zero or null.
    """
    whole = summary.agg(F.sum("total_amount")).scalar()
    shared = summary.withColumn("amount_share", F.round(F.try_divide("total_amount", whole), 4))
    return shared.orderBy(F.desc_nulls_last("total_amount"), "region")


def region_metrics(summary: DataFrame) -> DataFrame:
    """Transactions and customers of each region as rows."""
    return summary.unpivot("region", ["total_transactions", "unique_customers"], "metric", "value")


def monthly_cards(monthly: DataFrame) -> DataFrame:
    """Records, mean and largest monthly spend."""
    spend = F.col("monthly_spend")
    row = monthly.agg(
        F.count(F.lit(1)).alias("records"), money(F.avg(spend)).alias("mean"), F.max(spend).alias("top")
    )
    return _cards(
        row,
        monthly_records=(F.col("records"), whole_text(F.col("records"))),
        avg_monthly_spend=(F.col("mean"), money_text(F.col("mean"))),
        max_monthly_spend=(F.col("top"), money_text(F.col("top"))),
    )


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Spend per month and account type, with the month as `YYYY-MM`."""
    known = monthly.filter(F.col("account_type").isNotNull())
    return (
        known.groupBy("txn_year", "txn_month", "account_type")
        .agg(money(F.sum("monthly_spend")).alias("total_spend"))
        .withColumn("period", period_text("txn_year", "txn_month"))
    )


def yearly_spend(monthly: DataFrame) -> DataFrame:
    by_year = _grouped_sum(monthly, "txn_year", total_spend="monthly_spend")
    return by_year.withColumn("txn_year", F.col("txn_year").cast("string"))


def top_monthly_spenders(monthly: DataFrame, n: int = 10) -> DataFrame:
    best = top_rows(monthly, "monthly_spend", n, "account_number", "txn_year", "txn_month")
    return best.select(
        "customer_name",
        "account_type",
        "txn_year",
        "txn_month",
        money_text(F.col("monthly_spend")).alias("monthly_spend"),
    )
