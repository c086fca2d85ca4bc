"""Gold summaries.

Transactions are folded to one row per account before any join. That fold has a
map-side half, so an account holding a large share of all rows costs no more
than another one, and the joins move accounts instead of transactions.
Customers must be unique per account and branches per branch id, which the
silver layer ensures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.audit import with_constants
from tillwatch.functions.typed import money
from tillwatch.settings import CREDIT, DEBIT

BRANCH_COLUMNS = ("branch_id", "branch_name", "city", "state", "region")


def _only(txn_type: str, amount: str) -> Column:
    return F.sum(F.when(F.col("transaction_type") == txn_type, F.col(amount)).otherwise(F.lit(0.0)))


def link_branch(txn: DataFrame, cust: DataFrame, branch: DataFrame) -> DataFrame:
    """Every transaction with its branch; unknown accounts keep null branch columns.

    Customers meet their branch first, so the transactions take part in one join
    only. Where that join has to shuffle, adaptive execution splits a busy account.
    """
    place = branch.select(*BRANCH_COLUMNS)
    owner = cust.select("account_number", "branch_id").join(place, "branch_id", "left")
    facts = [c for c in txn.columns if c not in ("account_number", "city")]
    linked = txn.drop("city").join(owner, "account_number", "left")
    return linked.select("branch_id", "account_number", *facts, *BRANCH_COLUMNS[1:])


def account_totals(txn: DataFrame) -> DataFrame:
    """Unrounded totals per account, the shared input of the KPI, branch and region tables."""
    return txn.groupBy("account_number").agg(
        F.count("transaction_id").alias("txn_count"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_count"),
        F.max("amount").alias("amount_max"),
        _only(DEBIT, "amount").alias("debit_sum"),
        _only(CREDIT, "amount").alias("credit_sum"),
    )


def _totals() -> list[Column]:
    return [
        F.count("transaction_id").alias("txn_count"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_count"),
        F.max("amount").alias("amount_max"),
        F.min("amount").alias("amount_min"),
    ]


def month_totals(txn: DataFrame) -> DataFrame:
    """Unrounded totals per account, calendar month and type, the finest grain any summary needs."""
    when = F.col("transaction_timestamp")
    return txn.groupBy(
        "account_number",
        F.year(when).alias("txn_year"),
        F.month(when).alias("txn_month"),
        "transaction_type",
    ).agg(*_totals())


def day_totals(txn: DataFrame) -> DataFrame:
    """Unrounded totals per account, day and type.

    Stored once, they feed all summaries and the alert rules on days and activity
    from a single pass over the transactions.
    """
    return txn.groupBy("account_number", "transaction_date", "transaction_type").agg(*_totals())


def months_from_days(days: DataFrame) -> DataFrame:
    when = F.col("transaction_date")
    return days.groupBy(
        "account_number",
        F.year(when).alias("txn_year"),
        F.month(when).alias("txn_month"),
        "transaction_type",
    ).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amount_sum").alias("amount_sum"),
        F.sum("amount_count").alias("amount_count"),
        F.max("amount_max").alias("amount_max"),
        F.min("amount_min").alias("amount_min"),
    )


def account_totals_from_months(months: DataFrame) -> DataFrame:
    return months.groupBy("account_number").agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amount_sum").alias("amount_sum"),
        F.sum("amount_count").alias("amount_count"),
        F.max("amount_max").alias("amount_max"),
        _only(DEBIT, "amount_sum").alias("debit_sum"),
        _only(CREDIT, "amount_sum").alias("credit_sum"),
    )


def customer_kpi(txn: DataFrame, cust: DataFrame, load_ts: str | None = None) -> DataFrame:
    """Lifetime figures per account with the customer's attributes."""
    return kpi_from_totals(account_totals(txn), cust, load_ts)


def kpi_from_totals(totals: DataFrame, cust: DataFrame, load_ts: str | None = None) -> DataFrame:
    owner = cust.select(
        "account_number",
        "customer_id",
        "customer_name",
        "account_type",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )
    kpi = totals.join(owner, "account_number", "left").select(
        "account_number",
        "customer_id",
        "customer_name",
        "account_type",
        "customer_city",
        "customer_state",
        money(F.col("debit_sum")).alias("total_debit"),
        money(F.col("credit_sum")).alias("total_credit"),
        F.col("txn_count").alias("total_transactions"),
        money(F.try_divide("amount_sum", "amount_count")).alias("avg_transaction_amount"),
        money(F.col("amount_max")).alias("highest_transaction"),
    )
    return with_constants(kpi, gold_load_timestamp=load_ts)


def customer_monthly(
    txn: DataFrame, cust: DataFrame, txn_type: str = DEBIT, load_ts: str | None = None
) -> DataFrame:
    """Spend per account and calendar month with the customer's attributes.

    The type is a grouping key, so the filter on it moves below the fold into the scan.
    """
    return monthly_from_totals(month_totals(txn), cust, txn_type, load_ts)


def monthly_from_totals(
    months: DataFrame, cust: DataFrame, txn_type: str = DEBIT, load_ts: str | None = None
) -> DataFrame:
    monthly = months.filter(F.col("transaction_type") == txn_type).select(
        "account_number",
        "txn_year",
        "txn_month",
        money(F.col("amount_sum")).alias("monthly_spend"),
        money(F.try_divide("amount_sum", "amount_count")).alias("avg_transaction"),
        money(F.col("amount_max")).alias("max_transaction"),
        money(F.col("amount_min")).alias("min_transaction"),
        "txn_count",
    )
    owner = cust.select(
        "account_number",
        "customer_id",
        "customer_name",
        "account_type",
        "branch_id",
        "city",
        "state",
        "status",
    )
    return with_constants(monthly.join(owner, "account_number", "left"), gold_load_timestamp=load_ts)


def branch_totals(totals: DataFrame, cust: DataFrame, branch: DataFrame) -> DataFrame:
    """Account totals folded to branches, unrounded; one row per branch, few enough for any join."""
    return (
        totals.join(cust.select("account_number", "branch_id"), "account_number", "left")
        .groupBy("branch_id")
        .agg(
            F.sum("txn_count").alias("txn_count"),
            F.sum("amount_sum").alias("amount_sum"),
            F.sum("amount_count").alias("amount_count"),
            F.max("amount_max").alias("amount_max"),
            F.count("account_number").alias("customers"),
            F.sum("debit_sum").alias("debit_sum"),
            F.sum("credit_sum").alias("credit_sum"),
        )
        .join(branch.select(*BRANCH_COLUMNS), "branch_id", "left")
    )


def branch_summary(
    txn: DataFrame, cust: DataFrame, branch: DataFrame, load_ts: str | None = None
) -> DataFrame:
    return branch_from_totals(account_totals(txn), cust, branch, load_ts)


def branch_from_totals(
    totals: DataFrame, cust: DataFrame, branch: DataFrame, load_ts: str | None = None
) -> DataFrame:
    summary = branch_totals(totals, cust, branch).select(
        *BRANCH_COLUMNS,
        F.col("txn_count").alias("total_transactions"),
        money(F.col("amount_sum")).alias("total_amount"),
        money(F.try_divide("amount_sum", "amount_count")).alias("avg_transaction_amount"),
        money(F.col("amount_max")).alias("highest_transaction"),
        F.col("customers").alias("unique_customers"),
        money(F.col("debit_sum")).alias("total_debit"),
        money(F.col("credit_sum")).alias("total_credit"),
    )
    return with_constants(summary, gold_load_timestamp=load_ts)


def region_summary(
    txn: DataFrame, cust: DataFrame, branch: DataFrame, load_ts: str | None = None
) -> DataFrame:
    return region_from_totals(account_totals(txn), cust, branch, load_ts)


def region_from_totals(
    totals: DataFrame, cust: DataFrame, branch: DataFrame, load_ts: str | None = None
) -> DataFrame:
    """Branch totals folded once more. An account has one branch and a branch one region,
    so both distinct counts are plain sums here."""
    summary = (
        branch_totals(totals, cust, branch)
        .groupBy("region")
        .agg(
            F.sum("txn_count").alias("total_transactions"),
            money(F.sum("amount_sum")).alias("total_amount"),
            F.sum("customers").alias("unique_customers"),
            F.count("branch_id").alias("total_branches"),
        )
    )
    return with_constants(summary, gold_load_timestamp=load_ts)


def account_activity(txn: DataFrame) -> DataFrame:
    """First and last day and number of transactions per account."""
    return txn.groupBy("account_number").agg(
        F.min("transaction_date").alias("first_txn_date"),
        F.max("transaction_date").alias("last_txn_date"),
        F.count("transaction_id").alias("total_txns"),
    )


def activity_from_days(days: DataFrame) -> DataFrame:
    return days.groupBy("account_number").agg(
        F.min("transaction_date").alias("first_txn_date"),
        F.max("transaction_date").alias("last_txn_date"),
        F.sum("txn_count").alias("total_txns"),
    )
