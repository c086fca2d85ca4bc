"""All datasets of the reporting page, derived from the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillwatch.operators import reports
from tillwatch.schemas import CONTRACTS
from tillwatch.settings import BURST, DAILY_SPEND, DORMANT, HIGH_VALUE
from tillwatch.sources.warehouse import Warehouse

ALERT_TABLES = {
    HIGH_VALUE: "FRAUD_HIGH_VALUE",
    BURST: "FRAUD_BURST",
    DAILY_SPEND: "FRAUD_HIGH_SPEND",
    DORMANT: "FRAUD_DORMANT",
}


def warehouse_tables(spark: SparkSession, target: Warehouse) -> dict[str, DataFrame]:
    """The eight warehouse tables by name."""
    return {name: target.read(spark, name) for name in CONTRACTS}


def page_datasets(
    tables: Mapping[str, DataFrame], cust: DataFrame, branch: DataFrame
) -> dict[str, DataFrame]:
    """Every dataset of the page by name, lazily; `cust` and `branch` are only counted."""
    kpi = tables["CUSTOMER_KPI"]
    monthly = tables["CUSTOMER_MONTHLY"]
    branches = tables["BRANCH_SUMMARY"]
    regions = tables["REGION_SUMMARY"]
    alerts = {name: tables[table] for name, table in ALERT_TABLES.items()}
    return {
        "overview_cards": reports.overview_cards(cust, kpi, alerts),
        "top_customers": reports.top_customers(kpi),
        "transactions_by_account_type": reports.transactions_by_account_type(kpi),
        "top_states": reports.top_states(kpi),
        "debit_credit_by_account_type": reports.debit_credit_by_account_type(kpi),
        "fraud_cards": reports.fraud_cards(alerts),
        "fraud_counts_by_type": reports.fraud_counts_by_type(alerts),
        "high_value_by_channel": reports.high_value_by_channel(alerts[HIGH_VALUE]),
        "high_value_listing": reports.high_value_listing(alerts[HIGH_VALUE]),
        "branch_cards": reports.branch_cards(branch, branches),
        "top_branches": reports.top_branches(branches),
        "ranked_regions": reports.ranked_regions(regions),
        "region_metrics": reports.region_metrics(regions),
        "monthly_cards": reports.monthly_cards(monthly),
        "monthly_trend": reports.monthly_trend(monthly),
        "yearly_spend": reports.yearly_spend(monthly),
        "top_monthly_spenders": reports.top_monthly_spenders(monthly),
    }
