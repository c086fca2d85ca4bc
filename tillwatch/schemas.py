"""Column contracts: raw files as text, warehouse tables with fixed types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# --- fixed values: entity columns, in file order ---
RAW_COLUMNS = {
    "customer": (
        "customer_id",
        "account_number",
        "customer_name",
        "account_type",
        "branch_id",
        "city",
        "state",
        "status",
    ),
    "branch": ("branch_id", "branch_name", "city", "state", "region"),
    "transactions": (
        "transaction_id",
        "account_number",
        "transaction_timestamp",
        "transaction_type",
        "amount",
        "merchant_name",
        "channel",
        "city",
    ),
}

# --- fixed values: warehouse tables, their columns and types ---
CONTRACTS = {
    "CUSTOMER_KPI": {
        "account_number": "string",
        "customer_id": "string",
        "customer_name": "string",
        "account_type": "string",
        "customer_city": "string",
        "customer_state": "string",
        "total_debit": "double",
        "total_credit": "double",
        "total_transactions": "long",
        "avg_transaction_amount": "double",
        "highest_transaction": "double",
        "gold_load_timestamp": "string",
    },
    "CUSTOMER_MONTHLY": {
        "account_number": "string",
        "txn_year": "integer",
        "txn_month": "integer",
        "monthly_spend": "double",
        "avg_transaction": "double",
        "max_transaction": "double",
        "min_transaction": "double",
        "txn_count": "long",
        "customer_id": "string",
        "customer_name": "string",
        "account_type": "string",
        "branch_id": "string",
        "city": "string",
        "state": "string",
        "status": "string",
        "gold_load_timestamp": "string",
    },
    "BRANCH_SUMMARY": {
        "branch_id": "string",
        "branch_name": "string",
        "city": "string",
        "state": "string",
        "region": "string",
        "total_transactions": "long",
        "total_amount": "double",
        "avg_transaction_amount": "double",
        "highest_transaction": "double",
        "unique_customers": "long",
        "total_debit": "double",
        "total_credit": "double",
        "gold_load_timestamp": "string",
    },
    "REGION_SUMMARY": {
        "region": "string",
        "total_transactions": "long",
        "total_amount": "double",
        "unique_customers": "long",
        "total_branches": "long",
        "gold_load_timestamp": "string",
    },
    "FRAUD_HIGH_VALUE": {
        "transaction_id": "string",
        "account_number": "string",
        "transaction_timestamp": "string",
        "transaction_type": "string",
        "amount": "double",
        "merchant_name": "string",
        "channel": "string",
        "city": "string",
        "bronze_load_timestamp": "string",
        "source_file": "string",
        "silver_load_timestamp": "string",
        "transaction_date": "string",
        "fraud_type": "string",
        "fraud_detected_at": "string",
    },
    # The burst rule emits its window, so the contract carries it too.
    "FRAUD_BURST": {
        "account_number": "string",
        "txn_count": "long",
        "total_amount": "double",
        "fraud_type": "string",
        "fraud_detected_at": "string",
        "window_start": "string",
        "window_end": "string",
    },
    "FRAUD_HIGH_SPEND": {
        "account_number": "string",
        "transaction_date": "string",
        "daily_spend": "double",
        "txn_count": "long",
        "fraud_type": "string",
        "fraud_detected_at": "string",
    },
    "FRAUD_DORMANT": {
        "account_number": "string",
        "first_txn_date": "string",
        "last_txn_date": "string",
        "total_txns": "long",
        "gap_days": "integer",
        "fraud_type": "string",
        "fraud_detected_at": "string",
    },
}
# --- end of fixed values ---


def raw_schema(entity: str, header: Sequence[str] | None = None) -> T.StructType:
    """Every raw column is text, so `001` stays `001` and one bad value cannot retype a column.

    Columns stand in the order of `header`, which may hold more than the entity
    needs; one that lacks a column is an error.
    """
    names = RAW_COLUMNS[entity] if header is None else header
    missing = [name for name in RAW_COLUMNS[entity] if name not in names]
    if missing:
        raise ValueError(f"raw {entity} lacks columns: {', '.join(missing)}")
    return T.StructType([T.StructField(name, T.StringType()) for name in names])
