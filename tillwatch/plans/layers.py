"""Bronze and silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.audit import with_constants
from tillwatch.functions.text import clean_label, clean_name
from tillwatch.functions.typed import as_number, as_timestamp
from tillwatch.operators.routing import dedup, split_branches, split_customers, split_transactions
from tillwatch.schemas import raw_schema
from tillwatch.settings import ACTIVE, MALFORMED
from tillwatch.sources.tables import csv_columns, read_csv


def bronze(spark: SparkSession, csv_path: str, entity: str, load_ts: str | None = None) -> DataFrame:
    """Raw files as they are, plus load time and origin; `malformed_row` holds lines that do not fit."""
    schema = raw_schema(entity, csv_columns(spark, csv_path))
    raw = read_csv(spark, csv_path, schema, malformed=MALFORMED)
    return with_constants(raw, bronze_load_timestamp=load_ts, source_file=f"raw/{entity}")


def standardize_text(df: DataFrame, labels: tuple[str, ...], names: tuple[str, ...] = ()) -> DataFrame:
    """Upper-case and trim `labels`, trim `names`."""
    return df.withColumns({c: clean_label(c) for c in labels} | {c: clean_name(c) for c in names})


def silver_customer(df: DataFrame, load_ts: str | None = None) -> DataFrame:
    clean, _ = split_customers(df)
    unique = dedup(clean, ["account_number"])
    tidy = standardize_text(unique, ("city", "state", "account_type", "status"))
    stamped = with_constants(tidy, silver_load_timestamp=load_ts)
    return stamped.withColumn("is_active", F.col("status").eqNullSafe(F.lit(ACTIVE)))


def silver_branch(df: DataFrame, load_ts: str | None = None) -> DataFrame:
    clean, _ = split_branches(df)
    tidy = standardize_text(dedup(clean, ["branch_id"]), ("city", "state", "region"))
    return with_constants(tidy, silver_load_timestamp=load_ts)


def silver_transactions(df: DataFrame, strict: bool = False, load_ts: str | None = None) -> DataFrame:
    clean, _ = split_transactions(df, strict)
    unique = dedup(clean, ["transaction_id"])
    typed = unique.withColumns(
        {"transaction_timestamp": as_timestamp("transaction_timestamp"), "amount": as_number("amount")}
    )
    tidy = standardize_text(typed, ("city", "transaction_type", "channel"), ("merchant_name",))
    stamped = with_constants(tidy, silver_load_timestamp=load_ts)
    return stamped.withColumn("transaction_date", F.col("transaction_timestamp").cast("date"))
