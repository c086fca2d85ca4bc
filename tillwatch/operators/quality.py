"""Data-quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.typed import as_number, as_timestamp
from tillwatch.settings import ACCOUNT_TYPES, CHANNELS, MALFORMED, REGIONS, TRANSACTION_TYPES


def outside(name: str, allowed: Sequence[str]) -> Column:
    """True for a value outside the domain, null (so not counted) for a null."""
    return ~F.col(name).isin(*allowed)


def in_future(name: str, as_of: datetime | None) -> Column:
    """True where the parsed timestamp lies after `as_of` (default: now)."""
    # As text, a date without a zone means the session's zone and not the driver's.
    limit = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return as_timestamp(name) > limit


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows, rows kept by deduplication on `key`, and rows it drops; null keys count as one value.

    Keys are counted within tasks first, and only keys with their counts are shuffled.
    """
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    kept = F.count(F.lit(1))
    return copies.agg(
        total.alias("total_records"),
        kept.alias("distinct_records"),
        (total - kept).alias("duplicate_records"),
    )


def quality_report(
    df: DataFrame,
    key: str,
    not_null: Sequence[str] = (),
    domains: Mapping[str, Sequence[str]] | None = None,
    non_negative: Sequence[str] = (),
    not_future: Sequence[str] = (),
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per metric.

    All plain counts come from one pass without a shuffle. Duplicates are counted
    apart, over the key column alone: in one aggregate every key would have to
    carry all other counters through the shuffle. A raw layer's malformed lines are counted too.
    """
    checks: dict[str, Column] = {"total_records": F.count(F.lit(1))}
    if MALFORMED in df.columns:
        checks["malformed_rows"] = F.count(MALFORMED)
    for name in not_null:
        checks[f"null_{name}"] = F.count_if(F.col(name).isNull())
    for name in non_negative:
        checks[f"negative_{name}"] = F.count_if(as_number(name) < 0)
    for name in not_future:
        checks[f"future_{name}"] = F.count_if(in_future(name, as_of))
    for name, allowed in (domains or {}).items():
        checks[f"invalid_{name}"] = F.count_if(outside(name, allowed))
    counts = df.agg(*[check.alias(metric) for metric, check in checks.items()])
    duplicates = duplicate_counts(df, key).select(
        F.lit(f"duplicate_{key}").alias("metric"), F.col("duplicate_records").alias("value")
    )
    return counts.unpivot([], list(checks), "metric", "value").unionByName(duplicates)


def customer_quality(df: DataFrame) -> DataFrame:
    return quality_report(
        df,
        "account_number",
        not_null=["customer_id", "account_number"],
        domains={"account_type": ACCOUNT_TYPES},
    )


def branch_quality(df: DataFrame) -> DataFrame:
    return quality_report(
        df, "branch_id", not_null=["branch_id", "branch_name"], domains={"region": REGIONS}
    )


def transaction_quality(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return quality_report(
        df,
        "transaction_id",
        not_null=["transaction_id", "account_number", "amount"],
        domains={"transaction_type": TRANSACTION_TYPES, "channel": CHANNELS},
        non_negative=["amount"],
        not_future=["transaction_timestamp"],
        as_of=as_of,
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Position, name and type of every column with its non-null count, from one pass."""
    names = df.columns
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in names])
    # The schema is known when the plan is built, so it enters as literals.
    known = F.lit(None).cast("struct<position:int,data_type:string>")
    for position, name in enumerate(names, start=1):
        entry = F.struct(F.lit(position).alias("position"), F.lit(types[name]).alias("data_type"))
        known = F.when(F.col("column_name") == name, entry).otherwise(known)
    return (
        counts.unpivot([], [F.col(f"`{name}`") for name in names], "column_name", "non_null")
        .withColumn("known", known)
        .select("known.position", "column_name", "known.data_type", "non_null")
    )
