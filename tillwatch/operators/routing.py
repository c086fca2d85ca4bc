"""Sending rows to the clean or the rejected side, and deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.audit import with_constants
from tillwatch.functions.typed import as_number, as_timestamp
from tillwatch.settings import (
    INVALID_TIMESTAMP,
    MALFORMED,
    MALFORMED_ROW,
    NEGATIVE_AMOUNT,
    NOT_FINITE,
    NULL_ACCOUNT_NUMBER,
    NULL_AMOUNT,
    NULL_CRITICAL,
    NULL_TRANSACTION_ID,
    ZERO_AMOUNT,
)

CUSTOMER_CRITICAL = ("customer_id", "account_number", "account_type")
BRANCH_CRITICAL = ("branch_id", "branch_name")


def split_rejects(
    df: DataFrame,
    rules: Mapping[str, Column],
    keep: Column | None = None,
    rejected_at: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into (clean, rejected); the first rule that holds, in mapping order, is the reason.

    `rules` maps a reason to its condition. `keep` is a further condition for the
    clean side only: rows that break no rule but fail it land on neither side.
    Lines that the raw layer marked as malformed are rejected before any rule; the
    clean side has no such mark. Both sides are narrow plans over `df`.
    """
    if MALFORMED in df.columns:
        rules = {MALFORMED_ROW: F.col(MALFORMED).isNotNull(), **rules}
    reason = F.coalesce(*[F.when(broken, F.lit(text)) for text, broken in rules.items()])
    tagged = df.withColumn("rejection_reason", reason)
    rejected = with_constants(
        tagged.filter(F.col("rejection_reason").isNotNull()), rejected_timestamp=rejected_at
    )
    clean = tagged.filter(F.col("rejection_reason").isNull()).drop("rejection_reason", MALFORMED)
    return (clean if keep is None else clean.filter(keep)), rejected


def _any_null(names: Sequence[str]) -> Column:
    broken = F.col(names[0]).isNull()
    for name in names[1:]:
        broken = broken | F.col(name).isNull()
    return broken


def split_customers(df: DataFrame, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    return split_rejects(df, {NULL_CRITICAL: _any_null(CUSTOMER_CRITICAL)}, rejected_at=rejected_at)


def split_branches(df: DataFrame, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    return split_rejects(df, {NULL_CRITICAL: _any_null(BRANCH_CRITICAL)}, rejected_at=rejected_at)


def split_transactions(
    df: DataFrame, strict: bool = False, rejected_at: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Zero amounts land on neither side, unless `strict` rejects them with their own reason.

    `strict` also rejects infinite amounts and NaN, which otherwise pass. An amount that is no number counts as a null amount.
    """
    amount = as_number("amount")
    rules = {
        NULL_TRANSACTION_ID: F.col("transaction_id").isNull(),
        NULL_ACCOUNT_NUMBER: F.col("account_number").isNull(),
        NULL_AMOUNT: amount.isNull(),
        NEGATIVE_AMOUNT: amount < 0,
        INVALID_TIMESTAMP: as_timestamp("transaction_timestamp").isNull(),
    }
    if strict:
        rules[ZERO_AMOUNT] = amount == 0
        rules[NOT_FINITE] = F.isnan(amount) | (F.abs(amount) == float("inf"))
    return split_rejects(df, rules, keep=amount > 0, rejected_at=rejected_at)


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(field.dataType) for field in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key, the first by `order_by` (default: all other columns), so reruns agree.

    The rank filter becomes a group limit below the shuffle: every task sends at
    most one row per key, however many copies a key has. Null keys form one group.
    """
    if order_by is None:
        order_by = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order_by or keys)))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
