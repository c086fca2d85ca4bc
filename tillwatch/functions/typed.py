"""Parsing that yields null on bad input; Spark's ANSI mode would fail the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(name: str) -> Column:
    return F.try_to_timestamp(F.col(name))


def as_number(name: str) -> Column:
    return F.col(name).try_cast("double")


def money(total: Column) -> Column:
    """Amounts are kept with two decimals in the gold layer."""
    return F.round(total, 2)
