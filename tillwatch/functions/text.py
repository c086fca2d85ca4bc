"""Text clean-up and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwatch.settings import CRORE, RUPEE


def clean_label(name: str) -> Column:
    """Trimmed and upper-cased: the stored form of codes and place names."""
    return F.upper(F.trim(F.col(name)))


def clean_name(name: str) -> Column:
    """Trimmed only: the stored form of free names."""
    return F.trim(F.col(name))


def whole_text(value: Column) -> Column:
    """1234567.5 -> `1,234,568`, ties to the even neighbour."""
    return F.format_number(value, 0)


def money_text(value: Column) -> Column:
    """1234567.5 -> `₹1,234,568`."""
    return F.concat(F.lit(RUPEE), whole_text(value))


def crore_text(value: Column) -> Column:
    """12345678 -> `₹1.2 Cr`, without digit grouping."""
    # format_number rounds ties to even like the original; format_string would round them up.
    plain = F.translate(F.format_number(value / F.lit(float(CRORE)), 1), ",", "")
    return F.concat(F.lit(RUPEE), plain, F.lit(" Cr"))


def period_text(year: str, month: str) -> Column:
    """2025, 3 -> `2025-03`."""
    return F.format_string("%d-%02d", F.col(year), F.col(month))
