"""Constant columns that say when and from where a row was loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.settings import STAMP_FORMAT


def run_stamp(at: datetime | None = None) -> str:
    """One stamp per run, taken on the driver, so that all tables of a run carry the same one."""
    return (at or datetime.now()).strftime(STAMP_FORMAT)


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """Add one literal column per keyword; a keyword that is None adds nothing."""
    return df.withColumns({name: F.lit(value) for name, value in values.items() if value is not None})
