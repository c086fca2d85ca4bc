"""Schema-driven projections used when tables leave the lake."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AS_TEXT = (T.TimestampType, T.TimestampNTZType, T.DateType)
_AS_JSON = (T.StructType, T.ArrayType, T.MapType)


def export_normalize(df: DataFrame) -> DataFrame:
    """Dates and timestamps become text, nested values JSON; the rest stays."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _AS_TEXT):
            value = value.cast("string")
        elif isinstance(field.dataType, _AS_JSON):
            value = F.to_json(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns, in its order and types; a missing column is an error."""
    missing = [name for name in contract if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the contract: {', '.join(missing)}")
    return df.select(*[F.col(name).cast(data_type).alias(name) for name, data_type in contract.items()])
