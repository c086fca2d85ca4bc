"""Loading only what a table does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.operators import routing
from tillwatch.sources.keyed import KEEP, KeyedTable, Loaded, identity


def fresh_rows(
    source: DataFrame, target: DataFrame, key: str = "transaction_id", day: str = "transaction_date"
) -> DataFrame:
    """Rows of `source` that `target` does not hold on any of the days that occur in `source`.

    For frames without a key index: a key that the target holds on another day counts as
    fresh here; `incremental_load` finds it. Late rows and rows without a day or time
    count like others. Of several rows with one key the first in column order is taken;
    rows without a key are told apart by all their columns. Three single values reach the
    driver: first and last day and whether there are rows without one. As literals they
    prune the target, so only its overlapping days are read.
    """
    named = source.withColumn("_identity", identity(source, key))
    first, last, none = source.agg(
        F.min(day), F.max(day), F.coalesce(F.max(F.col(day).isNull()), F.lit(False))
    ).first()
    in_reach = F.col(day).between(F.lit(first), F.lit(last))
    if none:
        in_reach = in_reach | F.col(day).isNull()
    near = target.filter(in_reach)
    loaded = near.select(identity(near, key).alias("_identity"))
    return routing.dedup(named, ["_identity"]).join(loaded, "_identity", "left_anti").select(*source.columns)


def incremental_load(
    source: DataFrame,
    path: str,
    key: str = "transaction_id",
    day: str = "transaction_date",
    partition_by: Sequence[str] = ("transaction_date",),
    on_conflict: str = KEEP,
    **options: object,
) -> Loaded:
    """Load a delivery into the table at `path`, one row per key whatever its day; see `KeyedTable`."""
    table = KeyedTable(source.sparkSession, path, key, day, tuple(partition_by), **options)
    return table.load(source, on_conflict)
