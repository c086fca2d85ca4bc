"""Loading gold tables into the reporting warehouse, and reading them back.

Executors write straight to the target; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.projection import conform, export_normalize, upper_names
from tillwatch.schemas import CONTRACTS
from tillwatch.sources.tables import layer_path, read_table, write_table


@dataclass(frozen=True)
class FolderWarehouse:
    """One Parquet folder per warehouse table."""

    root: str

    def replace(self, df: DataFrame, table: str) -> None:
        write_table(df, layer_path(self.root, "warehouse", table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, layer_path(self.root, "warehouse", table))

    def rows(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).count()


@dataclass(frozen=True)
class JdbcWarehouse:
    """A database reached over JDBC; its driver jar has to be on Spark's class path.

    The table is truncated, not dropped, so grants and types stay. `connections`
    bounds the parallel sessions on the database. `slices` gives conditions per
    table that together cover it without overlap, such as one per month; each is
    read by a task of its own. Reading a table without slices is an error, unless
    `single_task` allows to draw it through one task.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_size: int = 10_000
    slices: Mapping[str, Sequence[str]] = field(default_factory=dict)
    single_task: bool = False

    def replace(self, df: DataFrame, table: str) -> None:
        (
            df.write.option("truncate", True)
            .option("numPartitions", self.connections)
            .option("batchsize", self.batch_size)
            .jdbc(self.url, table, mode="overwrite", properties=dict(self.properties))
        )

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        conditions = list(self.slices.get(table, ())) or None
        if conditions is None and not self.single_task:
            raise ValueError(f"{table} has no slices: give some, or allow single_task")
        return spark.read.jdbc(self.url, table, predicates=conditions, properties=dict(self.properties))

    def rows(self, spark: SparkSession, table: str) -> int:
        """Counted by the database itself."""
        counted = f"(select count(*) as n from {table}) counted"
        return int(spark.read.jdbc(self.url, counted, properties=dict(self.properties)).first()[0])


Warehouse = FolderWarehouse | JdbcWarehouse


def warehouse_rows(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """A gold table in the form the warehouse stores it."""
    return upper_names(conform(export_normalize(df), contract))


def load_warehouse(df: DataFrame, target: Warehouse, table: str) -> int:
    """Replace the contents of a warehouse table; returns the number of rows written.

    The rows are counted in the writing tasks themselves.
    """
    written = Observation()
    rows = warehouse_rows(df, CONTRACTS[table]).observe(written, F.count(F.lit(1)).alias("rows"))
    target.replace(rows, table)
    return written.get["rows"]


def load_all(tables: Mapping[str, DataFrame], target: Warehouse) -> dict[str, int]:
    """Load several tables; rows written by table name."""
    return {name: load_warehouse(df, target, name) for name, df in tables.items()}
