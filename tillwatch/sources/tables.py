"""Path-addressed tables of the layers. The storage format is a parameter, Parquet by default."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"


def layer_path(root: str, layer: str, entity: str) -> str:
    """`root/layer/entity`, for any file system Spark can reach."""
    return "/".join([root.rstrip("/"), layer, entity])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    malformed: str | None = None,
) -> DataFrame:
    """CSV files. Without a schema one is inferred, at the price of a second pass.

    With a schema every file's header has to name the same columns in the same
    order; Spark's default would relabel them by position. `malformed` names a
    further text column for the whole line where it has too many or too few
    fields (else null); it needs a schema.
    """
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if malformed is not None:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        # Fields are counted over the whole line only if no column is pruned.
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header of CSV files; reads one line."""
    return spark.read.option("header", True).csv(path).columns


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that keeps blanks around values."""
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False
) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).format(fmt).load(path)


def stored_schema(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> T.StructType | None:
    """Schema of the table at `path`, or None when there is no table yet."""
    try:
        return read_table(spark, path, fmt).schema
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` first (null where `df` lacks them), then the new ones of `df`."""
    own = {field.name: field.dataType for field in df.schema.fields}
    clashes = [f.name for f in schema.fields if f.name in own and own[f.name] != f.dataType]
    if clashes:
        raise ValueError(f"column types differ from the stored table: {', '.join(clashes)}")
    kept = [
        F.col(f"`{f.name}`") if f.name in own else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    added = [F.col(f"`{name}`") for name in own if name not in schema.names]
    return df.select(*kept, *added)


def _by_folder(df: DataFrame, partition_by: Sequence[str], tasks: int | None) -> DataFrame:
    """Bring the rows of one folder together, so that it gets few files, but split big folders."""
    if tasks is None:
        # Adaptive execution sizes the tasks by bytes and cuts an oversized folder.
        return df.hint("rebalance", *partition_by)
    # Even ranges of folder and row hash: for many small folders, where the number
    # of files and not of bytes is the work. Costs a sampling pass over the input.
    spread = F.xxhash64(*[name for name in df.columns if name not in partition_by])
    return df.repartitionByRange(tasks, *partition_by, spread)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    merge_schema: bool = False,
    skip_empty: bool = False,
    tasks: int | None = None,
    compact: bool = False,
) -> bool:
    """Replace (or append to) the table at `path`; False when an empty frame was skipped.

    `path` must not be read by `df` itself. `skip_empty` leaves the earlier
    contents in place; otherwise an empty frame replaces them with an empty table.
    `tasks` fixes how many tasks write a partitioned table. `compact` gathers what
    a filter left of many tasks into few files; it shuffles the rows that are left.
    With `skip_empty` rows are written beside the table and take its place only if
    there are any, so `df` is computed once.
    """
    if merge_schema:
        stored = stored_schema(df.sparkSession, path, fmt)
        df = df if stored is None else align_to(df, stored)
    if partition_by:
        df = _by_folder(df, partition_by, tasks)
    elif compact:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if skip_empty and mode == "overwrite":
        return _save_if_any(df, writer, path, fmt)
    if skip_empty and df.isEmpty():
        return False
    writer.save(path)
    return True


def _save_if_any(df: DataFrame, writer: DataFrameWriter, path: str, fmt: str) -> bool:
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    staged, table = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    files = table.getFileSystem(spark._jsc.hadoopConfiguration())
    writer.save(aside)
    if spark.read.schema(df.schema).format(fmt).load(aside).isEmpty():
        files.delete(staged, True)
        return False
    # The earlier table is moved aside and goes last: a run that breaks off between leaves one of the two.
    before = spark._jvm.org.apache.hadoop.fs.Path(f"{aside}.before")
    held = files.exists(table)
    if held and not files.rename(table, before):
        raise OSError(f"{path} could not be moved aside")
    if not files.rename(staged, table):
        if held:
            files.rename(before, table)
        raise OSError(f"{aside} could not be moved to {path}")
    if held:
        files.delete(before, True)
    return True


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table; for stored Parquet the counts come from file footers."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def compare_row_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of both sides by table name, and whether they agree."""
    before = row_counts(source).withColumnRenamed("row_count", "source_rows")
    after = row_counts(target).withColumnRenamed("row_count", "target_rows")
    return before.join(after, "table_name", "full").withColumn(
        "matches", F.col("source_rows").eqNullSafe(F.col("target_rows"))
    )
