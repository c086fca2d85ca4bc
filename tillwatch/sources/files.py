"""Folders and marker files on any file system that Spark reaches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no such folder."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file; whether it exists is one atomic fact."""
    files, place = _at(spark, path)
    files.create(place, True).close()


def partition_folder(column: str, value: object) -> str:
    """Name of a day's folder, as Spark's writer spells it."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def delete_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> None:
    for value in values:
        delete(spark, f"{path.rstrip('/')}/{partition_folder(column, value)}")
