"""A scratch folder for local sessions that name none; on a cluster it has to be set."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def with_shared_folder(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, in a session that has a checkpoint folder: its own, or one made here for a local test."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_shared_folder(spark)
        return query(spark, sf_dir)

    return run


def ensure_shared_folder(spark: SparkSession) -> None:
    context = spark.sparkContext
    # Elsewhere one machine's folder would not be shared: queries that need one then say so.
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    if local and spark.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
