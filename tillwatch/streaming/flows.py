"""Streams over table folders: alert rules, deduplication and a file-driven load.

`high_value`, `burst` and `daily_spend` of the batch rules run on streams
unchanged; what a stream adds is the watermark, which bounds state and lateness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.audit import with_constants
from tillwatch.operators import fraud
from tillwatch.settings import DAILY_SPEND, DEBIT, DEFAULT_RULES


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; `max_files` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_event_time(df: DataFrame, delay: str, column: str = "transaction_timestamp") -> DataFrame:
    """Accept rows up to `delay` late. Watermarks need an instant, so zone-less times are cast."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def stream_high_value(
    txn: DataFrame, threshold: float = DEFAULT_RULES.high_value_over, detected_at: str | None = None
) -> DataFrame:
    """Stateless: each transaction is judged as it arrives."""
    return fraud.high_value(txn, threshold, detected_at)


def stream_burst(
    txn: DataFrame,
    delay: str = "10 minutes",
    width: str = DEFAULT_RULES.burst_width,
    max_count: int = DEFAULT_RULES.burst_over,
    detected_at: str | None = None,
) -> DataFrame:
    """Bursts of a window, emitted once when the watermark closes it."""
    return fraud.burst(with_event_time(txn, delay), width, max_count, detected_at)


def stream_daily_spend(
    txn: DataFrame,
    delay: str = "1 hour",
    threshold: float = DEFAULT_RULES.daily_spend_over,
    txn_type: str = DEBIT,
    detected_at: str | None = None,
) -> DataFrame:
    """Daily spend, emitted once when the watermark has passed the day.

    The day is a window here, because state is only dropped for windows. Windows
    start at midnight UTC, so times are moved by the session's zone and back.
    """
    zone = F.current_timezone()
    local = F.from_utc_timestamp(F.col("transaction_timestamp").cast("timestamp"), zone)
    debits = txn.filter(F.col("transaction_type") == txn_type).withColumn("transaction_timestamp", local)
    spent = (
        with_event_time(debits, delay)
        .groupBy("account_number", F.window("transaction_timestamp", "1 day").alias("day"))
        .agg(F.sum("amount").alias("daily_spend"), F.count("transaction_id").alias("txn_count"))
        .filter(F.col("daily_spend") > threshold)
        .select(
            "account_number",
            F.to_utc_timestamp("day.start", zone).cast("date").alias("transaction_date"),
            "daily_spend",
            "txn_count",
        )
    )
    return with_constants(spent, fraud_type=DAILY_SPEND, fraud_detected_at=detected_at)


def stream_dedup(df: DataFrame, key: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key among rows that arrive within `delay` of each other.

    State holds one entry per key, however many copies come, so a hot key costs
    look-ups but no memory; `max_files` of the source bounds those of a micro-batch.
    """
    return with_event_time(df, delay).dropDuplicatesWithinWatermark([key])


def start(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to the table at `path`, each `every` (such as `1 minute`) from now on.

    Without `every` the query takes what is available and ends. Offsets and state
    live under `checkpoint`: a restarted query goes on where the last one stopped.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)


def run_to_end(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available and wait for it; running again takes only new files."""
    start(df, path, checkpoint, fmt=fmt).awaitTermination()
