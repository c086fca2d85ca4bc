"""Totals of a stream that are right at any moment: open windows included, late rows kept.

A streaming aggregate of the engine emits a window when the watermark has closed it, and
drops rows that come later without a trace. Here each micro-batch is folded and stored as
a part of its own under its number, so repeating it replaces it; readers add the parts
up, closed and open windows alike. Rows behind the watermark go to a table of late rows.
No state is held between batches but these tables, and a busy account is one row a window
of a batch. Parts are folded together from time to time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillwatch.functions.audit import with_constants
from tillwatch.operators import fraud
from tillwatch.settings import BURST, DAILY_SPEND, DEFAULT_RULES
from tillwatch.sources import files

DAY = "day"
ON_TIME, LATE, UNTIMED = "on time", "late", "untimed"


@dataclass(frozen=True)
class WindowTable:
    """Transactions of an account per window, below `path`.

    `width` is a length such as `10 minutes`, `day` for calendar days of the session's
    zone, or None for single moments. A row is late if its window ended `delay` or more
    before the latest time of the batches before its own; without `delay` none is. A
    moment ends with itself.

    `emit` finds the alerts of a batch as it is taken: it gets the totals of the batch's
    accounts, the batch among them, and the batch's own windows, and its rows are kept
    under the batch's number. `back` bounds those totals in time to that much before the
    batch's first window.
    """

    spark: SparkSession
    path: str
    width: str | None = DEFAULT_RULES.burst_width
    delay: str | None = "10 minutes"
    time: str = "transaction_timestamp"
    compact_after: int = 64
    emit: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    back: str | None = None

    # ---- taking batches ----------------------------------------------------------------

    def start(self, stream: DataFrame, every: str | None = None) -> StreamingQuery:
        """Take a stream of transactions, each `every` from now on, or what is available and then end."""
        trigger = {"processingTime": every} if every else {"availableNow": True}
        writer = stream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.path}/checkpoint")
        return writer.trigger(**trigger).start()

    def run_to_end(self, stream: DataFrame) -> None:
        self.start(stream).awaitTermination()

    def take(self, batch: DataFrame, number: int) -> None:
        """Fold one micro-batch. A batch that broke off is taken again and replaces what it had written."""
        if files.exists(self.spark, f"{self.path}/progress/batch={number}/_SUCCESS"):
            return
        moment = F.col(self.time).cast("timestamp")
        limit = self.watermark()
        late = F.lit(False) if limit is None else F.col("_slot.end") <= F.lit(limit)
        kind = F.when(moment.isNull(), F.lit(UNTIMED)).when(late, F.lit(LATE)).otherwise(F.lit(ON_TIME))
        rows = batch.withColumn("_slot", self._slot(moment)).withColumn("_kind", kind).persist()
        try:
            fold = rows.filter(F.col("_kind") == ON_TIME).groupBy("account_number", F.col("_slot.start").alias("start"), F.col("_slot.end").alias("end"))
            parts = fold.agg(F.count("transaction_id").alias("txn_count"), F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("rows"))
            self._write(parts, f"parts/batch={number}")
            if self.emit is not None:
                own = self.spark.read.parquet(f"{self.path}/parts/batch={number}")
                self._write(self.emit(self._around(own, number), own), f"alerts/batch={number}")
            self._write(rows.filter(F.col("_kind") != ON_TIME).drop("_slot").withColumnRenamed("_kind", "kind"), f"late/batch={number}")
            seen = [F.count_if(F.col("_kind") == k).alias(name) for k, name in ((ON_TIME, "on_time"), (LATE, "late"), (UNTIMED, "untimed"))]
            progress = rows.agg(F.count(F.lit(1)).alias("rows"), *seen, F.max(moment).alias("latest"))
            self._write(progress, f"progress/batch={number}")  # last: only now the batch counts
        finally:
            rows.unpersist()
        self.compact()

    def _around(self, own: DataFrame, number: int) -> DataFrame:
        """Totals of the accounts of a batch, with the batch itself and not too far back."""
        totals = _added(self._parts(number))
        if self.back is not None:
            first = own.agg(F.min("start").alias("first")).first().first
            totals = totals.filter(F.col("start") >= F.lit(first).cast("timestamp") - F.expr(f"interval {self.back}"))
        return totals.join(own.select("account_number").distinct(), "account_number", "left_semi")

    def _slot(self, moment: Column) -> Column:
        if self.width is None:
            start, end = moment, moment
        elif self.width == DAY:
            start = F.date_trunc("day", moment)
            end = F.date_add(moment.cast("date"), 1).cast("timestamp")
        else:
            # As `window` cuts time, but without dropping rows that have none.
            micros = F.unix_micros(moment)
            start = F.timestamp_micros(micros - F.pmod(micros, F.lit(micros_of(self.width))))
            end = start + F.expr(f"interval {self.width}")
        return F.struct(start.alias("start"), end.alias("end"))

    def _write(self, df: DataFrame, entity: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{entity}")

    # ---- reading -----------------------------------------------------------------------

    def _batches(self) -> list[int]:
        done = [n.removeprefix("batch=") for n in files.names(self.spark, f"{self.path}/progress")]
        return sorted(int(n) for n in done if files.exists(self.spark, f"{self.path}/progress/batch={n}/_SUCCESS"))

    def _read(self, entity: str, batches: list[int]) -> DataFrame | None:
        paths = [f"{self.path}/{entity}/batch={n}" for n in batches]
        return self.spark.read.option("basePath", f"{self.path}/{entity}").parquet(*paths) if paths else None

    def progress(self) -> DataFrame | None:
        """One row per batch: rows, and how many were on time, late or without a time; its latest time."""
        return self._read("progress", self._batches())

    def watermark(self):
        """The moment up to which windows are closed; None before the first batch or without `delay`."""
        progress = self.progress() if self.delay else None
        if progress is None:
            return None
        return progress.agg((F.max("latest") - F.expr(f"interval {self.delay}")).alias("limit")).first().limit

    def _folds(self) -> tuple[int, int]:
        """Number of the last fold of parts, and the last batch in it."""
        found = [tuple(map(int, n.split("-"))) for n in files.names(self.spark, f"{self.path}/folds")]
        return max(found, default=(0, -1))

    def _parts(self, taking: int | None = None) -> DataFrame:
        """Parts of all batches, among them the one that is being taken, and their folds."""
        number, upto = self._folds()
        parts = self._read("parts", [n for n in self._batches() if n > upto] + ([] if taking is None else [taking]))
        if number:
            folded = self.spark.read.parquet(f"{self.path}/folded/fold={number}")
            parts = folded if parts is None else parts.drop("batch").unionByName(folded)
        if parts is None:
            raise ValueError("no batch has been taken yet")
        return parts

    def totals(self) -> DataFrame:
        """account_number, start, end, txn_count, total_amount, rows and whether the window is still open."""
        limit = self.watermark()
        still = F.lit(True) if limit is None else F.col("end") > F.lit(limit)
        return _added(self._parts()).withColumn("open", still)

    def alerts(self) -> DataFrame | None:
        """What `emit` found, with the `batch` it found it in."""
        return self._read("alerts", self._batches())

    def late(self) -> DataFrame | None:
        """Rows that no window holds, as they came, with `kind` (late or untimed) and `batch`."""
        return self._read("late", self._batches())

    def compact(self) -> None:
        """Fold the parts of many batches into one; the marker makes the fold count, then the parts go."""
        number, upto = self._folds()
        parts = [n for n in self._batches() if n > upto]
        if len(parts) < self.compact_after:
            return
        new = self._read("parts", parts).drop("batch")
        if number:
            new = new.unionByName(self.spark.read.parquet(f"{self.path}/folded/fold={number}"))
        self._write(_added(new), f"folded/fold={number + 1}")
        files.mark(self.spark, f"{self.path}/folds/{number + 1}-{parts[-1]}")
        for n in parts:
            files.delete(self.spark, f"{self.path}/parts/batch={n}")
        files.delete(self.spark, f"{self.path}/folded/fold={number}")


def micros_of(width: str) -> int:
    """Length such as `10 minutes` in microseconds."""
    number, unit = width.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
    return int(number) * seconds[unit.rstrip("s")] * 1_000_000


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("account_number", "start", "end").agg(*[F.sum(c).alias(c) for c in ("txn_count", "total_amount", "rows")])


# ---- the rules over such tables --------------------------------------------------------------


def bursts(windows: WindowTable, max_count: int = DEFAULT_RULES.burst_over, detected_at: str | None = None) -> DataFrame:
    """`fraud.burst` over all rows taken so far but the late ones."""
    found = windows.totals().filter(F.col("txn_count") > max_count).select(
        "account_number", "txn_count", "total_amount", F.col("start").alias("window_start"), F.col("end").alias("window_end")
    )
    return with_constants(found, fraud_type=BURST, fraud_detected_at=detected_at)


def daily_spend(days: WindowTable, threshold: float = DEFAULT_RULES.daily_spend_over, detected_at: str | None = None) -> DataFrame:
    """`fraud.daily_spend` over a table of days that has taken the debits."""
    found = days.totals().filter(F.col("total_amount") > threshold).select(
        "account_number", F.col("start").cast("date").alias("transaction_date"), F.col("total_amount").alias("daily_spend"), "txn_count"
    )
    return with_constants(found, fraud_type=DAILY_SPEND, fraud_detected_at=detected_at)


def reactivated(days: WindowTable, min_gap_days: int = DEFAULT_RULES.dormant_gap_over, detected_at: str | None = None) -> DataFrame:
    """`fraud.reactivated` over a table of days; rows may have come in any order."""
    return fraud.reactivated_from_days(_as_days(days.totals()), min_gap_days, detected_at)


def sliding_bursts(
    moments: WindowTable, minutes: int = 10, max_count: int = DEFAULT_RULES.burst_over, detected_at: str | None = None
) -> DataFrame:
    """`fraud.sliding_burst` over a table of moments."""
    return fraud.sliding_burst_from_moments(_as_moments(moments.totals()), minutes, max_count, detected_at)


def _as_days(totals: DataFrame) -> DataFrame:
    return totals.select(
        "account_number", F.col("start").cast("date").alias("transaction_date"), "txn_count", F.col("total_amount").alias("amount")
    )


def _as_moments(totals: DataFrame) -> DataFrame:
    return totals.select(
        "account_number", F.col("start").alias("transaction_timestamp"), F.col("txn_count").alias("n"), F.col("total_amount").alias("amount")
    )


def reactivated_now(min_gap_days: int = DEFAULT_RULES.dormant_gap_over, detected_at: str | None = None) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For `emit` of a table of days: accounts that a batch wakes, on the batch's own days.

    Alerts of all batches are those of the rule as long as days come in order. A day that
    comes late can end a gap that was reported; `reactivated` reads the table as it then is.
    """

    def emit(totals: DataFrame, own: DataFrame) -> DataFrame:
        found = fraud.reactivated_from_days(_as_days(totals), min_gap_days, detected_at)
        return found.join(_as_days(own).select("account_number", "transaction_date"), ["account_number", "transaction_date"], "left_semi")

    return emit


def sliding_bursts_now(
    minutes: int = 10, max_count: int = DEFAULT_RULES.burst_over, detected_at: str | None = None
) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For `emit` of a table of moments with `back` of as many minutes: bursts that end in a batch's own moments."""

    def emit(totals: DataFrame, own: DataFrame) -> DataFrame:
        found = fraud.sliding_burst_from_moments(_as_moments(totals), minutes, max_count, detected_at)
        return found.join(own.select("account_number", F.col("start").alias("window_end")), ["account_number", "window_end"], "left_semi")

    return emit


class DroppedRows(StreamingQueryListener):
    """Counts what stateful operators of running streams drop behind the watermark.

    For queries that aggregate in the engine. Spark counts rows as they reach the
    operator, which for aggregates is after the map-side fold. Register with
    `spark.streams.addListener`.
    """

    def __init__(self) -> None:
        self._dropped: dict[tuple[str, int, str], int] = defaultdict(int)
        self._rows: dict[str, int] = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self._rows[name] += progress.numInputRows
        for place, operator in enumerate(progress.stateOperators):
            self._dropped[name, place, operator.operatorName] += operator.numRowsDroppedByWatermark

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """query, operator (by place), operator_name, rows_in of the query, rows_dropped of the operator."""
        rows = [(name, place, kind, self._rows[name], n) for (name, place, kind), n in sorted(self._dropped.items())]
        return spark.createDataFrame(rows, "query string, operator int, operator_name string, rows_in long, rows_dropped long")
