"""The daily run over deliveries: only what a delivery touches is computed anew.

Silver transactions are a table with one row per key. A delivery changes the rows of
some days; totals of these days, and of their months, replace those stored before, as
do the alerts that lie on them. Sums could be corrected in place, but a smallest or
largest amount cannot be taken back, so touched days are folded again, from their own
folders alone. Account, branch and region tables follow from the stored months.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.audit import with_constants
from tillwatch.operators import fraud, quality, routing, summaries
from tillwatch.plans import layers
from tillwatch.plans.daily import ALERT_FOLDERS, DailyRun
from tillwatch.settings import BURST, DAILY_SPEND, DORMANT, HIGH_VALUE
from tillwatch.sources import files
from tillwatch.sources.keyed import REPLACE, KeyedTable, Loaded, replace_days
from tillwatch.sources.tables import read_table, write_table
from tillwatch.sources.warehouse import Warehouse

DAY = "transaction_date"
# Totals by day and month, in folders of their own, and what is known of an account in a month.
DAYS, MONTHS = "days_by_date", "months_by_month"
STAMPS = ("bronze_load_timestamp", "silver_load_timestamp", "source_file")


@dataclass(frozen=True)
class IncrementalRun(DailyRun):
    """Runs over deliveries into the folders below `root`; results equal one run over all of them.

    A key that is delivered again replaces its stored row, whatever day either is on.
    Customers and branches are small and taken whole: a delivery that holds them
    replaces them. Gold alert tables lie in one folder per day of the alert.
    """

    def silver(self) -> KeyedTable:
        return KeyedTable(self.spark, self.path("silver", "transactions"), day=DAY, partition_by=(DAY,), unlike=STAMPS, fmt=self.fmt)

    def deliver(self, delivery: str, folder: str, target: Warehouse | None = None) -> Loaded:
        """Bring in the raw files below `folder`; `delivery` names them, and the same name may come again.

        `folder` holds transactions/, and may hold customer/ and branch/. Repeating a
        delivery that broke off completes it.
        """
        for entity, build in (("customer", self.build_silver_customer), ("branch", self.build_silver_branch)):
            if files.exists(self.spark, f"{folder.rstrip('/')}/{entity}"):
                df = layers.bronze(self.spark, f"{folder.rstrip('/')}/{entity}", entity, self.stamp)
                self.write(df, "bronze", entity)
                build()
        loaded = self._load_transactions(delivery, folder)
        self.refresh()
        self.build_gold()
        if target is not None:
            self.load_warehouse(target)
            self.verify_warehouse(target)
        return loaded

    def _load_transactions(self, delivery: str, folder: str) -> Loaded:
        """Bronze and rejected rows of a delivery have a folder of their own; clean ones are loaded by key."""
        bronze, refused = (f"{self.path(layer, 'deliveries')}/delivery={delivery}" for layer in ("bronze", "rejected"))
        raw = layers.bronze(self.spark, f"{folder.rstrip('/')}/transactions", "transactions", self.stamp)
        write_table(raw, bronze, self.fmt)
        source = read_table(self.spark, bronze, self.fmt)
        self.note_quality("transactions", quality.transaction_quality(source))
        _, rejected = routing.split_transactions(source, self.strict, self.stamp)
        write_table(rejected, refused, self.fmt, compact=True)
        loaded = self.silver().load(layers.silver_transactions(source, self.strict, self.stamp), REPLACE)
        self._forget(self.path("silver", "transactions"))
        rows_rejected = read_table(self.spark, refused, self.fmt).count()
        self.note(f"delivery_{delivery}", source.count(), loaded.new + loaded.changed, rows_rejected)
        return loaded

    def _forget(self, path: str) -> None:
        self._open.pop(path, None)
        self._rows.pop(path, None)

    # ---- totals and alerts of the touched days -------------------------------------------

    def refresh(self) -> list[date | None]:
        """Bring totals and alerts up to the loads since the last refresh; the days that were folded again.

        The number of the last load that is accounted for lies with the silver table. If
        there is none, as after a full run has replaced that table, all days are folded.
        """
        done = f"{self.path('silver', 'transactions')}/_totals"
        marks = [int(n) for n in files.names(self.spark, done)]
        number, days = self.silver().changed_since(max(marks, default=0))
        txn = self.table("silver", "transactions")
        if not marks:
            days = [r[0] for r in txn.select(DAY).distinct().collect()]  # as many as the calendar has at most
        if days or not marks:
            self._refold(txn, days)
        files.mark(self.spark, f"{done}/{number}")
        for old in marks:
            if old < number:
                files.delete(self.spark, f"{done}/{old}")
        return days

    def _refold(self, txn: DataFrame, days: Sequence[date | None]) -> None:
        """Fold these days, and their months, again and replace the alerts that lie on them."""
        rows = txn.filter(_on(days))
        self._replace(summaries.day_totals(rows), "totals", DAYS, DAY, days)
        months = sorted({d.year * 100 + d.month if d else 0 for d in days})
        stored = self.table("totals", DAYS).withColumn("month", _month(F.col(DAY))).filter(_in_months(days))
        self._replace(_month_rows(stored), "totals", MONTHS, "month", months)

        high = fraud.high_value(rows, self.rules.high_value_over, self.stamp)
        self._replace(high, "gold", ALERT_FOLDERS[HIGH_VALUE], DAY, days)
        spend = fraud.daily_spend_from_days(self.table("totals", DAYS).filter(_on(days)), self.rules.daily_spend_over, detected_at=self.stamp)
        self._replace(spend, "gold", ALERT_FOLDERS[DAILY_SPEND], DAY, days)
        # A window may reach over midnight: those that begin on the day before may have changed too.
        begins = sorted({d + timedelta(days=k) for d in days if d for k in (-1, 0)})
        around = sorted({d + timedelta(days=k) for d in begins for k in (-1, 0, 1)})
        bursts = fraud.burst(txn.filter(_on(around)), self.rules.burst_width, self.rules.burst_over, self.stamp)
        begun = bursts.withColumn("window_date", F.col("window_start").cast("date"))
        self._replace(begun.filter(_on(begins, "window_date")), "gold", ALERT_FOLDERS[BURST], "window_date", begins)

    def _replace(self, df: DataFrame, layer: str, entity: str, column: str, values: Sequence[object]) -> None:
        """Replace the folders of `values`; a table that has no such folders is made anew."""
        path = self.path(layer, entity)
        aside = f"{self.path('totals', '_staged')}/{entity.replace('/', '-')}"
        write_table(df, aside, self.fmt)
        staged = read_table(self.spark, aside, self.fmt)
        if not self._in_folders(path, column):
            files.delete(self.spark, path)
        replace_days(staged, path, column, values, self.fmt)
        if not self._in_folders(path, column):
            write_table(staged, path, self.fmt)  # without rows: the columns alone
        files.delete(self.spark, aside)
        self._forget(path)

    def _in_folders(self, path: str, column: str) -> bool:
        return any(name.startswith(f"{column}=") for name in files.names(self.spark, path))

    # ---- tables that follow from the totals ------------------------------------------------

    def build_gold(self) -> None:
        """Account, branch and region tables and dormant accounts, from the stored months; counts of all alerts."""
        cust, branch = self.table("silver", "customer"), self.table("silver", "branch")
        months = self.table("totals", MONTHS)
        totals = summaries.account_totals_from_months(months)
        gold = {
            "customer_summary/monthly": summaries.monthly_from_totals(months, cust, load_ts=self.stamp),
            "customer_summary/overall_kpi": summaries.kpi_from_totals(totals, cust, self.stamp),
            "branch_summary/by_branch": summaries.branch_from_totals(totals, cust, branch, self.stamp),
            "branch_summary/by_region": summaries.region_from_totals(totals, cust, branch, self.stamp),
            ALERT_FOLDERS[DORMANT]: fraud.dormant_from_activity(
                activity_from_months(months), self.rules.dormant_max_txns, self.rules.dormant_active_since, self.rules.dormant_gap_over, self.stamp
            ),
        }
        for folder, df in gold.items():
            self.write(df, "gold", folder)
        found = [(name, self.rows("gold", folder)) for name, folder in ALERT_FOLDERS.items()]
        counts = self.spark.createDataFrame(found, "fraud_type string, alerts long")
        self.write(with_constants(fraud.with_total(counts), run_timestamp=self.stamp), "gold", "fraud_alerts/summary")


def _on(days: Sequence[date | None], column: str = DAY) -> Column:
    on = F.col(column).isin([d for d in days if d is not None])
    return on | F.col(column).isNull() if None in days else on


def _month(day: Column) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def _in_months(days: Sequence[date | None]) -> Column:
    """Days of the months that `days` lie in, as ranges that prune folders."""
    firsts = sorted({d.replace(day=1) for d in days if d is not None})
    inside = F.lit(False)
    for first in firsts:
        after = (first + timedelta(days=32)).replace(day=1)
        inside = inside | ((F.col(DAY) >= F.lit(first)) & (F.col(DAY) < F.lit(after)))
    return inside | F.col(DAY).isNull() if None in days else inside


def _month_rows(days: DataFrame) -> DataFrame:
    """`summaries.months_from_days` with the month's folder and the first and last day of each account in it."""
    return days.groupBy(
        "month", "account_number", F.year(DAY).alias("txn_year"), F.month(DAY).alias("txn_month"), "transaction_type"
    ).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amount_sum").alias("amount_sum"),
        F.sum("amount_count").alias("amount_count"),
        F.max("amount_max").alias("amount_max"),
        F.min("amount_min").alias("amount_min"),
        F.min(DAY).alias("first_day"),
        F.max(DAY).alias("last_day"),
    )


def activity_from_months(months: DataFrame) -> DataFrame:
    return months.groupBy("account_number").agg(
        F.min("first_day").alias("first_txn_date"),
        F.max("last_day").alias("last_txn_date"),
        F.sum("txn_count").alias("total_txns"),
    )

