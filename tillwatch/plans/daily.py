"""The daily run: raw files to bronze, silver, gold and warehouse, with an audit log.

Steps hand over through stored tables, so a run can be repeated from any step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.audit import run_stamp
from tillwatch.operators import fraud, quality, routing, summaries
from tillwatch.plans import layers
from tillwatch.settings import BURST, DAILY_SPEND, DEFAULT_RULES, DORMANT, HIGH_VALUE, RuleParams
from tillwatch.sources.tables import DEFAULT_FORMAT, layer_path, read_table, stored_schema, write_table
from tillwatch.sources.warehouse import Warehouse, load_warehouse

AUDIT_TYPES = {
    "step": "string",
    "rows_in": "long",
    "rows_out": "long",
    "rows_rejected": "long",
    "run_timestamp": "string",
}
CHECK_TYPES = {
    "table_name": "string",
    "source_rows": "long",
    "target_rows": "long",
    "matches": "boolean",
    "run_timestamp": "string",
}
# Totals by account and day, and by account and month: derived from silver, shared by the gold steps.
DAYS, MONTHS = "account_days", "account_months"

# --- fixed values: gold folders and the warehouse tables filled from them ---
ALERT_FOLDERS = {
    HIGH_VALUE: "fraud_alerts/high_value",
    BURST: "fraud_alerts/burst",
    DAILY_SPEND: "fraud_alerts/high_daily_spend",
    DORMANT: "fraud_alerts/dormant",
}
WAREHOUSE_TABLES = {
    "CUSTOMER_KPI": "customer_summary/overall_kpi",
    "CUSTOMER_MONTHLY": "customer_summary/monthly",
    "BRANCH_SUMMARY": "branch_summary/by_branch",
    "REGION_SUMMARY": "branch_summary/by_region",
    "FRAUD_HIGH_VALUE": "fraud_alerts/high_value",
    "FRAUD_BURST": "fraud_alerts/burst",
    "FRAUD_HIGH_SPEND": "fraud_alerts/high_daily_spend",
    "FRAUD_DORMANT": "fraud_alerts/dormant",
}
# --- end of fixed values ---


@dataclass(frozen=True)
class DailyRun:
    """One run over the folders below `root`; `stamp` marks every row it writes."""

    spark: SparkSession
    root: str
    stamp: str
    rules: RuleParams = DEFAULT_RULES
    strict: bool = False
    skip_empty: bool = False
    partition_by: tuple[str, ...] = ("transaction_date",)
    fmt: str = DEFAULT_FORMAT
    # Tables this run has opened, and their row counts, until it writes them again.
    _open: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _rows: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def now(cls, spark: SparkSession, root: str, **options: object) -> DailyRun:
        return cls(spark, root, run_stamp(), **options)

    def path(self, layer: str, entity: str) -> str:
        return layer_path(self.root, layer, entity)

    def table(self, layer: str, entity: str) -> DataFrame:
        """A stored table; its files are listed once."""
        path = self.path(layer, entity)
        if path not in self._open:
            self._open[path] = read_table(self.spark, path, self.fmt)
        return self._open[path]

    def rows(self, layer: str, entity: str) -> int:
        """Rows of a stored table; Parquet answers this from its footers."""
        path = self.path(layer, entity)
        if path not in self._rows:
            self._rows[path] = self.table(layer, entity).count()
        return self._rows[path]

    def write(self, df: DataFrame, layer: str, entity: str, **options: object) -> bool:
        path = self.path(layer, entity)
        written = write_table(df, path, self.fmt, **options)
        if written:
            self._open.pop(path, None)
            self._rows.pop(path, None)
        return written

    def note(self, step: str, rows_in: int, rows_out: int, rejected: int = 0) -> None:
        """Append one row to the audit table."""
        values = {
            "step": step,
            "rows_in": rows_in,
            "rows_out": rows_out,
            "rows_rejected": rejected,
            "run_timestamp": self.stamp,
        }
        self._append("runs", values, AUDIT_TYPES)

    def _append(self, entity: str, values: dict[str, object], types: dict[str, str]) -> None:
        row = [F.lit(values[name]).cast(kind).alias(name) for name, kind in types.items()]
        self.write(self.spark.range(1, numPartitions=1).select(*row), "audit", entity, mode="append")

    def note_quality(self, entity: str, report: DataFrame) -> None:
        """Append a quality report, one row per metric, to its table."""
        stamped = report.select(
            F.lit(entity).alias("entity"), "metric", "value", F.lit(self.stamp).alias("run_timestamp")
        )
        self.write(stamped.coalesce(1), "audit", "quality", mode="append")

    def load_bronze(self, entity: str) -> None:
        df = layers.bronze(self.spark, self.path("raw", entity), entity, self.stamp)
        self.write(df, "bronze", entity)
        loaded = self.rows("bronze", entity)
        self.note(f"bronze_{entity}", loaded, loaded)

    def _finish_silver(
        self, entity: str, clean: DataFrame, rejected: DataFrame, partition_by: tuple[str, ...] = ()
    ) -> None:
        self.write(clean, "silver", entity, partition_by=partition_by)
        written = self.write(rejected, "rejected", entity, skip_empty=self.skip_empty, compact=True)
        self.note(
            f"silver_{entity}",
            self.rows("bronze", entity),
            self.rows("silver", entity),
            self.rows("rejected", entity) if written else 0,
        )

    def build_silver_customer(self) -> None:
        source = self.table("bronze", "customer")
        self.note_quality("customer", quality.customer_quality(source))
        _, rejected = routing.split_customers(source, self.stamp)
        self._finish_silver("customer", layers.silver_customer(source, self.stamp), rejected)

    def build_silver_branch(self) -> None:
        source = self.table("bronze", "branch")
        self.note_quality("branch", quality.branch_quality(source))
        _, rejected = routing.split_branches(source, self.stamp)
        self._finish_silver("branch", layers.silver_branch(source, self.stamp), rejected)

    def build_silver_transactions(self) -> None:
        source = self.table("bronze", "transactions")
        self.note_quality("transactions", quality.transaction_quality(source))
        _, rejected = routing.split_transactions(source, self.strict, self.stamp)
        clean = layers.silver_transactions(source, self.strict, self.stamp)
        self._finish_silver("transactions", clean, rejected, partition_by=self.partition_by)
        # Stored with the table they are derived from, so that they are never older than it.
        self.write(summaries.day_totals(self.table("silver", "transactions")), "totals", DAYS)

    def days(self) -> DataFrame:
        """Totals by account and day; made here for tables of a version that did not store them."""
        if stored_schema(self.spark, self.path("totals", DAYS), self.fmt) is None:
            self.write(summaries.day_totals(self.table("silver", "transactions")), "totals", DAYS)
        return self.table("totals", DAYS)

    def detect_fraud(self) -> None:
        """Two rules read the transactions, two the stored days; a summary counts this run's alerts."""
        txn = self.table("silver", "transactions")
        rows_in = self.rows("silver", "transactions")
        found = {}
        for name, alerts in fraud.rules_with_days(txn, self.days(), self.rules, self.stamp).items():
            folder = ALERT_FOLDERS[name]
            written = self.write(
                alerts,
                "gold",
                folder,
                merge_schema=True,
                skip_empty=self.skip_empty,
                # The only rule that is a mere filter; the others end in a shuffle anyway.
                compact=name == HIGH_VALUE,
            )
            found[name] = self.rows("gold", folder) if written else 0
            self.note(folder.replace("/", "_"), rows_in, found[name])
        rows = F.explode(F.array(*[F.struct(F.lit(k).alias("fraud_type"), F.lit(n).cast("long").alias("alerts")) for k, n in found.items()]))
        counts = self.spark.range(1, numPartitions=1).select(rows.alias("row")).select("row.*")
        summary = fraud.with_total(counts).withColumn("run_timestamp", F.lit(self.stamp))
        self.write(summary, "gold", "fraud_alerts/summary")

    def build_summaries(self) -> None:
        """Month totals, folded from the stored days and written once, feed all four tables."""
        cust = self.table("silver", "customer")
        branch = self.table("silver", "branch")
        self.write(summaries.months_from_days(self.days()), "totals", MONTHS)
        months = self.table("totals", MONTHS)
        totals = summaries.account_totals_from_months(months)
        tables = {
            "customer_summary/monthly": summaries.monthly_from_totals(months, cust, load_ts=self.stamp),
            "customer_summary/overall_kpi": summaries.kpi_from_totals(totals, cust, self.stamp),
            "branch_summary/by_branch": summaries.branch_from_totals(totals, cust, branch, self.stamp),
            "branch_summary/by_region": summaries.region_from_totals(totals, cust, branch, self.stamp),
        }
        rows_in = self.rows("silver", "transactions")
        for folder, df in tables.items():
            self.write(df, "gold", folder, merge_schema=True)
            self.note(folder.replace("/", "_"), rows_in, self.rows("gold", folder))

    def load_warehouse(self, target: Warehouse) -> dict[str, int]:
        """Fill the warehouse tables; rows written by table name."""
        loaded = {}
        for table, folder in WAREHOUSE_TABLES.items():
            loaded[table] = load_warehouse(self.table("gold", folder), target, table)
            self.note(f"warehouse_{table.lower()}", self.rows("gold", folder), loaded[table])
        return loaded

    def verify_warehouse(self, target: Warehouse) -> None:
        """Count the warehouse tables anew and store both sides; an error if any differs from gold."""
        differ = []
        for table, folder in WAREHOUSE_TABLES.items():
            source, stored = self.rows("gold", folder), target.rows(self.spark, table)
            values = {
                "table_name": table,
                "source_rows": source,
                "target_rows": stored,
                "matches": source == stored,
                "run_timestamp": self.stamp,
            }
            self._append("verification", values, CHECK_TYPES)
            if source != stored:
                differ.append(f"{table} ({source} in gold, {stored} in the warehouse)")
        if differ:
            raise RuntimeError("warehouse rows differ: " + ", ".join(differ))

    def run(self, target: Warehouse) -> dict[str, int]:
        """All steps in order."""
        for entity in ("customer", "branch", "transactions"):
            self.load_bronze(entity)
        self.build_silver_customer()
        self.build_silver_branch()
        self.build_silver_transactions()
        self.detect_fraud()
        self.build_summaries()
        loaded = self.load_warehouse(target)
        self.verify_warehouse(target)
        return loaded
