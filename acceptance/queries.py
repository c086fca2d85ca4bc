"""One callable per operator: `(spark, sf_dir) -> DataFrame` over the whole test tables.

Queries that write do so into a fresh folder below the shared scratch folder and
return what a reader finds there.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.views import base_table, over, view
from tillwatch.functions.audit import with_constants
from tillwatch.functions.typed import as_timestamp, money
from tillwatch.operators import fraud, projection, quality, reports, routing, sketches, summaries
from tillwatch.plans.daily import ALERT_FOLDERS, WAREHOUSE_TABLES, DailyRun
from tillwatch.plans.increments import IncrementalRun
from tillwatch.plans import incremental, layers
from tillwatch.schemas import CONTRACTS, RAW_COLUMNS
from tillwatch.settings import ACCOUNT_TYPES, HIGH_VALUE, RuleParams
from tillwatch.sources.keyed import REPLACE
from tillwatch.sources.scratch import scratch_folder
from tillwatch.sources.tables import (
    compare_row_counts,
    layer_path,
    read_csv,
    read_table,
    row_counts,
    write_csv,
    write_table,
)
from tillwatch.sources.warehouse import FolderWarehouse, load_all, load_warehouse, warehouse_rows
from tillwatch.streaming import flows, windows

Query = Callable[[SparkSession, str], DataFrame]

STAMP = "2026-01-01 00:00:00"
AS_OF = datetime(2000, 1, 1)
# The tables' amounts and dates lie elsewhere than the rules' defaults.
RULES = RuleParams(
    high_value_over=490_000,
    burst_over=1,
    daily_spend_over=400_000,
    dormant_active_since=date(2001, 6, 1),
)
# Cut-off days of the successive loads of `incremental_load`; the last load takes everything.
LOAD_DAYS = (date(1994, 6, 30), date(1998, 3, 31))
# Rows of one file that a stream is fed.
PIECE_ROWS = 500_000

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- shared inputs -----------------------------------------------------------------------


def _monthly(spark, sf):
    return summaries.customer_monthly(view(spark, sf, "txn"), view(spark, sf, "cust_orphan"))


def _kpi(spark, sf):
    return summaries.customer_kpi(view(spark, sf, "txn"), view(spark, sf, "cust_orphan"))


def _branches(spark, sf):
    return summaries.branch_summary(*_star(spark, sf))


def _regions(spark, sf):
    return summaries.region_summary(*_star(spark, sf))


def _star(spark, sf):
    return view(spark, sf, "txn"), view(spark, sf, "cust_orphan"), view(spark, sf, "branch")


def _alerts(spark, sf):
    """The rules over daily transactions; bursts come from the intraday ones."""
    rules = fraud.all_rules(view(spark, sf, "txn"), RULES)
    bursts = fraud.all_rules(view(spark, sf, "evt"), RULES)
    return {name: bursts[name] if name == fraud.BURST else df for name, df in rules.items()}


def _gold(spark, sf):
    """All eight gold tables by warehouse name, with the stamps a run adds."""
    txn, cust, branch = _star(spark, sf)
    stamped = with_constants(
        txn, bronze_load_timestamp=STAMP, source_file="raw/transactions", silver_load_timestamp=STAMP
    )
    return {
        "CUSTOMER_KPI": summaries.customer_kpi(txn, cust, STAMP),
        "CUSTOMER_MONTHLY": summaries.customer_monthly(txn, cust, load_ts=STAMP),
        "BRANCH_SUMMARY": summaries.branch_summary(txn, cust, branch, STAMP),
        "REGION_SUMMARY": summaries.region_summary(txn, cust, branch, STAMP),
        "FRAUD_HIGH_VALUE": fraud.high_value(stamped, RULES.high_value_over, STAMP),
        "FRAUD_BURST": fraud.burst(view(spark, sf, "evt"), max_count=RULES.burst_over, detected_at=STAMP),
        "FRAUD_HIGH_SPEND": fraud.daily_spend(txn, RULES.daily_spend_over, detected_at=STAMP),
        "FRAUD_DORMANT": fraud.dormant(
            txn, active_since=RULES.dormant_active_since, detected_at=STAMP
        ),
    }


# ---- scans, sources, sinks ---------------------------------------------------------------


@query
def scan_csv(spark, sf):
    """Written as text, read back under an explicit typed schema."""
    path = scratch_folder(spark, "csv")
    txn = view(spark, sf, "txn").drop("transaction_date")
    write_csv(txn, path)
    return read_csv(spark, path, txn.schema)


@query
def scan_table(spark, sf):
    return read_table(spark, f"{sf}/orders.parquet")


@query
def sink_overwrite(spark, sf):
    path = scratch_folder(spark, "overwrite")
    write_table(view(spark, sf, "cust"), path)
    write_table(view(spark, sf, "cust_orphan"), path)
    return read_table(spark, path)


@query
def sink_partitioned(spark, sf):
    path = scratch_folder(spark, "partitioned")
    # A few rows for each of thousands of days: the work is in the files, so all cores share it.
    tasks = spark.sparkContext.defaultParallelism
    write_table(view(spark, sf, "txn"), path, partition_by=["transaction_date"], tasks=tasks)
    return read_table(spark, path)


@query
def sink_merge_schema(spark, sf):
    """The second write lacks `state` and brings `is_active`; the table keeps both columns."""
    path = scratch_folder(spark, "merge")
    cust = view(spark, sf, "cust")
    write_table(cust, path)
    changed = cust.drop("state").withColumn("is_active", F.col("status") == "ACTIVE")
    write_table(changed, path, merge_schema=True)
    return read_table(spark, path, merge_schema=True)


@query
def sink_if_nonempty(spark, sf):
    """The first write has rows; the second has none, so it is skipped."""
    path = scratch_folder(spark, "nonempty")
    txn = view(spark, sf, "txn")
    write_table(fraud.high_value(txn, RULES.high_value_over), path, skip_empty=True)
    write_table(fraud.high_value(txn, float("inf")), path, skip_empty=True)
    return read_table(spark, path)


@query
def sink_warehouse(spark, sf):
    target = FolderWarehouse(scratch_folder(spark, "warehouse"))
    load_warehouse(_gold(spark, sf)["CUSTOMER_MONTHLY"], target, "CUSTOMER_MONTHLY")
    return target.read(spark, "CUSTOMER_MONTHLY")


@query
def scan_warehouse(spark, sf):
    """A report over warehouse tables instead of gold frames: alert amounts by table."""
    target = FolderWarehouse(scratch_folder(spark, "warehouse"))
    gold = _gold(spark, sf)
    amounts = {"FRAUD_HIGH_VALUE": "AMOUNT", "FRAUD_BURST": "TOTAL_AMOUNT", "FRAUD_HIGH_SPEND": "DAILY_SPEND"}
    load_all({name: gold[name] for name in amounts}, target)
    parts = [
        target.read(spark, name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("alerts"),
            F.round(F.sum(amount), 2).alias("amount"),
        )
        for name, amount in amounts.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def verify_row_counts(spark, sf):
    """Source and warehouse row counts of all eight tables."""
    target = FolderWarehouse(scratch_folder(spark, "verify"))
    gold = _gold(spark, sf)
    load_all(gold, target)
    stored = {name: target.read(spark, name) for name in WAREHOUSE_TABLES}
    return compare_row_counts(gold, stored)


@query
def table_row_counts(spark, sf):
    names = ("customer", "nation", "orders", "events")
    return row_counts({name: read_table(spark, f"{sf}/{name}.parquet") for name in names})


@query
def conform_contract(spark, sf):
    return projection.conform(_gold(spark, sf)["FRAUD_BURST"], CONTRACTS["FRAUD_BURST"])


@query
def warehouse_form(spark, sf):
    """Text dates, contract types and upper-case names together."""
    return warehouse_rows(_gold(spark, sf)["FRAUD_HIGH_VALUE"], CONTRACTS["FRAUD_HIGH_VALUE"])


# ---- projections and filters -------------------------------------------------------------


@query
def project_columns(spark, sf):
    alerts = fraud.high_value(view(spark, sf, "txn"), RULES.high_value_over)
    return alerts.select(
        "transaction_id", "account_number", "amount", "transaction_timestamp", "fraud_type"
    )


@query
def add_audit_columns(spark, sf):
    return with_constants(
        view(spark, sf, "cust"), bronze_load_timestamp=STAMP, source_file="raw/customer"
    )


@query
def upper_column_names(spark, sf):
    return projection.upper_names(view(spark, sf, "txn"))


@query
def export_normalize(spark, sf):
    """Timestamps, dates, a struct and an array leave as text."""
    nested = view(spark, sf, "txn").select(
        "transaction_id",
        "transaction_timestamp",
        "transaction_date",
        "amount",
        F.struct("merchant_name", "city").alias("place"),
        F.array("transaction_type", "channel").alias("tags"),
    )
    return projection.export_normalize(nested)


@query
def describe_schema(spark, sf):
    return quality.describe_table(view(spark, sf, "txn_dirty"))


@query
def filter_nulls(spark, sf):
    return view(spark, sf, "txn_dirty").filter(F.col("amount").isNull() & F.col("account_number").isNotNull())


@query
def filter_domain(spark, sf):
    return view(spark, sf, "cust_dirty").filter(quality.outside("account_type", ACCOUNT_TYPES))


@query
def filter_bad_timestamp(spark, sf):
    return view(spark, sf, "txn_dirty").filter(as_timestamp("transaction_timestamp").isNull())


@query
def filter_future(spark, sf):
    return view(spark, sf, "txn_dirty").filter(quality.in_future("transaction_timestamp", AS_OF))


# ---- data quality and layers -------------------------------------------------------------


@query
def dq_customer(spark, sf):
    return quality.customer_quality(view(spark, sf, "cust_dirty"))


@query
def dq_branch(spark, sf):
    return quality.branch_quality(view(spark, sf, "branch_dirty"))


@query
def dq_transaction(spark, sf):
    return quality.transaction_quality(view(spark, sf, "txn_dirty"), AS_OF)


@query
def dq_duplicates(spark, sf):
    return quality.duplicate_counts(view(spark, sf, "txn_dirty"), "transaction_id")


@query
def rejected_customer(spark, sf):
    return routing.split_customers(view(spark, sf, "cust_dirty"), STAMP)[1]


@query
def rejected_branch(spark, sf):
    return routing.split_branches(view(spark, sf, "branch_dirty"), STAMP)[1]


@query
def rejected_txn(spark, sf):
    return routing.split_transactions(view(spark, sf, "txn_dirty"), rejected_at=STAMP)[1]


@query
def rejected_txn_strict(spark, sf):
    return routing.split_transactions(view(spark, sf, "txn_dirty"), strict=True)[1]


@query
def rejected_malformed(spark, sf):
    """Files in which lines of two channels have a field too many or too few."""
    path = scratch_folder(spark, "ragged")
    txn = view(spark, sf, "txn")
    fields = ["transaction_id", "account_number", "transaction_date", "transaction_type", "amount"]
    city = F.when(F.col("channel") == "ATM", F.concat(F.lit(","), "city", F.lit(",more")))
    city = city.when(F.col("channel") == "CARD", "").otherwise(F.concat(F.lit(","), "city"))
    start = F.concat_ws(",", *[F.col(c).cast("string") for c in fields], F.lit("Shop"), "channel")
    # One column whose name is the header line; no value holds the separator.
    lines = txn.select(F.concat(start, city).alias(",".join(RAW_COLUMNS["transactions"])))
    lines.write.mode("overwrite").option("header", True).option("sep", "|").csv(path)
    _, rejected = routing.split_transactions(layers.bronze(spark, path, "transactions"))
    return rejected.select("transaction_id", "rejection_reason", "malformed_row")


@query
def dedup_key(spark, sf):
    return routing.dedup(view(spark, sf, "txn_dirty"), ["transaction_id"])


@query
def standardize_text(spark, sf):
    dirty = view(spark, sf, "txn_dirty")
    return layers.standardize_text(dirty, ("city", "transaction_type", "channel"), ("merchant_name",))


@query
def silver_customer(spark, sf):
    return layers.silver_customer(view(spark, sf, "cust_dirty"))


@query
def silver_branch(spark, sf):
    return layers.silver_branch(view(spark, sf, "branch_dirty"))


@query
def silver_txn(spark, sf):
    return layers.silver_transactions(view(spark, sf, "txn_dirty"))


def _bronze(spark, sf, name, entity):
    root = scratch_folder(spark, "bronze")
    write_csv(view(spark, sf, name), layer_path(root, "raw", entity))
    df = layers.bronze(spark, layer_path(root, "raw", entity), entity, STAMP)
    write_table(df, layer_path(root, "bronze", entity))
    return read_table(spark, layer_path(root, "bronze", entity))


@query
def bronze_customer(spark, sf):
    return _bronze(spark, sf, "cust_dirty", "customer")


@query
def bronze_branch(spark, sf):
    return _bronze(spark, sf, "branch_dirty", "branch")


@query
def bronze_txn(spark, sf):
    return _bronze(spark, sf, "txn_dirty", "transactions")


# ---- joins and summaries -----------------------------------------------------------------


@query
def customer_monthly(spark, sf):
    return _monthly(spark, sf)


@query
def customer_kpi(spark, sf):
    return _kpi(spark, sf)


@query
def txn_branch_link(spark, sf):
    return summaries.link_branch(*_star(spark, sf))


@query
def branch_summary(spark, sf):
    return _branches(spark, sf)


@query
def region_summary(spark, sf):
    return _regions(spark, sf)


@query
def account_activity(spark, sf):
    return summaries.account_activity(view(spark, sf, "txn"))


@query
def agg_count_col(spark, sf):
    """Non-null ids and amounts per channel of the damaged transactions."""
    return view(spark, sf, "txn_dirty").groupBy("channel").agg(
        F.count("transaction_id").alias("ids"), F.count("amount").alias("amounts")
    )


# ---- alert rules -------------------------------------------------------------------------


@query
def fraud_high_value(spark, sf):
    return fraud.high_value(view(spark, sf, "txn"), RULES.high_value_over, STAMP)


@query
def fraud_burst(spark, sf):
    return fraud.burst(view(spark, sf, "evt"), max_count=RULES.burst_over)


@query
def fraud_daily_spend(spark, sf):
    return fraud.daily_spend(view(spark, sf, "txn"), RULES.daily_spend_over)


@query
def fraud_dormant(spark, sf):
    return fraud.dormant(view(spark, sf, "txn"), active_since=RULES.dormant_active_since)


@query
def fraud_burst_sliding(spark, sf):
    return fraud.sliding_burst(view(spark, sf, "evt"), max_count=RULES.burst_over)


@query
def fraud_dormant_gap(spark, sf):
    return fraud.reactivated(view(spark, sf, "txn"))


@query
def fraud_summary(spark, sf):
    return fraud.with_total(_rule_totals(spark, sf))


@query
def fraud_alerts_all(spark, sf):
    return fraud.alerts_union(_alerts(spark, sf))


def _rule_totals(spark, sf):
    return fraud.rule_totals(view(spark, sf, "txn"), RULES, view(spark, sf, "evt"))


# ---- reporting datasets ------------------------------------------------------------------


@query
def cards_overview(spark, sf):
    """No customer's columns are shown, so account totals stand in for the joined table."""
    totals = summaries.account_totals(view(spark, sf, "txn"))
    debits = totals.select(F.col("txn_count").alias("total_transactions"), money(F.col("debit_sum")).alias("total_debit"))
    return reports.overview_from_totals(view(spark, sf, "cust"), debits, _rule_totals(spark, sf))


@query
def top_customers_debit(spark, sf):
    return reports.top_customers(_kpi(spark, sf))


@query
def txns_by_account_type(spark, sf):
    return reports.transactions_by_account_type(_kpi(spark, sf))


@query
def top_states_debit(spark, sf):
    return reports.top_states(_kpi(spark, sf))


@query
def debit_credit_by_account_type(spark, sf):
    return reports.debit_credit_by_account_type(_kpi(spark, sf))


@query
def cards_fraud(spark, sf):
    return reports.cards_from_totals(_rule_totals(spark, sf))


@query
def fraud_counts_by_type(spark, sf):
    return reports.counts_from_totals(_rule_totals(spark, sf))


@query
def high_value_by_channel(spark, sf):
    return reports.high_value_by_channel(_alerts(spark, sf)[HIGH_VALUE])


@query
def preview_high_value(spark, sf):
    return reports.high_value_listing(_alerts(spark, sf)[HIGH_VALUE])


@query
def cards_branch(spark, sf):
    return reports.branch_cards(view(spark, sf, "branch"), _branches(spark, sf))


@query
def top_branches_amount(spark, sf):
    return reports.top_branches(_branches(spark, sf))


@query
def region_ranked(spark, sf):
    return reports.ranked_regions(_regions(spark, sf))


@query
def region_txn_vs_customers(spark, sf):
    return reports.region_metrics(_regions(spark, sf))


@query
def cards_monthly(spark, sf):
    return reports.monthly_cards(_monthly(spark, sf))


@query
def monthly_trend(spark, sf):
    return reports.monthly_trend(_monthly(spark, sf))


@query
def yearly_spend(spark, sf):
    return reports.yearly_spend(_monthly(spark, sf))


@query
def top_monthly_spenders(spark, sf):
    return reports.top_monthly_spenders(_monthly(spark, sf))


@query
def distinct_accounts_span(spark, sf):
    """Accounts per branch that moved in a span of days, from stored sketches of the days."""
    path = scratch_folder(spark, "sketches")
    txn, cust, _ = _star(spark, sf)
    write_table(sketches.day_sketches(sketches.account_days(txn), cust), path)
    return sketches.distinct_accounts(read_table(spark, path), *LOAD_DAYS)


# ---- incremental, audit, streams ---------------------------------------------------------


@query
def incremental_load(spark, sf):
    """Growing snapshots of one source, each loaded on top of the last, the final one twice."""
    path = scratch_folder(spark, "incremental") + "/transactions"
    txn = view(spark, sf, "txn")
    # One folder per day would mean thousands of tiny files here.
    for day in LOAD_DAYS:
        incremental.incremental_load(txn.filter(F.col("transaction_date") <= F.lit(day)), path, partition_by=())
    incremental.incremental_load(txn, path, partition_by=())
    incremental.incremental_load(txn, path, partition_by=())
    return read_table(spark, path)


@query
def incremental_load_late(spark, sf):
    """Deliveries out of order: the last days first, then the whole, then the first days again."""
    path = scratch_folder(spark, "late") + "/transactions"
    txn = view(spark, sf, "txn")
    late, early = F.col("transaction_date") > F.lit(LOAD_DAYS[1]), F.col("transaction_date") <= F.lit(LOAD_DAYS[0])
    for part in (txn.filter(late), txn.unionByName(txn.filter(early)), txn.filter(early)):
        incremental.incremental_load(part, path, partition_by=())
    return read_table(spark, path)


@query
def incremental_load_moved(spark, sf):
    """Rows delivered under one month, some again as they were, some later corrected to another one."""
    path = scratch_folder(spark, "moved") + "/transactions"
    txn = view(spark, sf, "txn").withColumn("transaction_date", F.trunc("transaction_date", "month"))
    moved = txn.withColumn("transaction_date", F.add_months("transaction_date", 7)).withColumn("amount", F.col("amount") + 1)
    by = F.col("transaction_id") % 10
    deliveries = (txn.filter(by < 6), moved.filter(by < 2).unionByName(txn.filter(by >= 4)), moved.filter(by < 2))
    for part in deliveries:
        incremental.incremental_load(part, path, on_conflict=REPLACE)
    # Under `keep` a stored key stays as it is, whatever day it comes with.
    incremental.incremental_load(moved.filter(by == 9), path)
    return read_table(spark, path)


@query
def daily_incremental(spark, sf):
    """Alerts and account figures after three deliveries: the second repeats part of the first, the third corrects rows."""
    root = scratch_folder(spark, "deliveries")
    lines = view(spark, sf, "txn_delivered")
    fixed = lines.withColumn("transaction_timestamp", F.col("corrected_timestamp")).withColumn("amount", F.col("amount") * 2)
    write_csv(view(spark, sf, "cust_orphan"), f"{root}/in/0/customer")
    write_csv(view(spark, sf, "branch"), f"{root}/in/0/branch")
    parts = (lines.filter("part < 2"), lines.filter("part <> 1"), fixed.filter("corrected"))
    for k, part in enumerate(parts):
        write_csv(part.drop("part", "corrected", "corrected_timestamp"), f"{root}/in/{k}/transactions")
        IncrementalRun(spark, root, STAMP, RULES).deliver(str(k), f"{root}/in/{k}")
    run = IncrementalRun(spark, root, STAMP, RULES)
    alerts = fraud.alerts_union({name: run.table("gold", folder) for name, folder in ALERT_FOLDERS.items()})
    kpi = run.table("gold", "customer_summary/overall_kpi").select(
        F.lit("KPI").alias("fraud_type"), "account_number", F.lit(None).cast("date").alias("event_date"),
        F.col("total_debit").alias("amount"), F.col("total_transactions").alias("txn_count"),
    )
    return alerts.unionByName(kpi).withColumn("amount", money(F.col("amount")))


@query
def sink_partitioned_rebalance(spark, sf):
    """The default way to write date folders: one task per folder, large ones cut by size."""
    path = scratch_folder(spark, "rebalanced")
    write_table(view(spark, sf, "txn"), path, partition_by=["transaction_date"])
    return read_table(spark, path)


@query
def incremental_load_stream(spark, sf):
    """The same table loaded by a file stream that is started twice; the second run finds nothing new."""
    path = scratch_folder(spark, "filestream")
    for _ in range(2):
        flows.run_to_end(_stream(spark, sf, "txn"), f"{path}/table", f"{path}/checkpoint")
    return read_table(spark, f"{path}/table")


@query
def audit_log(spark, sf):
    """The log of a whole daily run over the damaged files."""
    return _daily(spark, sf).table("audit", "runs")


@query
def daily_quality_log(spark, sf):
    """Quality reports that a daily run stores before it cleans."""
    return _daily(spark, sf).table("audit", "quality")


@query
def daily_verification(spark, sf):
    """Row counts of gold and warehouse that a daily run compares at its end."""
    return _daily(spark, sf).table("audit", "verification")


def _daily(spark, sf):
    root = scratch_folder(spark, "daily")
    raw = {"customer": "cust_dirty", "branch": "branch_dirty", "transactions": "txn_dirty"}
    for entity, name in raw.items():
        write_csv(view(spark, sf, name), layer_path(root, "raw", entity))
    # The tables hold a few rows per day, too few for one folder each.
    daily = DailyRun(spark, root, STAMP, RULES, partition_by=())
    daily.run(FolderWarehouse(root))
    return daily


def _stream(spark, sf, name):
    """A view over its base table read as a stream.

    A file source takes folders or patterns; the pattern fits a table that is one
    file as well as one that is a folder.
    """
    path = f"{sf}/{base_table(name)}.parquet"
    return over(spark, name, flows.read_stream(spark, f"{path}*", spark.read.parquet(path).schema))


def _settled(spark, stream, purpose):
    """Run a stream to its end and return the table it wrote."""
    path = scratch_folder(spark, purpose)
    flows.run_to_end(stream, f"{path}/table", f"{path}/checkpoint")
    return read_table(spark, f"{path}/table")


@query
def stream_high_value(spark, sf):
    alerts = flows.stream_high_value(_stream(spark, sf, "txn"), RULES.high_value_over, STAMP)
    return _settled(spark, alerts, "highvalue")


@query
def stream_burst(spark, sf):
    alerts = flows.stream_burst(_stream(spark, sf, "evt"), max_count=RULES.burst_over)
    return _settled(spark, alerts, "burst")


@query
def stream_daily_spend(spark, sf):
    alerts = flows.stream_daily_spend(_stream(spark, sf, "txn"), threshold=RULES.daily_spend_over)
    return _settled(spark, alerts, "dailyspend")


@query
def stream_dedup(spark, sf):
    """Every event arrives twice; one of each is kept."""
    twice = _stream(spark, sf, "evt").unionByName(_stream(spark, sf, "evt"))
    return _settled(spark, flows.stream_dedup(twice, "transaction_id"), "dedup")


def _in_pieces(spark, sf, name, pieces, table, keep=None):
    """Feed a view to a table of windows, one micro-batch a piece, each found by a stream of its own start.

    A piece is written by as many tasks as read it, in files of bounded length: a file is
    one row group otherwise, and all its rows are folded by one task.
    """
    folder = scratch_folder(spark, "pieces")
    base = spark.read.parquet(f"{sf}/{base_table(name)}.parquet")
    for piece in pieces:
        base.filter(piece).write.option("maxRecordsPerFile", PIECE_ROWS).mode("append").parquet(folder)
        stream = over(spark, name, flows.read_stream(spark, folder, base.schema))
        table.run_to_end(stream if keep is None else stream.filter(keep))
    return table


def _halves(spark, sf):
    """Events before and from the middle of their time on."""
    ends = spark.read.parquet(f"{sf}/events.parquet").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(ends.a + (ends.b - ends.a) / 2)
    return F.col("ts") < middle, ~F.coalesce(F.col("ts") < middle, F.lit(False))


@query
def stream_burst_current(spark, sf):
    """Bursts of a stream with the windows that are still open: the same as the batch rule finds."""
    table = windows.WindowTable(spark, scratch_folder(spark, "bursts"))
    return windows.bursts(_in_pieces(spark, sf, "evt", _halves(spark, sf), table), RULES.burst_over)


@query
def stream_daily_spend_current(spark, sf):
    """Daily spend of a stream with the days that are still open: the same as the batch rule finds."""
    table = windows.WindowTable(spark, scratch_folder(spark, "days"), windows.DAY, "1 hour")
    pieces = (F.col("o_orderdate") < F.lit(LOAD_DAYS[0]), F.col("o_orderdate") >= F.lit(LOAD_DAYS[0]))
    fed = _in_pieces(spark, sf, "txn", pieces, table, F.col("transaction_type") == "DEBIT")
    return windows.daily_spend(fed, RULES.daily_spend_over)


@query
def stream_late_rows(spark, sf):
    """Rows behind the watermark of a table of days, after later days have come first."""
    table = windows.WindowTable(spark, scratch_folder(spark, "days"), windows.DAY, "1 hour")
    first = F.col("o_orderdate").between(F.lit(LOAD_DAYS[0]), F.lit(LOAD_DAYS[1]))
    fed = _in_pieces(spark, sf, "txn", (first, ~first), table)
    return fed.late().select("transaction_id", "account_number", "amount", "transaction_date", "kind")


@query
def stream_row_account(spark, sf):
    """Of the same stream: rows that came, that windows hold (closed and open), and that are late."""
    table = windows.WindowTable(spark, scratch_folder(spark, "days"), windows.DAY, "1 hour")
    first = F.col("o_orderdate").between(F.lit(LOAD_DAYS[0]), F.lit(LOAD_DAYS[1]))
    fed = _in_pieces(spark, sf, "txn", (first, ~first), table)
    came = fed.progress().agg(F.sum("rows").alias("came"), F.sum("late").alias("late"), F.sum("untimed").alias("untimed"))
    held = fed.totals().agg(
        F.sum(F.when(F.col("open"), F.lit(0)).otherwise(F.col("rows"))).alias("closed"), F.sum(F.when(F.col("open"), F.col("rows")).otherwise(F.lit(0))).alias("open")
    )
    return came.join(held)


@query
def stream_reactivated(spark, sf):
    """Accounts that move again after a gap, from a stream whose later days come first."""
    table = windows.WindowTable(spark, scratch_folder(spark, "days"), windows.DAY, None)
    first = F.col("o_orderdate").between(F.lit(LOAD_DAYS[0]), F.lit(LOAD_DAYS[1]))
    return windows.reactivated(_in_pieces(spark, sf, "txn", (first, ~first), table))


@query
def stream_burst_sliding(spark, sf):
    """Bursts up to any moment, from a stream of moments."""
    table = windows.WindowTable(spark, scratch_folder(spark, "moments"), None, None)
    return windows.sliding_bursts(_in_pieces(spark, sf, "evt", _halves(spark, sf), table), max_count=RULES.burst_over)
