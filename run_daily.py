"""Runs the daily load, whole or step by step.

    spark-submit --py-files tillwatch.zip run_daily.py ROOT [--step NAME ...] [--strict] [--skip-empty]
                 [--delivery NAME --from FOLDER] [--jdbc-url URL --jdbc-property KEY=VALUE ...]

ROOT holds raw/customer, raw/branch and raw/transactions with CSV files; all
layers are written below it. Steps, in order, are those of STEPS. With --delivery
only the raw files below FOLDER are brought in, and what they touch is computed anew.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillwatch.functions.audit import run_stamp
from tillwatch.plans.daily import DailyRun
from tillwatch.plans.increments import IncrementalRun
from tillwatch.settings import DEFAULT_RULES, RuleParams
from tillwatch.sources.warehouse import FolderWarehouse, JdbcWarehouse, Warehouse

STEPS = (
    "bronze",
    "silver_customer",
    "silver_branch",
    "silver_transactions",
    "fraud",
    "summaries",
    "warehouse",
    "verify",
)


def run_step(run: DailyRun, step: str, target: Warehouse) -> None:
    if step == "bronze":
        for entity in ("customer", "branch", "transactions"):
            run.load_bronze(entity)
    elif step == "fraud":
        run.detect_fraud()
    elif step == "summaries":
        run.build_summaries()
    elif step == "warehouse":
        for table, rows in run.load_warehouse(target).items():
            print(f"{table}: {rows} rows")
    elif step == "verify":
        run.verify_warehouse(target)
    else:
        getattr(run, f"build_{step}")()


def main(arguments: list[str] | None = None, rules: RuleParams = DEFAULT_RULES, stamp: str | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("root")
    parser.add_argument("--step", action="append", choices=STEPS, help="only these steps (default: all)")
    parser.add_argument("--strict", action="store_true", help="reject zero amounts")
    parser.add_argument("--skip-empty", action="store_true", help="keep earlier rows where a result is empty")
    parser.add_argument("--jdbc-url", help="load the warehouse over JDBC instead of into folders")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--delivery", metavar="NAME", help="bring in one delivery instead of running on all raw files")
    parser.add_argument("--from", dest="folder", metavar="FOLDER", help="where the delivery's raw files lie")
    options = parser.parse_args(arguments)
    if bool(options.delivery) != bool(options.folder) or (options.delivery and options.step):
        parser.error("--delivery and --from go together, and without --step")

    spark = SparkSession.builder.appName("daily-load").getOrCreate()
    target: Warehouse = FolderWarehouse(options.root)
    if options.jdbc_url:
        target = JdbcWarehouse(options.jdbc_url, dict(p.split("=", 1) for p in options.jdbc_property))
    stamp = stamp or run_stamp()
    if options.delivery:
        loaded = IncrementalRun(spark, options.root, stamp, rules, strict=options.strict).deliver(options.delivery, options.folder, target)
        print(f"{loaded.new} new rows, {loaded.changed} changed, {loaded.same} as before; {len(loaded.days)} days touched")
        return
    run = DailyRun(spark, options.root, stamp, rules, strict=options.strict, skip_empty=options.skip_empty)
    for step in STEPS:
        if not options.step or step in options.step:
            run_step(run, step, target)


if __name__ == "__main__":
    main()
