from __future__ import annotations

from datetime import date

import pytest

import run_daily

from pyspark.sql import functions as F

from tillwatch.plans.daily import WAREHOUSE_TABLES, DailyRun
from tillwatch.plans.incremental import fresh_rows, incremental_load
from tillwatch.plans.page import page_datasets, warehouse_tables
from tillwatch.settings import RuleParams
from tillwatch.sources.tables import read_table, write_table
from tillwatch.sources.warehouse import FolderWarehouse

CUSTOMERS = """customer_id,account_number,customer_name,account_type,branch_id,city,state,status
c1,001,Ann, savings,b1, pune,mh,active
c2,002,Bob,NRI,b1,pune,mh,closed
c2,002,Bob,NRI,b1,pune,mh,closed
,003,Cat,NRI,b1,pune,mh,active
"""
BRANCHES = """branch_id,branch_name,city,state,region
b1,Main,pune,mh,North
b2,,goa,ga,South
"""
TRANSACTIONS = """transaction_id,account_number,transaction_timestamp,transaction_type,amount,merchant_name,channel,city
t1,001,2025-03-01 10:00:00,debit,150000, Shop ,upi,pune
t2,001,2025-03-01 10:01:00,DEBIT,400000,Shop,UPI,pune
t3,001,2025-03-01 10:02:00,DEBIT,500000,Shop,UPI,pune
t4,001,2025-03-01 10:03:00,DEBIT,10,Shop,UPI,pune
t5,002,2025-04-01 10:03:00,CREDIT,10,Shop,UPI,pune
t6,002,2025-11-01 10:03:00,CREDIT,20,Shop,UPI,pune
t6,002,2025-11-01 10:03:00,CREDIT,20,Shop,UPI,pune
t7,002,2025-11-01 10:03:00,CREDIT,0,Shop,UPI,pune
t8,002,bad,CREDIT,20,Shop,UPI,pune
t9,009,2025-11-02 10:03:00,CREDIT,-20,Shop,UPI,pune
"""


@pytest.fixture()
def root(tmp_path):
    for entity, text in {"customer": CUSTOMERS, "branch": BRANCHES, "transactions": TRANSACTIONS}.items():
        folder = tmp_path / "raw" / entity
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text)
    return str(tmp_path)


def test_whole_run(spark, root):
    run = DailyRun(spark, root, "2026-01-01 00:00:00")
    loaded = run.run(FolderWarehouse(root))
    assert loaded == {
        "CUSTOMER_KPI": 2,
        "CUSTOMER_MONTHLY": 1,
        "BRANCH_SUMMARY": 1,
        "REGION_SUMMARY": 1,
        "FRAUD_HIGH_VALUE": 3,
        "FRAUD_BURST": 1,
        "FRAUD_HIGH_SPEND": 1,
        "FRAUD_DORMANT": 1,
    }
    log = {r.step: (r.rows_in, r.rows_out, r.rows_rejected) for r in run.table("audit", "runs").collect()}
    assert log["bronze_transactions"] == (10, 10, 0)
    assert log["silver_customer"] == (4, 2, 1)
    assert log["silver_branch"] == (2, 1, 1)
    assert log["silver_transactions"] == (10, 6, 2)
    assert log["fraud_alerts_burst"] == (6, 1, 0)
    assert log["warehouse_customer_kpi"] == (2, 2, 0)
    assert len(log) == 22
    kpi = FolderWarehouse(root).read(spark, "CUSTOMER_KPI").filter("ACCOUNT_NUMBER = '001'").collect()[0]
    assert (kpi.TOTAL_DEBIT, kpi.CUSTOMER_CITY, kpi.GOLD_LOAD_TIMESTAMP) == (1050010.0, "PUNE", run.stamp)


def test_a_run_stores_quality_summary_and_verification(spark, root):
    run = DailyRun(spark, root, "one")
    run.run(FolderWarehouse(root))
    counts = {(r.entity, r.metric): r.value for r in run.table("audit", "quality").collect()}
    assert counts["transactions", "duplicate_transaction_id"] == 1
    assert counts["transactions", "negative_amount"] == 1
    assert counts["customer", "null_customer_id"] == 1
    assert counts["branch", "malformed_rows"] == 0
    alerts = {r.fraud_type: r.alerts for r in run.table("gold", "fraud_alerts/summary").collect()}
    assert alerts["TOTAL"] == 6
    assert len(alerts) == 5
    checks = run.table("audit", "verification").collect()
    assert len(checks) == len(WAREHOUSE_TABLES)
    assert all(r.matches for r in checks)


def test_a_warehouse_that_lost_rows_fails_the_run(spark, root):
    target = FolderWarehouse(root)
    run = DailyRun(spark, root, "one")
    run.run(target)
    write_table(run.table("gold", "customer_summary/overall_kpi").filter("false"), f"{root}/warehouse/CUSTOMER_KPI")
    with pytest.raises(RuntimeError, match="CUSTOMER_KPI"):
        run.verify_warehouse(target)


def test_reports_read_the_warehouse(spark, root):
    target = FolderWarehouse(root)
    DailyRun(spark, root, "2026-01-01 00:00:00").run(target)
    silver = DailyRun(spark, root, "later")
    page = page_datasets(
        warehouse_tables(spark, target), silver.table("silver", "customer"), silver.table("silver", "branch")
    )
    rows = {name: df.collect() for name, df in page.items()}
    assert len(rows) == 17
    assert all(rows.values())
    assert {r.card: r.display for r in rows["overview_cards"]} == {
        "total_customers": "2",
        "total_transactions": "6",
        "total_debit": "₹0.1 Cr",
        "total_alerts": "6",
    }
    assert [r.customer_name for r in rows["top_customers"]] == ["Ann", "Bob"]
    assert {r.rule: r.alerts for r in rows["fraud_cards"]}["High Value"] == 3
    assert [r.amount for r in rows["high_value_listing"]] == ["₹150,000", "₹400,000", "₹500,000"]
    assert len(rows["region_metrics"]) == 2


def test_a_second_run_gives_the_same_tables(spark, root):
    def contents():
        target = FolderWarehouse(root)
        return {t: sorted(map(tuple, target.read(spark, t).collect()), key=repr) for t in WAREHOUSE_TABLES}

    DailyRun(spark, root, "2026-01-01 00:00:00").run(FolderWarehouse(root))
    first = contents()
    DailyRun(spark, root, "2026-01-01 00:00:00").run(FolderWarehouse(root))
    assert contents() == first


def test_single_steps_can_be_repeated(spark, root):
    DailyRun(spark, root, "one").run(FolderWarehouse(root))
    again = DailyRun(spark, root, "two", RuleParams(dormant_active_since=date(2030, 1, 1)))
    again.detect_fraud()
    assert again.rows("gold", "fraud_alerts/dormant") == 0
    assert again.table("gold", "fraud_alerts/burst").collect()[0].fraud_detected_at == "two"


def test_skipping_empty_alerts_keeps_the_earlier_ones(spark, root):
    DailyRun(spark, root, "one").run(FolderWarehouse(root))
    never = RuleParams(dormant_active_since=date(2030, 1, 1))
    again = DailyRun(spark, root, "two", never, skip_empty=True)
    again.detect_fraud()
    assert again.rows("gold", "fraud_alerts/dormant") == 1


def test_steps_from_the_command_line(spark, root):
    run_daily.main([root, "--step", "bronze", "--step", "silver_transactions", "--strict"])
    run = DailyRun(spark, root, "later")
    log = {r.step: r.rows_rejected for r in run.table("audit", "runs").collect()}
    assert log == {
        "bronze_customer": 0,
        "bronze_branch": 0,
        "bronze_transactions": 0,
        "silver_transactions": 3,
    }


def test_now_takes_one_stamp(spark, root):
    run = DailyRun.now(spark, root, strict=True)
    assert len(run.stamp) == 19
    assert run.strict


def _ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_incremental_load_takes_only_fresh_rows(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", f"2025-03-0{d} 10:00:00", d) for d in (1, 2, 2, 3)])
    incremental_load(df.filter("transaction_id in ('t00000', 't00001')"), path)
    target = read_table(spark, path)
    # t00002 has the newest stored timestamp, but its id is not there yet.
    assert _ids(fresh_rows(df, target)) == ["t00002", "t00003"]
    for _ in range(2):
        incremental_load(df, path)
        assert _ids(read_table(spark, path)) == ["t00000", "t00001", "t00002", "t00003"]


def test_late_rows_are_loaded(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", f"2025-03-0{d} 10:00:00", d) for d in (1, 2, 3, 4)])
    incremental_load(df.filter("transaction_id in ('t00000', 't00003')"), path)
    assert _ids(fresh_rows(df, read_table(spark, path))) == ["t00001", "t00002"]


def test_rows_without_key_or_time_are_loaded_once(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", f"2025-03-0{d} 10:00:00", d) for d in (1, 2, 3, 4)])
    null = F.lit(None)
    no_key = df.filter("transaction_id in ('t00000', 't00001')").withColumn("transaction_id", null.cast("string"))
    no_time = df.filter("transaction_id = 't00002'").withColumn("transaction_timestamp", null.cast("timestamp"))
    no_time = no_time.withColumn("transaction_date", null.cast("date"))
    odd = no_key.union(no_time).union(no_time)
    for _ in range(3):
        incremental_load(odd, path)
        assert read_table(spark, path).count() == 3
    for _ in range(2):
        incremental_load(df.union(df), path)
        assert read_table(spark, path).count() == 7


def test_a_table_of_null_days_is_not_doubled(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", "2025-03-01 10:00:00", 1)]).withColumn("transaction_date", F.lit(None).cast("date"))
    for _ in range(2):
        incremental_load(df, path)
        assert read_table(spark, path).count() == 1


def test_only_overlapping_days_of_the_target_are_read(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", f"2025-03-0{d} 10:00:00", d) for d in (1, 2, 3)])
    incremental_load(df, path)
    plan = fresh_rows(df, read_table(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    assert "Cartesian" not in plan


def test_loading_into_an_empty_table(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", "2025-03-01 10:00:00", 1)])
    incremental_load(df.filter("false"), path, partition_by=())
    incremental_load(df, path, partition_by=())
    assert _ids(read_table(spark, path)) == ["t00000"]
