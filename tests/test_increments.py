from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import run_daily
from tillwatch.plans import increments
from tillwatch.plans.daily import ALERT_FOLDERS, WAREHOUSE_TABLES, DailyRun
from tillwatch.plans.increments import IncrementalRun
from tillwatch.settings import BURST, RuleParams
from tillwatch.sources.warehouse import FolderWarehouse

STAMP = "2026-01-01 00:00:00"
RULES = RuleParams(high_value_over=100, burst_over=2, daily_spend_over=250)
CUSTOMERS = """customer_id,account_number,customer_name,account_type,branch_id,city,state,status
c1,001,Ann, savings,b1, pune,mh,active
c2,002,Bob,NRI,b2,pune,mh,closed
"""
BRANCHES = """branch_id,branch_name,city,state,region
b1,Main,pune,mh,North
b2,Side,goa,ga,South
"""
HEADER = "transaction_id,account_number,transaction_timestamp,transaction_type,amount,merchant_name,channel,city\n"


def lines(*rows):
    return HEADER + "".join(f"{t},{account},{when},{kind},{amount},Shop,UPI,pune\n" for t, account, when, kind, amount in rows)


FIRST = [
    ("t1", "001", "2025-03-01 10:00:00", "debit", 150), ("t2", "001", "2025-03-01 10:01:00", "DEBIT", 120),
    ("t3", "001", "2025-03-01 10:02:00", "DEBIT", 5), ("t4", "002", "2025-04-01 23:55:00", "CREDIT", 10),
    ("t5", "002", "2025-04-01 23:56:00", "CREDIT", 10), ("t6", "009", "bad", "CREDIT", 10), (",", "", "", "", ""),
]
SECOND = [
    ("t4", "002", "2025-04-01 23:55:00", "CREDIT", 10),  # again as it was
    ("t7", "002", "2025-04-01 23:57:00", "DEBIT", 300), ("t8", "002", "2025-12-01 09:00:00", "DEBIT", 40),
    ("t9", "001", "2025-03-02 10:00:00", "CREDIT", -5), ("t10", "009", "2025-03-01 10:02:30", "CREDIT", 1),
]
THIRD = [("t1", "001", "2025-05-05 10:00:00", "DEBIT", 90), ("t9", "001", "2025-03-02 10:00:00", "CREDIT", 500)]  # corrections
LAST = [*FIRST[1:-1], *SECOND[1:3], SECOND[4], *THIRD]


@pytest.fixture()
def folder(tmp_path):
    def make(name, rows, owners=False):
        texts = {"transactions": lines(*rows)} | ({"customer": CUSTOMERS, "branch": BRANCHES} if owners else {})
        for entity, text in texts.items():
            (tmp_path / name / entity).mkdir(parents=True)
            (tmp_path / name / entity / "part.csv").write_text(text)
        return str(tmp_path / name)

    return make


def contents(spark, root):
    target = FolderWarehouse(root)
    found = {}
    for table in WAREHOUSE_TABLES:
        df = target.read(spark, table)
        found[table] = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    return found


def full_run(spark, tmp_path, rows):
    root = tmp_path / "full"
    for entity, text in {"transactions": lines(*rows), "customer": CUSTOMERS, "branch": BRANCHES}.items():
        (root / "raw" / entity).mkdir(parents=True)
        (root / "raw" / entity / "part.csv").write_text(text)
    DailyRun(spark, str(root), STAMP, RULES).run(FolderWarehouse(str(root)))
    return contents(spark, str(root))


def test_three_deliveries_equal_one_full_run(spark, tmp_path, folder):
    root = str(tmp_path / "lake")
    target = FolderWarehouse(root)
    first = IncrementalRun(spark, root, STAMP, RULES).deliver("d1", folder("one", FIRST, owners=True), target)
    assert (first.new, first.changed, first.same) == (5, 0, 0)
    assert {t: len(rows) for t, rows in contents(spark, root).items()}["FRAUD_HIGH_VALUE"] == 2
    IncrementalRun(spark, root, STAMP, RULES).deliver("d2", folder("two", SECOND), target)
    third = folder("three", THIRD)
    moved = IncrementalRun(spark, root, STAMP, RULES).deliver("d3", third, target)
    assert (moved.new, moved.changed) == (1, 1)
    want = full_run(spark, tmp_path, LAST)
    assert contents(spark, root) == want
    assert all(want.values())
    # The same delivery again touches nothing.
    again = IncrementalRun(spark, root, STAMP, RULES).deliver("d3", third, target)
    assert again.days == ()
    assert contents(spark, root) == want
    run = IncrementalRun(spark, root, STAMP, RULES)
    log = {r.step: (r.rows_in, r.rows_out, r.rows_rejected) for r in run.table("audit", "runs").collect()}
    assert log["delivery_d2"] == (5, 3, 1)
    assert {r.fraud_type: r.alerts for r in run.table("gold", "fraud_alerts/summary").collect()}["TOTAL"] == sum(
        len(rows) for table, rows in want.items() if table.startswith("FRAUD")
    )


def test_only_touched_days_and_months_are_folded_again(spark, tmp_path, folder, monkeypatch):
    root = str(tmp_path / "lake")
    IncrementalRun(spark, root, STAMP, RULES).deliver("d1", folder("one", FIRST, owners=True))
    replaced = {}
    real = increments.replace_days

    def spy(df, path, column, days, fmt):
        replaced[path.removeprefix(root + "/")] = [str(d) for d in days]
        real(df, path, column, days, fmt)

    monkeypatch.setattr(increments, "replace_days", spy)
    IncrementalRun(spark, root, STAMP, RULES).deliver("d2", folder("two", [("t8", "002", "2025-12-01 00:05:00", "DEBIT", 40)]))
    assert replaced["totals/days_by_date"] == ["2025-12-01"]
    assert replaced["totals/months_by_month"] == ["202512"]
    assert replaced[f"gold/{ALERT_FOLDERS[BURST]}"] == ["2025-11-30", "2025-12-01"]


def test_a_run_that_breaks_off_after_the_load_is_completed(spark, tmp_path, folder, monkeypatch):
    root = str(tmp_path / "lake")
    one = folder("one", FIRST, owners=True)
    IncrementalRun(spark, root, STAMP, RULES).deliver("d1", one, FolderWarehouse(root))
    two, three = folder("two", SECOND), folder("three", THIRD)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(IncrementalRun, "_refold", lost)
    with pytest.raises(RuntimeError, match="lost"):
        IncrementalRun(spark, root, STAMP, RULES).deliver("d2", two)
    monkeypatch.undo()
    # Its rows are stored already; its days are still due.
    for name, place in (("d2", two), ("d3", three)):
        IncrementalRun(spark, root, STAMP, RULES).deliver(name, place, FolderWarehouse(root))
    assert contents(spark, root) == full_run(spark, tmp_path, LAST)


def test_deliveries_go_on_from_a_full_run(spark, tmp_path, folder):
    root = folder("lake", [], owners=True)
    (tmp_path / "lake" / "raw").mkdir()
    for entity in ("customer", "branch", "transactions"):
        (tmp_path / "lake" / entity).rename(tmp_path / "lake" / "raw" / entity)
    (tmp_path / "lake" / "raw" / "transactions" / "part.csv").write_text(lines(*FIRST))
    DailyRun(spark, root, STAMP, RULES).run(FolderWarehouse(root))
    for name, rows in (("d2", SECOND), ("d3", THIRD)):
        run_daily.main([root, "--delivery", name, "--from", folder(name, rows)], rules=RULES, stamp=STAMP)
    assert contents(spark, root) == full_run(spark, tmp_path, LAST)


def test_a_delivery_without_clean_rows(spark, tmp_path, folder):
    root = str(tmp_path / "lake")
    run = IncrementalRun(spark, root, STAMP, RULES)
    loaded = run.deliver("d1", folder("one", [("t6", "009", "bad", "CREDIT", 10)], owners=True), FolderWarehouse(root))
    assert loaded.new == 0
    assert not any(contents(spark, root).values())
    run.deliver("d2", folder("two", FIRST), FolderWarehouse(root))
    assert run.table("silver", "transactions").agg(F.count("*")).first()[0] == 5
