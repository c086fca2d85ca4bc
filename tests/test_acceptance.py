from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from acceptance import queries
from acceptance.compare import connect, difference
from acceptance.oracle import ORACLE
from acceptance.queries import QUERIES
from acceptance.views import VIEWS, cte, view
from tillwatch.operators import routing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_agree_in_both_engines(spark, con, name):
    sql = f"with {cte(name)} select * from {name}"
    assert difference(spark, con, SF_DIR, lambda s, d: view(s, d, name), sql) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert difference(spark, con, SF_DIR, query, sql) is None


def test_damaged_rows_are_accounted_for(spark):
    """Rows in = clean + copies dropped + rejected + zero amounts, at the sizes found by hand."""
    sf_dir = "/root/testdata/sf0.01"
    dirty = view(spark, sf_dir, "txn_dirty")
    clean, rejected = routing.split_transactions(dirty)
    _, strict = routing.split_transactions(dirty, strict=True)
    kept = routing.dedup(clean, ["transaction_id"]).count()
    zero = strict.count() - rejected.count()
    assert (dirty.count(), kept, clean.count() - kept, rejected.count(), zero) == (15224, 13919, 208, 898, 199)


def test_totals_agree_across_summaries(spark):
    sf_dir = "/root/testdata/sf0.01"
    queries = entry_points.queries()

    def total(name, column):
        return queries[name](spark, sf_dir).agg(F.sum(column)).first()[0]

    amount = view(spark, sf_dir, "txn").agg(F.sum("amount")).first()[0]
    assert total("branch_summary", "total_amount") == pytest.approx(amount)
    assert total("region_summary", "total_amount") == pytest.approx(amount)
    assert total("customer_monthly", "monthly_spend") == pytest.approx(total("customer_kpi", "total_debit"))
    counts = {r.fraud_type: r.alerts for r in queries["fraud_summary"](spark, sf_dir).collect()}
    assert counts.pop("TOTAL") == sum(counts.values()) == queries["fraud_alerts_all"](spark, sf_dir).count()


def test_flagship_query_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_pieces_of_a_stream_are_files_of_bounded_length(spark, tmp_path, monkeypatch):
    """a piece was one file of one row group, which a single task folded."""
    columns = (
        "id as o_orderkey", "id % 50 as o_custkey", "'F' as o_orderstatus", "id / 4 as o_totalprice",
        "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id * 2 as int)) as o_orderdate", "'2-HIGH' as o_orderpriority",
    )
    spark.range(0, 1000, 1, 1).selectExpr(*columns).write.parquet(str(tmp_path / "sf/orders.parquet"))
    monkeypatch.setattr(queries, "PIECE_ROWS", 100)
    monkeypatch.setattr(queries, "scratch_folder", lambda _, purpose: str(tmp_path / purpose))
    account = queries.QUERIES["stream_row_account"](spark, str(tmp_path / "sf")).first()
    assert account.came == 1000 and account.late + account.untimed + account.closed + account.open == 1000
    files = [spark.read.parquet(str(f)).count() for f in (tmp_path / "pieces").glob("*.parquet")]
    assert sum(files) == 1000 and max(files) <= 100
    assert len(list((tmp_path / "days/progress").glob("batch=*"))) == 2  # a piece is still one micro-batch
