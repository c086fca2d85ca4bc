from __future__ import annotations

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from tillwatch.operators import projection, quality, routing
from tillwatch.plans import layers
from tillwatch.schemas import CONTRACTS, RAW_COLUMNS, raw_schema
from tillwatch.sources import tables
from tillwatch.sources.scratch import scratch_folder
from tillwatch.sources.warehouse import FolderWarehouse, JdbcWarehouse, load_warehouse, warehouse_rows


def test_leading_zeros_survive_the_raw_schema(spark, tmp_path):
    (tmp_path / "branch.csv").write_text("branch_id,branch_name,city,state,region\n001,Main, Pune,,North\n")
    row = tables.read_csv(spark, str(tmp_path), raw_schema("branch")).collect()[0]
    assert (row.branch_id, row.city, row.state) == ("001", " Pune", None)
    inferred = tables.read_csv(spark, str(tmp_path)).collect()[0]
    assert inferred.branch_id == 1


def test_headers_decide_the_order_of_raw_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("region,branch_id,branch_name,city,state,note\nNorth,001,Main,Pune,MH,x\n")
    row = layers.bronze(spark, str(tmp_path), "branch", "now").collect()[0]
    assert (row.branch_id, row.region, row.note) == ("001", "North", "x")
    assert (row.bronze_load_timestamp, row.source_file) == ("now", "raw/branch")


def test_a_file_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("branch_id,branch_name,city,state,region\n001,Main,Pune,MH,North\n")
    (tmp_path / "b.csv").write_text("region,branch_name,city,state,branch_id\nNorth,Side,Pune,MH,002\n")
    with pytest.raises(Exception, match="(?i)header"):
        layers.bronze(spark, str(tmp_path), "branch").collect()


def test_a_missing_raw_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("branch_id,branch_name\n001,Main\n")
    with pytest.raises(ValueError, match="city, state, region"):
        layers.bronze(spark, str(tmp_path), "branch")


def test_overwrite_replaces_and_empty_frames_empty_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    assert tables.write_table(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3
    assert tables.write_table(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 0


def test_skipped_empty_frame_keeps_the_earlier_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path, skip_empty=True)
    assert not tables.write_table(spark.range(0), path, skip_empty=True)
    assert tables.read_table(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_skipping_computes_the_source_once(spark, tmp_path):
    touches = spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            touches.add(batch.num_rows)
            yield batch

    counted = spark.range(1000).mapInArrow(touched, "id long").groupBy("id").count().filter("count = 1")
    assert tables.write_table(counted, str(tmp_path / "t"), skip_empty=True)
    assert touches.value == 1000


def test_malformed_lines_are_kept_and_rejected(spark, tmp_path):
    lines = ["branch_id,branch_name,city,state,region", "1,Main,Pune,MH,North", "2,Shop, Inc,Goa,GA,South", "3,Old,Goa"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    raw = layers.bronze(spark, str(tmp_path), "branch")
    assert raw.select("branch_id").count() == 3
    clean, rejected = routing.split_branches(raw)
    assert [r.branch_id for r in clean.collect()] == ["1"]
    assert "malformed_row" not in clean.columns
    found = {r.malformed_row: r.rejection_reason for r in rejected.collect()}
    assert found == {lines[2]: "Malformed row", lines[3]: "Malformed row"}
    counts = {r.metric: r.value for r in quality.branch_quality(raw).collect()}
    assert counts["malformed_rows"] == 2


def test_merge_keeps_old_columns_and_adds_new_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    tables.write_table(spark.createDataFrame([(2.5, 7)], "c double, a int"), path, merge_schema=True)
    out = tables.read_table(spark, path)
    assert out.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert [tuple(r) for r in out.collect()] == [(7, None, 2.5)]


def test_merge_into_nothing_and_type_clash(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(2), path, merge_schema=True)
    with pytest.raises(ValueError, match="id"):
        tables.write_table(spark.createDataFrame([("x",)], "id string"), path, merge_schema=True)


def test_day_folders_prune(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    df = txns([("a", f"2025-03-0{1 + i % 3} 10:00:00", i) for i in range(30)])
    tables.write_table(df, path, partition_by=["transaction_date"])
    out = tables.read_table(spark, path)
    assert dict(out.dtypes)["transaction_date"] == "date"
    day = out.filter(F.col("transaction_date") == F.lit("2025-03-02").cast("date"))
    assert day.count() == 10
    assert "PartitionFilters: [isnotnull(transaction_date" in day._jdf.queryExecution().executedPlan().toString()
    assert all(len(list(folder.glob("*.parquet"))) == 1 for folder in (tmp_path / "t").glob("transaction_date=*"))


def test_compact_writes_few_files(spark, tmp_path):
    left = spark.range(0, 80_000, 1, 40).filter("id % 1000 = 7")
    tables.write_table(left, str(tmp_path / "plain"))
    tables.write_table(left, str(tmp_path / "compact"), compact=True)
    assert len(list((tmp_path / "plain").glob("*.parquet"))) == 40
    assert len(list((tmp_path / "compact").glob("*.parquet"))) == 1
    assert tables.read_table(spark, str(tmp_path / "compact")).count() == 80


def test_a_fixed_number_of_tasks_shares_a_hot_day(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("day"), "id"
    )
    tables.write_table(df, str(path), partition_by=["day"], tasks=6)
    assert len(list((path / "day=hot").glob("*.parquet"))) >= 2
    assert len(list(path.glob("day=*/*.parquet"))) <= 51 + 6
    assert tables.read_table(spark, str(path)).count() == 3000


def test_an_oversized_day_is_cut_into_several_files(spark, tmp_path):
    """A third of all rows lies in one day; adaptive execution spreads it over tasks."""
    path = tmp_path / "t"
    df = spark.range(0, 600_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        tables.write_table(df, str(path), partition_by=["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "day=hot").glob("*.parquet"))) > 2
    assert tables.read_table(spark, str(path)).count() == 600_000


def test_row_counts_and_comparison(spark):
    source = {"a": spark.range(3), "b": spark.range(0)}
    assert {r.table_name: r.row_count for r in tables.row_counts(source).collect()} == {"a": 3, "b": 0}
    target = {"a": spark.range(2), "c": spark.range(1)}
    got = {r.table_name: r.matches for r in tables.compare_row_counts(source, target).collect()}
    assert got == {"a": False, "b": False, "c": False}


def test_scratch_folders_are_fresh_and_shared(spark):
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_export_turns_times_and_nested_values_into_text(spark):
    df = spark.sql(
        """select timestamp'2025-03-01 10:00:00' as ts, timestamp_ntz'2025-03-01 10:00:00.5' as ntz,
           date'2025-03-01' as d, named_struct('a', 1, 'b', 'x') as s, array(1, 2) as l, map('k', 1) as m,
           1.5D as keep"""
    )
    row = projection.export_normalize(df).collect()[0]
    assert tuple(row) == (
        "2025-03-01 10:00:00",
        "2025-03-01 10:00:00.5",
        "2025-03-01",
        '{"a":1,"b":"x"}',
        "[1,2]",
        '{"k":1}',
        1.5,
    )


def test_conform_orders_casts_and_complains(spark):
    df = spark.createDataFrame([(7, "x", 1)], "b int, extra string, a int")
    out = projection.conform(df, {"a": "string", "b": "double"})
    assert out.dtypes == [("a", "string"), ("b", "double")]
    with pytest.raises(ValueError, match="missing.*: c"):
        projection.conform(df, {"a": "string", "c": "string"})


def test_contracts_are_complete():
    assert len(CONTRACTS) == 8
    assert {name: len(columns) for name, columns in CONTRACTS.items()} == {
        "CUSTOMER_KPI": 12,
        "CUSTOMER_MONTHLY": 16,
        "BRANCH_SUMMARY": 13,
        "REGION_SUMMARY": 6,
        "FRAUD_HIGH_VALUE": 14,
        "FRAUD_BURST": 7,
        "FRAUD_HIGH_SPEND": 6,
        "FRAUD_DORMANT": 7,
    }
    assert {name: len(columns) for name, columns in RAW_COLUMNS.items()} == {
        "customer": 8,
        "branch": 5,
        "transactions": 8,
    }


@pytest.fixture()
def regions(spark):
    return spark.createDataFrame(
        [("NORTH", 5, 1.5, 2, 1, "now"), ("SOUTH", 1, 2.5, 1, 1, "now")],
        "region string, total_transactions long, total_amount double, unique_customers long, "
        "total_branches long, gold_load_timestamp string",
    )


def test_warehouse_load_counts_and_replaces(spark, tmp_path, regions):
    target = FolderWarehouse(str(tmp_path))
    assert load_warehouse(regions, target, "REGION_SUMMARY") == 2
    assert load_warehouse(regions.limit(1), target, "REGION_SUMMARY") == 1
    assert load_warehouse(regions.filter("region = 'none'"), target, "REGION_SUMMARY") == 0
    stored = target.read(spark, "REGION_SUMMARY")
    assert stored.count() == 0
    assert stored.columns[0] == "REGION"


def test_jdbc_target_truncates_instead_of_dropping(monkeypatch, regions):
    """No database runs in the tests: this looks at what is handed to Spark's writer."""
    seen = {}

    def option(self, key, value):
        seen[key] = value
        return self

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    target = JdbcWarehouse("jdbc:any://host/db", {"user": "u"}, connections=4)
    target.replace(warehouse_rows(regions, CONTRACTS["REGION_SUMMARY"]), "REGION_SUMMARY")
    assert seen == {
        "truncate": True,
        "numPartitions": 4,
        "batchsize": 10_000,
        "url": "jdbc:any://host/db",
        "table": "REGION_SUMMARY",
        "mode": "overwrite",
        "properties": {"user": "u"},
    }


def test_jdbc_tables_are_read_slice_by_slice(monkeypatch, spark):
    seen = []
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, predicates=None, properties=None: seen.append(predicates)
    )
    months = [f"TXN_MONTH = {month}" for month in range(1, 13)]
    target = JdbcWarehouse("jdbc:any://host/db", slices={"CUSTOMER_MONTHLY": months})
    target.read(spark, "CUSTOMER_MONTHLY")
    with pytest.raises(ValueError, match="no slices"):
        target.read(spark, "REGION_SUMMARY")
    JdbcWarehouse("jdbc:any://host/db", single_task=True).read(spark, "REGION_SUMMARY")
    assert seen == [months, None]
