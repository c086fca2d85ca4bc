"""Times operators against their straightforward forms on enlarged, skewed tables.

    python scale_check.py [copies] [case ...]

Spark derives the tables from the test orders: every order appears `copies`
times at other moments, and a third of all rows goes to one account.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from acceptance.views import over, view  # noqa: E402
from bench import plain_dq_of, plain_kpi_of, plain_region_of  # noqa: E402
from tillwatch.operators import fraud, quality, routing, summaries  # noqa: E402
from tillwatch.sources.scratch import scratch_folder  # noqa: E402

SF_DIR = "/root/testdata/sf0.1"


def enlarged_orders(spark: SparkSession, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").repartition(64).withColumn("copy", copy)
    second = F.pmod(F.xxhash64("o_orderkey", "copy"), F.lit(30 * 86400)).cast("int")
    return orders.select(
        (F.col("o_orderkey") * copies + F.col("copy")).alias("o_orderkey"),
        F.when(F.col("copy") % 3 == 0, F.lit(1))
        .otherwise(F.col("o_custkey") + F.col("copy") % 50 * 15000)
        .cast("long")
        .alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        (F.col("o_orderdate") + F.make_dt_interval(secs=second)).alias("o_orderdate"),
        "o_orderpriority",
    )


def plain_sliding(txn: DataFrame) -> DataFrame:
    trailing = (
        "over (partition by account_number order by transaction_timestamp "
        "range between interval '10 minutes' preceding and current row)"
    )
    counted = txn.withColumn("n", F.expr(f"count(transaction_id) {trailing}"))
    return counted.filter("n > 3").select("account_number", "transaction_timestamp", "n").distinct()


def plain_reactivated(txn: DataFrame) -> DataFrame:
    before = F.lag("transaction_date").over(
        Window.partitionBy("account_number").orderBy("transaction_date", "transaction_id")
    )
    return txn.withColumn("gap", F.datediff("transaction_date", before)).filter("gap >= 180")


def plain_dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(["transaction_id"])


def write(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.mode("overwrite").format("noop").save()


def frames(ours: DataFrame, plain: DataFrame) -> tuple[Callable[[], None], Callable[[], None]]:
    return lambda: write(ours), lambda: write(plain)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 200
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("scale")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        # Dimensions that outgrow a broadcast, as at full size.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_folder(spark, "scale") + "/orders"
    enlarged_orders(spark, copies).write.parquet(path)
    txn = over(spark, "txn", spark.read.parquet(path))
    cust, branch = (view(spark, SF_DIR, name) for name in ("cust_orphan", "branch"))
    # A third of the rows share one id.
    copied = txn.withColumn(
        "transaction_id", F.when(F.col("account_number") == 1, F.lit(0)).otherwise(F.col("transaction_id"))
    )
    orders = spark.read.parquet(path)
    damaged = scratch_folder(spark, "scale") + "/damaged"
    over(spark, "txn_dirty", orders).write.parquet(damaged)
    dirty = spark.read.parquet(damaged)
    cases = {
        "quality": (
            lambda: write(quality.transaction_quality(dirty, datetime(2000, 1, 1))),
            lambda: plain_dq_of(dirty),
        ),
        "customer_kpi": frames(summaries.customer_kpi(txn, cust), plain_kpi_of(txn, cust)),
        "region_summary": frames(
            summaries.region_summary(txn, cust, branch),
            plain_region_of(txn, cust, branch),
        ),
        "sliding_burst": frames(fraud.sliding_burst(txn), plain_sliding(txn)),
        "reactivated": frames(fraud.reactivated(txn), plain_reactivated(txn)),
        "dedup": frames(routing.dedup(copied, ["transaction_id"]), plain_dedup(copied)),
    }
    print(json.dumps({"rows": txn.count(), "hot": txn.filter("account_number = 1").count()}), flush=True)
    for name in sys.argv[2:] or cases:
        result = {"case": name}
        for label, run in zip(("ours", "plain"), cases[name], strict=True):
            start = time.perf_counter()
            run()
            result[label] = round(time.perf_counter() - start, 1)
        print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
