"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local executor threads (default 8)
    BENCH_ROUNDS   timed runs per query, the median counts (default 3)
    BENCH_PLAIN=1  also time the straightforward forms of some queries
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from acceptance.queries import QUERIES, RULES  # noqa: E402
from acceptance.views import view  # noqa: E402
from tillwatch.operators import fraud, summaries  # noqa: E402

HEADLINES = (
    "customer_monthly",
    "customer_kpi",
    "txn_branch_link",
    "branch_summary",
    "region_summary",
    "account_activity",
    "fraud_high_value",
    "fraud_burst",
    "fraud_burst_sliding",
    "fraud_daily_spend",
    "fraud_dormant",
    "fraud_dormant_gap",
    "fraud_summary",
    "dq_transaction",
    "dedup_key",
    "rejected_txn",
    "silver_customer",
    "silver_txn",
    "bronze_txn",
    "sink_warehouse",
    "top_customers_debit",
    "monthly_trend",
    "cards_overview",
    "stream_burst",
)


def plain_kpi_of(txn: DataFrame, cust: DataFrame) -> DataFrame:
    """Join first, aggregate after."""
    cust = cust.withColumnsRenamed({"city": "customer_city", "state": "customer_state"})
    joined = txn.join(cust, "account_number", "left")
    debit, credit = [
        F.round(F.sum(F.when(F.col("transaction_type") == t, F.col("amount")).otherwise(0)), 2).alias(t)
        for t in ("DEBIT", "CREDIT")
    ]
    keys = ["account_number", "customer_id", "customer_name", "account_type", "customer_city", "customer_state"]
    return joined.groupBy(*keys).agg(debit, credit, F.count("transaction_id"), F.avg("amount"), F.max("amount"))


def plain_region_of(txn: DataFrame, cust: DataFrame, branch: DataFrame) -> DataFrame:
    """Two distinct counts over joined transactions."""
    return (
        summaries.link_branch(txn, cust, branch)
        .groupBy("region")
        .agg(
            F.count("transaction_id"),
            F.sum("amount"),
            F.countDistinct("account_number"),
            F.countDistinct("branch_id"),
        )
    )


def plain_dq(spark: SparkSession, sf: str) -> None:
    plain_dq_of(view(spark, sf, "txn_dirty"))


def plain_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return plain_kpi_of(view(spark, sf, "txn"), view(spark, sf, "cust_orphan"))


def plain_region(spark: SparkSession, sf: str) -> DataFrame:
    return plain_region_of(*[view(spark, sf, v) for v in ("txn", "cust_orphan", "branch")])


def plain_dq_of(df: DataFrame) -> None:
    """One job per metric."""
    stamp = F.try_to_timestamp("transaction_timestamp")
    for check in (
        F.lit(True),
        F.col("transaction_id").isNull(),
        F.col("account_number").isNull(),
        F.col("amount").isNull(),
        F.col("amount") < 0,
        stamp > F.lit("2000-01-01").cast("timestamp"),
        ~F.col("transaction_type").isin("DEBIT", "CREDIT"),
        ~F.col("channel").isin("UPI", "ATM", "CARD", "NETBANKING"),
    ):
        df.filter(check).count()
    df.dropDuplicates(["transaction_id"]).count()


def plain_summary(spark: SparkSession, sf: str) -> None:
    """One count per rule, and every rule once more for the total."""
    rules = fraud.all_rules(view(spark, sf, "txn"), RULES)
    for _ in range(2):
        for alerts in rules.values():
            alerts.count()


PLAIN = {
    "customer_kpi": plain_kpi,
    "region_summary": plain_region,
    "dq_transaction": plain_dq,
    "fraud_summary": plain_summary,
}


def seconds(spark: SparkSession, sf: str, query, rounds: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        df = query(spark, sf)
        if df is not None:
            df.write.mode("overwrite").format("noop").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(rounds)), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: seconds(spark, sf, QUERIES[name], rounds) for name in HEADLINES}
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": Path(sf).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_PLAIN"):
        result["plain"] = {name: seconds(spark, sf, query, rounds) for name, query in PLAIN.items()}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
