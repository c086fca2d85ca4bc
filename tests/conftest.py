from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TXN_SCHEMA = (
    "transaction_id string, account_number string, transaction_timestamp timestamp, "
    "transaction_type string, amount double, merchant_name string, channel string, city string"
)
CUST_SCHEMA = (
    "customer_id string, account_number string, customer_name string, account_type string, "
    "branch_id string, city string, state string, status string"
)
BRANCH_SCHEMA = "branch_id string, branch_name string, city string, state string, region string"


@pytest.fixture()
def txns(spark):
    """Build clean transactions from (account, time, amount[, type]) tuples; ids are made up."""
    from pyspark.sql import functions as F

    def build(rows):
        full = [
            (f"t{i:05d}", account, None, (rest or ["DEBIT"])[0], float(amount), "Shop", "UPI", "PUNE", when)
            for i, (account, when, amount, *rest) in enumerate(rows)
        ]
        schema = TXN_SCHEMA + ", at string"
        df = spark.createDataFrame(full, schema)
        return (
            df.withColumn("transaction_timestamp", F.to_timestamp("at"))
            .drop("at")
            .withColumn("transaction_date", F.to_date("transaction_timestamp"))
        )

    return build
