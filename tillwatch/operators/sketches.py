"""Distinct accounts over any span of days, from sketches that are stored per day.

An exact distinct count over a span has to see every account of every day in it. A sketch
of a day has a bounded size, and sketches of days add up to that of any span, branch or
region, without going back to the transactions. Exact counts stay the default elsewhere;
these are for spans that are asked for ad hoc. Up to some thousand accounts the estimate
is exact to the account, beyond that its standard error is about `1.04 / sqrt(2 ** LG_K)`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 2 ** LG_K registers: 0.8 percent standard error, 16 KB at most per branch and day


def account_days(txn: DataFrame) -> DataFrame:
    """The accounts that moved on each day, once each; `day_totals` serves as well."""
    return txn.select("account_number", "transaction_date").distinct()


def day_sketches(days: DataFrame, cust: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """transaction_date, branch_id and a sketch of the accounts that moved, from rows of account and day.

    Accounts without a customer count under a null branch. Null accounts count nowhere.
    """
    owner = cust.select("account_number", "branch_id")
    placed = days.select("account_number", "transaction_date").join(owner, "account_number", "left")
    account = F.col("account_number").cast("string")
    return placed.groupBy("transaction_date", "branch_id").agg(F.hll_sketch_agg(account, lg_k).alias("accounts"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches folded to the columns `by`, such as a month or a region joined to them."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("accounts").alias("accounts"))


def distinct_accounts(sketches: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """branch_id and the number of distinct accounts on the days from `since` to `until`, both included."""
    day = F.col("transaction_date")
    if since is not None:
        sketches = sketches.filter(day >= F.lit(since))
    if until is not None:
        sketches = sketches.filter(day <= F.lit(until))
    return merged(sketches, "branch_id").select("branch_id", F.hll_sketch_estimate("accounts").alias("distinct_accounts"))
