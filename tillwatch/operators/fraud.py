"""Alert rules over clean transactions.

Every rule is a filter or an aggregate with a map-side half, so no task ever
holds all rows of a busy account. The functions take batch frames; those without
a window function also take streams.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.audit import with_constants
from tillwatch.operators.summaries import account_activity, activity_from_days
from tillwatch.settings import (
    BURST,
    DAILY_SPEND,
    DEBIT,
    DEFAULT_RULES,
    DORMANT,
    HIGH_VALUE,
    REACTIVATED,
    SLIDING_BURST,
    RuleParams,
)


def _flag(df: DataFrame, fraud_type: str, detected_at: str | None) -> DataFrame:
    return with_constants(df, fraud_type=fraud_type, fraud_detected_at=detected_at)


def high_value(
    txn: DataFrame, threshold: float = DEFAULT_RULES.high_value_over, detected_at: str | None = None
) -> DataFrame:
    """Single transactions above the threshold, of any type."""
    return _flag(txn.filter(F.col("amount") > threshold), HIGH_VALUE, detected_at)


def burst(
    txn: DataFrame,
    width: str = DEFAULT_RULES.burst_width,
    max_count: int = DEFAULT_RULES.burst_over,
    detected_at: str | None = None,
) -> DataFrame:
    """More than `max_count` transactions of an account in one tumbling window."""
    slots = txn.groupBy("account_number", F.window("transaction_timestamp", width).alias("slot")).agg(
        F.count("transaction_id").alias("txn_count"), F.sum("amount").alias("total_amount")
    )
    found = slots.filter(F.col("txn_count") > max_count).select(
        "account_number",
        "txn_count",
        "total_amount",
        F.col("slot.start").alias("window_start"),
        F.col("slot.end").alias("window_end"),
    )
    return _flag(found, BURST, detected_at)


def daily_spend(
    txn: DataFrame,
    threshold: float = DEFAULT_RULES.daily_spend_over,
    txn_type: str = DEBIT,
    detected_at: str | None = None,
) -> DataFrame:
    """Accounts whose debits of one day add up to more than the threshold."""
    spent = (
        txn.filter(F.col("transaction_type") == txn_type)
        .groupBy("account_number", "transaction_date")
        .agg(F.sum("amount").alias("daily_spend"), F.count("transaction_id").alias("txn_count"))
    )
    return _flag(spent.filter(F.col("daily_spend") > threshold), DAILY_SPEND, detected_at)


def daily_spend_from_days(
    days: DataFrame,
    threshold: float = DEFAULT_RULES.daily_spend_over,
    txn_type: str = DEBIT,
    detected_at: str | None = None,
) -> DataFrame:
    """`daily_spend` as a mere filter over stored `day_totals`."""
    spent = days.filter((F.col("transaction_type") == txn_type) & (F.col("amount_sum") > threshold))
    found = spent.select("account_number", "transaction_date", F.col("amount_sum").alias("daily_spend"), "txn_count")
    return _flag(found, DAILY_SPEND, detected_at)


def dormant(
    txn: DataFrame,
    max_txns: int = DEFAULT_RULES.dormant_max_txns,
    active_since: date = DEFAULT_RULES.dormant_active_since,
    min_gap_days: int = DEFAULT_RULES.dormant_gap_over,
    detected_at: str | None = None,
) -> DataFrame:
    """Rarely used, recently active accounts whose first and last day lie far apart."""
    return dormant_from_activity(account_activity(txn), max_txns, active_since, min_gap_days, detected_at)


def _suspicious(max_txns: int, active_since: date, min_gap_days: int) -> Column:
    return (
        (F.col("total_txns") <= max_txns)
        & (F.col("last_txn_date") >= F.lit(active_since))
        & (F.datediff("last_txn_date", "first_txn_date") > min_gap_days)
    )


def dormant_from_activity(
    activity: DataFrame,
    max_txns: int = DEFAULT_RULES.dormant_max_txns,
    active_since: date = DEFAULT_RULES.dormant_active_since,
    min_gap_days: int = DEFAULT_RULES.dormant_gap_over,
    detected_at: str | None = None,
) -> DataFrame:
    quiet = activity.filter(_suspicious(max_txns, active_since, min_gap_days))
    return _flag(
        quiet.withColumn("gap_days", F.datediff("last_txn_date", "first_txn_date")), DORMANT, detected_at
    )


def sliding_burst(
    txn: DataFrame,
    minutes: int = 10,
    max_count: int = DEFAULT_RULES.burst_over,
    detected_at: str | None = None,
    slice_minutes: int = 60,
) -> DataFrame:
    """More than `max_count` transactions of an account in the `minutes` up to a moment.

    Unlike `burst` this sees bursts across window edges. One row per account and
    moment at which the trailing count is too high; both ends are inclusive.

    Equal moments are folded first. Time is then cut into slices that each start
    with `minutes` of history, so a window task sees one slice of one account,
    never its whole life, and only the history is held twice.
    """
    ts = "transaction_timestamp"
    moments = (
        txn.filter(F.col(ts).isNotNull())
        .groupBy("account_number", ts)
        .agg(F.count("transaction_id").alias("n"), F.sum("amount").alias("amount"))
    )
    return sliding_burst_from_moments(moments, minutes, max_count, detected_at, slice_minutes)


def sliding_burst_from_moments(
    moments: DataFrame,
    minutes: int = 10,
    max_count: int = DEFAULT_RULES.burst_over,
    detected_at: str | None = None,
    slice_minutes: int = 60,
) -> DataFrame:
    """`sliding_burst` of transactions that are folded to accounts and moments (n, amount) already."""
    ts = "transaction_timestamp"
    slices = F.window(ts, f"{slice_minutes + minutes} minutes", f"{slice_minutes} minutes")
    back = F.expr(f"interval '{minutes}' minute")
    sliced = moments.withColumn("slice", slices).select(
        "account_number",
        ts,
        "n",
        "amount",
        F.col("slice.start").alias("slice"),
        (F.col(ts) >= F.col("slice.start") + back).alias("own"),
    )
    trailing = (
        f"over (partition by account_number, slice order by {ts} "
        f"range between interval '{minutes}' minute preceding and current row)"
    )
    counted = sliced.withColumns(
        {
            "txn_count": F.expr(f"sum(n) {trailing}"),
            "total_amount": F.expr(f"sum(amount) {trailing}"),
        }
    )
    found = counted.filter(F.col("own") & (F.col("txn_count") > max_count)).select(
        "account_number",
        (F.col(ts) - back).alias("window_start"),
        F.col(ts).alias("window_end"),
        "txn_count",
        "total_amount",
    )
    return _flag(found, SLIDING_BURST, detected_at)


def reactivated(
    txn: DataFrame, min_gap_days: int = DEFAULT_RULES.dormant_gap_over, detected_at: str | None = None
) -> DataFrame:
    """Days on which an account moves again after at least `min_gap_days` without a transaction.

    Transactions are folded to days first, so the window holds one row per
    calendar day of an account.
    """
    days = (
        txn.filter(F.col("transaction_date").isNotNull())
        .groupBy("account_number", "transaction_date")
        .agg(F.count("transaction_id").alias("txn_count"), F.sum("amount").alias("amount"))
    )
    return reactivated_from_days(days, min_gap_days, detected_at)


def reactivated_from_days(
    days: DataFrame, min_gap_days: int = DEFAULT_RULES.dormant_gap_over, detected_at: str | None = None
) -> DataFrame:
    """`reactivated` of transactions that are folded to accounts and days (txn_count, amount) already."""
    before = F.lag("transaction_date").over(
        Window.partitionBy("account_number").orderBy("transaction_date")
    )
    gaps = days.withColumn("previous_date", before).withColumn(
        "gap_days", F.datediff("transaction_date", "previous_date")
    )
    found = gaps.filter(F.col("gap_days") >= min_gap_days).select(
        "account_number", "previous_date", "transaction_date", "gap_days", "txn_count", "amount"
    )
    return _flag(found, REACTIVATED, detected_at)


def all_rules(
    txn: DataFrame, rules: RuleParams = DEFAULT_RULES, detected_at: str | None = None
) -> dict[str, DataFrame]:
    """The four alert tables by fraud type."""
    return {
        HIGH_VALUE: high_value(txn, rules.high_value_over, detected_at),
        BURST: burst(txn, rules.burst_width, rules.burst_over, detected_at),
        DAILY_SPEND: daily_spend(txn, rules.daily_spend_over, detected_at=detected_at),
        DORMANT: dormant(
            txn,
            rules.dormant_max_txns,
            rules.dormant_active_since,
            rules.dormant_gap_over,
            detected_at,
        ),
    }


def rules_with_days(
    txn: DataFrame, days: DataFrame, rules: RuleParams = DEFAULT_RULES, detected_at: str | None = None
) -> dict[str, DataFrame]:
    """`all_rules` with stored `day_totals` at hand: two rules read the transactions, two the days."""
    return {
        HIGH_VALUE: high_value(txn, rules.high_value_over, detected_at),
        BURST: burst(txn, rules.burst_width, rules.burst_over, detected_at),
        DAILY_SPEND: daily_spend_from_days(days, rules.daily_spend_over, detected_at=detected_at),
        DORMANT: dormant_from_activity(
            activity_from_days(days),
            rules.dormant_max_txns,
            rules.dormant_active_since,
            rules.dormant_gap_over,
            detected_at,
        ),
    }


def rule_totals(
    txn: DataFrame, rules: RuleParams = DEFAULT_RULES, burst_txn: DataFrame | None = None
) -> DataFrame:
    """fraud_type, alerts and their amount for each rule, without listing the alerts.

    The same figures as `alert_totals` of `all_rules`, from two passes instead of four:
    one fold to account and day serves three rules, bursts have windows of their own.
    `burst_txn` are other transactions for the burst rule.
    """
    amount = F.col("amount")
    high = amount > rules.high_value_over
    days = txn.groupBy("account_number", "transaction_date").agg(
        F.count_if(high).alias("high"),
        F.sum(F.when(high, amount)).alias("high_amount"),
        F.sum(F.when(F.col("transaction_type") == DEBIT, amount)).alias("spend"),
        F.count("transaction_id").alias("txn_count"),
    )
    over = F.col("spend") > rules.daily_spend_over
    accounts = days.groupBy("account_number").agg(
        F.sum("high").alias("high"),
        F.sum("high_amount").alias("high_amount"),
        F.count_if(over).alias("spend_days"),
        F.sum(F.when(over, F.col("spend"))).alias("spend"),
        F.min("transaction_date").alias("first_txn_date"),
        F.max("transaction_date").alias("last_txn_date"),
        F.sum("txn_count").alias("total_txns"),
    )
    quiet = _suspicious(rules.dormant_max_txns, rules.dormant_active_since, rules.dormant_gap_over)
    sums = accounts.agg(
        F.coalesce(F.sum("high"), F.lit(0)).alias("high"),
        F.sum("high_amount").alias("high_amount"),
        F.coalesce(F.sum("spend_days"), F.lit(0)).alias("spend_days"),
        F.sum("spend").alias("spend"),
        F.count_if(quiet).alias("dormant"),
    )
    found = {
        HIGH_VALUE: ("high", F.col("high_amount")),
        DAILY_SPEND: ("spend_days", F.col("spend")),
        DORMANT: ("dormant", F.lit(None).cast("double")),
    }
    entries = [
        F.struct(F.lit(name).alias("fraud_type"), F.col(n).alias("alerts"), total.alias("amount"))
        for name, (n, total) in found.items()
    ]
    bursts = burst(txn if burst_txn is None else burst_txn, rules.burst_width, rules.burst_over)
    listed = sums.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")
    return listed.unionByName(alert_totals({BURST: bursts}))


# Column that holds an alert's amount; the dormant rule has none.
_AMOUNTS = {HIGH_VALUE: "amount", BURST: "total_amount", DAILY_SPEND: "daily_spend"}


def alert_totals(alerts: Mapping[str, DataFrame]) -> DataFrame:
    """fraud_type, alerts and their amount (null without alerts, and for the dormant rule) per table."""
    parts = []
    for name, df in alerts.items():
        amount = F.sum(_AMOUNTS[name]) if name in _AMOUNTS else F.lit(None)
        counted = df.agg(F.count(F.lit(1)).alias("alerts"), amount.cast("double").alias("amount"))
        parts.append(counted.select(F.lit(name).alias("fraud_type"), "alerts", "amount"))
    return reduce(DataFrame.unionByName, parts)


# How each alert table maps to the common columns: event day, amount, number of transactions.
_COMMON = {
    HIGH_VALUE: ("transaction_date", "amount", "1L"),
    BURST: ("cast(window_start as date)", "total_amount", "txn_count"),
    DAILY_SPEND: ("transaction_date", "daily_spend", "txn_count"),
    DORMANT: ("last_txn_date", "cast(null as double)", "total_txns"),
}


def alerts_union(alerts: Mapping[str, DataFrame]) -> DataFrame:
    """All alerts on common columns; the rules have different grains."""
    parts = []
    for fraud_type, df in alerts.items():
        event_date, amount, txn_count = _COMMON[fraud_type]
        parts.append(
            df.selectExpr(
                "fraud_type",
                "account_number",
                f"{event_date} as event_date",
                f"{amount} as amount",
                f"{txn_count} as txn_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def alert_counts(alerts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule, also for a rule without alerts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("alerts")).select(F.lit(name).alias("fraud_type"), "alerts")
        for name, df in alerts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def alert_summary(alerts: Mapping[str, DataFrame]) -> DataFrame:
    """Alert counts per rule and a TOTAL row; every rule runs once."""
    return with_total(alert_counts(alerts))


def with_total(counts: DataFrame) -> DataFrame:
    """fraud_type and alerts of `counts`, with a TOTAL row."""
    rolled = counts.rollup("fraud_type").agg(F.sum("alerts").alias("alerts"))
    return rolled.select(F.coalesce("fraud_type", F.lit("TOTAL")).alias("fraud_type"), "alerts")
