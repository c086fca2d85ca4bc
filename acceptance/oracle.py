"""Plain SQL for every registered query, written independently of the operators.

Joins come before aggregates here and rounding is done on decimals, so that the
two sides share as little as possible.
"""

from __future__ import annotations

from acceptance.views import cte

ORACLE: dict[str, str] = {}

STAMP = "2026-01-01 00:00:00"

# ---- building blocks ---------------------------------------------------------------------


def _with(views: str, body: str, *more: str) -> str:
    return f"with {', '.join([cte(v) for v in views.split()] + list(more))} {body}"


def _avg(x: str) -> str:
    """Half-up rounding of the shortest decimal text, as the engine under test does."""
    return f"cast(round(cast(cast(avg({x}) as varchar) as decimal(38,12)), 2) as double)"


def _debit(x: str = "amount") -> str:
    return f"round(sum(case when transaction_type = 'DEBIT' then {x} else 0 end), 2)"


def _credit(x: str = "amount") -> str:
    return f"round(sum(case when transaction_type = 'CREDIT' then {x} else 0 end), 2)"


MONTHLY = f"""monthly as (
  select m.*, c.customer_id, c.customer_name, c.account_type, c.branch_id, c.city, c.state, c.status
  from (select account_number, cast(year(transaction_timestamp) as int) as txn_year,
               cast(month(transaction_timestamp) as int) as txn_month,
               round(sum(amount), 2) as monthly_spend, {_avg('amount')} as avg_transaction,
               round(max(amount), 2) as max_transaction, round(min(amount), 2) as min_transaction,
               count(transaction_id) as txn_count
        from txn where transaction_type = 'DEBIT' group by 1, 2, 3) m
  left join cust_orphan c on m.account_number = c.account_number)"""

KPI = f"""kpi as (
  select t.account_number, c.customer_id, c.customer_name, c.account_type, c.city as customer_city,
         c.state as customer_state, {_debit()} as total_debit, {_credit()} as total_credit,
         count(t.transaction_id) as total_transactions, {_avg('amount')} as avg_transaction_amount,
         round(max(amount), 2) as highest_transaction
  from txn t left join cust_orphan c on t.account_number = c.account_number
  group by all)"""

LINKED = """linked as (
  select c.branch_id, t.account_number, t.transaction_id, t.transaction_timestamp, t.transaction_type,
         t.amount, t.merchant_name, t.channel, t.transaction_date, b.branch_name, b.city, b.state, b.region
  from txn t left join cust_orphan c on t.account_number = c.account_number
       left join branch b on c.branch_id = b.branch_id)"""

BRANCHES = f"""branches as (
  select branch_id, branch_name, city, state, region, count(transaction_id) as total_transactions,
         round(sum(amount), 2) as total_amount, {_avg('amount')} as avg_transaction_amount,
         round(max(amount), 2) as highest_transaction, count(distinct account_number) as unique_customers,
         {_debit()} as total_debit, {_credit()} as total_credit
  from linked group by branch_id, branch_name, city, state, region)"""

REGIONS = """regions as (
  select region, count(transaction_id) as total_transactions, round(sum(amount), 2) as total_amount,
         count(distinct account_number) as unique_customers, count(distinct branch_id) as total_branches
  from linked group by region)"""

HIGH = "high as (select *, 'HIGH_VALUE_TRANSACTION' as fraud_type from txn where amount > 490000)"

BURST = """burst as (
  select account_number, count(transaction_id) as txn_count, sum(amount) as total_amount,
         'RAPID_BURST_TRANSACTIONS' as fraud_type,
         time_bucket(interval 10 minute, transaction_timestamp) as window_start,
         time_bucket(interval 10 minute, transaction_timestamp) + interval 10 minute as window_end
  from evt group by account_number, time_bucket(interval 10 minute, transaction_timestamp)
  having count(transaction_id) > 1)"""

SPEND = """spend as (
  select account_number, transaction_date, sum(amount) as daily_spend, count(transaction_id) as txn_count,
         'HIGH_DAILY_SPEND' as fraud_type
  from txn where transaction_type = 'DEBIT' group by account_number, transaction_date
  having sum(amount) > 400000)"""

ACTIVITY = """activity as (
  select account_number, min(transaction_date) as first_txn_date, max(transaction_date) as last_txn_date,
         count(transaction_id) as total_txns
  from txn group by account_number)"""

DORMANT = """dormant as (
  select *, cast(date_diff('day', first_txn_date, last_txn_date) as int) as gap_days,
         'DORMANT_ACCOUNT_ACTIVE' as fraud_type
  from activity
  where total_txns <= 10 and last_txn_date >= date '2001-06-01'
    and date_diff('day', first_txn_date, last_txn_date) > 180)"""

RULES = (HIGH, BURST, SPEND, ACTIVITY, DORMANT)

CHECKED = """checked as (
  select *, case when transaction_id is null then 'Null transaction_id'
                 when account_number is null then 'Null account_number'
                 when amount is null then 'Null amount'
                 when amount < 0 then 'Negative amount'
                 when try_cast(transaction_timestamp as timestamp) is null then 'Invalid timestamp' end as reason
  from txn_dirty)"""

SILVER_TXN = """silver_txn as (
  select distinct transaction_id, account_number,
         cast(transaction_timestamp as timestamp) as transaction_timestamp,
         upper(trim(transaction_type)) as transaction_type, amount, trim(merchant_name) as merchant_name,
         upper(trim(channel)) as channel, upper(trim(city)) as city,
         cast(cast(transaction_timestamp as timestamp) as date) as transaction_date
  from checked where reason is null and amount > 0)"""

SILVER_CUST = """silver_cust as (
  select distinct customer_id, account_number, customer_name, upper(trim(account_type)) as account_type,
         branch_id, upper(trim(city)) as city, upper(trim(state)) as state, upper(trim(status)) as status,
         upper(trim(status)) = 'ACTIVE' as is_active
  from cust_dirty
  where customer_id is not null and account_number is not null and account_type is not null)"""

SILVER_BRANCH = """silver_branch as (
  select distinct branch_id, branch_name, upper(trim(city)) as city, upper(trim(state)) as state,
         upper(trim(region)) as region
  from branch_dirty where branch_id is not null and branch_name is not null)"""

# ---- scans, sources, sinks ---------------------------------------------------------------

ORACLE["scan_csv"] = _with("txn", "select * exclude (transaction_date) from txn")
ORACLE["scan_table"] = "select * from orders"
ORACLE["sink_overwrite"] = _with("cust_orphan", "select * from cust_orphan")
ORACLE["sink_partitioned"] = _with("txn", "select * from txn")
ORACLE["sink_partitioned_rebalance"] = _with("txn", "select * from txn")
ORACLE["sink_merge_schema"] = _with(
    "cust", "select * replace (cast(null as varchar) as state), status = 'ACTIVE' as is_active from cust"
)
ORACLE["sink_if_nonempty"] = _with("txn", "select * from high", HIGH)
ORACLE["sink_warehouse"] = _with(
    "txn cust_orphan",
    f"""select cast(account_number as varchar) as ACCOUNT_NUMBER, txn_year as TXN_YEAR, txn_month as TXN_MONTH,
       monthly_spend as MONTHLY_SPEND, avg_transaction as AVG_TRANSACTION, max_transaction as MAX_TRANSACTION,
       min_transaction as MIN_TRANSACTION, txn_count as TXN_COUNT, cast(customer_id as varchar) as CUSTOMER_ID,
       customer_name as CUSTOMER_NAME, account_type as ACCOUNT_TYPE, cast(branch_id as varchar) as BRANCH_ID,
       city as CITY, state as STATE, status as STATUS, '{STAMP}' as GOLD_LOAD_TIMESTAMP from monthly""",
    MONTHLY,
)
ORACLE["scan_warehouse"] = _with(
    "txn evt",
    """select 'FRAUD_HIGH_VALUE' as table_name, count(*) as alerts, round(sum(amount), 2) as amount from high
       union all select 'FRAUD_BURST', count(*), round(sum(total_amount), 2) from burst
       union all select 'FRAUD_HIGH_SPEND', count(*), round(sum(daily_spend), 2) from spend""",
    HIGH,
    BURST,
    SPEND,
)
ORACLE["verify_row_counts"] = _with(
    "txn cust_orphan branch evt",
    "select table_name, n as source_rows, n as target_rows, true as matches from ("
    + " union all ".join(
        f"select '{table}' as table_name, count(*) as n from {name}"
        for table, name in {
            "CUSTOMER_KPI": "kpi",
            "CUSTOMER_MONTHLY": "monthly",
            "BRANCH_SUMMARY": "branches",
            "REGION_SUMMARY": "regions",
            "FRAUD_HIGH_VALUE": "high",
            "FRAUD_BURST": "burst",
            "FRAUD_HIGH_SPEND": "spend",
            "FRAUD_DORMANT": "dormant",
        }.items()
    )
    + ") counted",
    KPI,
    MONTHLY,
    LINKED,
    BRANCHES,
    REGIONS,
    *RULES,
)
ORACLE["table_row_counts"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {name}"
    for name in ("customer", "nation", "orders", "events")
)
ORACLE["conform_contract"] = _with(
    "evt",
    f"""select cast(account_number as varchar) as account_number, txn_count, total_amount, fraud_type,
       '{STAMP}' as fraud_detected_at, cast(window_start as varchar) as window_start,
       cast(window_end as varchar) as window_end from burst""",
    BURST,
)
ORACLE["warehouse_form"] = _with(
    "txn",
    f"""select cast(transaction_id as varchar) as TRANSACTION_ID, cast(account_number as varchar) as ACCOUNT_NUMBER,
       cast(transaction_timestamp as varchar) as TRANSACTION_TIMESTAMP, transaction_type as TRANSACTION_TYPE,
       amount as AMOUNT, merchant_name as MERCHANT_NAME, channel as CHANNEL, city as CITY,
       '{STAMP}' as BRONZE_LOAD_TIMESTAMP, 'raw/transactions' as SOURCE_FILE,
       '{STAMP}' as SILVER_LOAD_TIMESTAMP, cast(transaction_date as varchar) as TRANSACTION_DATE,
       fraud_type as FRAUD_TYPE, '{STAMP}' as FRAUD_DETECTED_AT from high""",
    HIGH,
)

# ---- projections and filters -------------------------------------------------------------

ORACLE["project_columns"] = _with(
    "txn",
    "select transaction_id, account_number, amount, transaction_timestamp, fraud_type from high",
    HIGH,
)
ORACLE["add_audit_columns"] = _with(
    "cust", f"select *, '{STAMP}' as bronze_load_timestamp, 'raw/customer' as source_file from cust"
)
ORACLE["upper_column_names"] = _with(
    "txn",
    """select transaction_id as TRANSACTION_ID, account_number as ACCOUNT_NUMBER,
       transaction_timestamp as TRANSACTION_TIMESTAMP, transaction_type as TRANSACTION_TYPE, amount as AMOUNT,
       merchant_name as MERCHANT_NAME, channel as CHANNEL, city as CITY, transaction_date as TRANSACTION_DATE
       from txn""",
)
ORACLE["export_normalize"] = _with(
    "txn",
    """select transaction_id, cast(transaction_timestamp as varchar) as transaction_timestamp,
       cast(transaction_date as varchar) as transaction_date, amount,
       '{"merchant_name":"' || merchant_name || '","city":"' || city || '"}' as place,
       '["' || transaction_type || '","' || channel || '"]' as tags from txn""",
)
ORACLE["describe_schema"] = _with(
    "txn_dirty",
    " union all ".join(
        f"select cast({i} as int) as position, '{name}' as column_name, '{kind}' as data_type, "
        f"count({name}) as non_null from txn_dirty"
        for i, (name, kind) in enumerate(
            {
                "transaction_id": "bigint",
                "account_number": "bigint",
                "transaction_timestamp": "string",
                "transaction_type": "string",
                "amount": "double",
                "merchant_name": "string",
                "channel": "string",
                "city": "string",
            }.items(),
            start=1,
        )
    ),
)
ORACLE["filter_nulls"] = _with(
    "txn_dirty", "select * from txn_dirty where amount is null and account_number is not null"
)
ORACLE["filter_domain"] = _with(
    "cust_dirty",
    "select * from cust_dirty where account_type not in ('SAVINGS', 'CURRENT', 'SALARY', 'NRI')",
)
ORACLE["filter_bad_timestamp"] = _with(
    "txn_dirty", "select * from txn_dirty where try_cast(transaction_timestamp as timestamp) is null"
)
ORACLE["filter_future"] = _with(
    "txn_dirty",
    "select * from txn_dirty where try_cast(transaction_timestamp as timestamp) > timestamp '2000-01-01'",
)

# ---- data quality and layers -------------------------------------------------------------


def _metrics(view: str, **metrics: str) -> str:
    return _with(
        view,
        " union all ".join(
            f"select '{name}' as metric, cast({sql} as bigint) as value from {view}" for name, sql in metrics.items()
        ),
    )


def _surplus(key: str) -> str:
    return f"count(*) - count(distinct {key}) - max(case when {key} is null then 1 else 0 end)"


ORACLE["dq_customer"] = _metrics(
    "cust_dirty",
    total_records="count(*)",
    null_customer_id="count(*) - count(customer_id)",
    null_account_number="count(*) - count(account_number)",
    duplicate_account_number=_surplus("account_number"),
    invalid_account_type="count(*) filter (account_type not in ('SAVINGS', 'CURRENT', 'SALARY', 'NRI'))",
)
ORACLE["dq_branch"] = _metrics(
    "branch_dirty",
    total_records="count(*)",
    null_branch_id="count(*) - count(branch_id)",
    null_branch_name="count(*) - count(branch_name)",
    duplicate_branch_id=_surplus("branch_id"),
    invalid_region="count(*) filter (region not in ('North', 'South', 'East', 'West', 'Central'))",
)
ORACLE["dq_transaction"] = _metrics(
    "txn_dirty",
    total_records="count(*)",
    null_transaction_id="count(*) - count(transaction_id)",
    null_account_number="count(*) - count(account_number)",
    null_amount="count(*) - count(amount)",
    duplicate_transaction_id=_surplus("transaction_id"),
    negative_amount="count(*) filter (amount < 0)",
    future_transaction_timestamp=(
        "count(*) filter (try_cast(transaction_timestamp as timestamp) > timestamp '2000-01-01')"
    ),
    invalid_transaction_type="count(*) filter (transaction_type not in ('DEBIT', 'CREDIT'))",
    invalid_channel="count(*) filter (channel not in ('UPI', 'ATM', 'CARD', 'NETBANKING'))",
)
ORACLE["dq_duplicates"] = _with(
    "txn_dirty",
    """select (select count(*) from txn_dirty) as total_records, count(*) as distinct_records,
       (select count(*) from txn_dirty) - count(*) as duplicate_records
       from (select distinct transaction_id from txn_dirty) ids""",
)
ORACLE["rejected_customer"] = _with(
    "cust_dirty",
    f"""select *, 'Null in critical field' as rejection_reason, '{STAMP}' as rejected_timestamp from cust_dirty
       where customer_id is null or account_number is null or account_type is null""",
)
ORACLE["rejected_branch"] = _with(
    "branch_dirty",
    f"""select *, 'Null in critical field' as rejection_reason, '{STAMP}' as rejected_timestamp from branch_dirty
       where branch_id is null or branch_name is null""",
)
ORACLE["rejected_txn"] = _with(
    "txn_dirty",
    f"""select * exclude (reason), reason as rejection_reason, '{STAMP}' as rejected_timestamp
       from checked where reason is not null""",
    CHECKED,
)
ORACLE["rejected_txn_strict"] = _with(
    "txn_dirty",
    """select * exclude (reason), coalesce(reason, 'Zero amount') as rejection_reason
       from checked where reason is not null or amount = 0""",
    CHECKED,
)
# Rows without an id are different rows; the one that stays is the first in column order.
ORACLE["dedup_key"] = _with(
    "txn_dirty",
    """select * from txn_dirty
       qualify row_number() over (partition by transaction_id
         order by account_number nulls first, transaction_timestamp nulls first, transaction_type nulls first,
                  amount nulls first, merchant_name nulls first, channel nulls first, city nulls first) = 1""",
)
ORACLE["standardize_text"] = _with(
    "txn_dirty",
    """select * replace (upper(trim(city)) as city, upper(trim(transaction_type)) as transaction_type,
       upper(trim(channel)) as channel, trim(merchant_name) as merchant_name) from txn_dirty""",
)
ORACLE["silver_customer"] = _with("cust_dirty", "select * from silver_cust", SILVER_CUST)
ORACLE["silver_branch"] = _with("branch_dirty", "select * from silver_branch", SILVER_BRANCH)
ORACLE["silver_txn"] = _with("txn_dirty", "select * from silver_txn", CHECKED, SILVER_TXN)


def _raw(view: str, entity: str, casts: dict[str, str]) -> str:
    replaced = ", ".join(f"{sql} as {name}" for name, sql in casts.items())
    return _with(
        view,
        f"""select * replace ({replaced}), '{STAMP}' as bronze_load_timestamp, 'raw/{entity}' as source_file,
        cast(null as varchar) as malformed_row from {view}""",
    )


ORACLE["bronze_customer"] = _raw(
    "cust_dirty",
    "customer",
    {c: f"cast({c} as varchar)" for c in ("customer_id", "account_number", "branch_id")},
)
ORACLE["bronze_branch"] = _raw("branch_dirty", "branch", {"branch_id": "cast(branch_id as varchar)"})
ORACLE["bronze_txn"] = _raw(
    "txn_dirty",
    "transactions",
    {c: f"cast({c} as varchar)" for c in ("transaction_id", "account_number", "amount")},
)

# ---- joins and summaries -----------------------------------------------------------------

ORACLE["customer_monthly"] = _with("txn cust_orphan", "select * from monthly", MONTHLY)
ORACLE["customer_kpi"] = _with("txn cust_orphan", "select * from kpi", KPI)
ORACLE["txn_branch_link"] = _with("txn cust_orphan branch", "select * from linked", LINKED)
ORACLE["branch_summary"] = _with("txn cust_orphan branch", "select * from branches", LINKED, BRANCHES)
ORACLE["region_summary"] = _with("txn cust_orphan branch", "select * from regions", LINKED, REGIONS)
ORACLE["account_activity"] = _with("txn", "select * from activity", ACTIVITY)
ORACLE["agg_count_col"] = _with(
    "txn_dirty",
    "select channel, count(transaction_id) as ids, count(amount) as amounts from txn_dirty group by channel",
)

# ---- alert rules -------------------------------------------------------------------------

ORACLE["fraud_high_value"] = _with("txn", f"select *, '{STAMP}' as fraud_detected_at from high", HIGH)
ORACLE["fraud_burst"] = _with("evt", "select * from burst", BURST)
ORACLE["fraud_daily_spend"] = _with("txn", "select * from spend", SPEND)
ORACLE["fraud_dormant"] = _with("txn", "select * from dormant", ACTIVITY, DORMANT)
ORACLE["fraud_burst_sliding"] = _with(
    "evt",
    """select distinct account_number, transaction_timestamp - interval 10 minute as window_start,
       transaction_timestamp as window_end, txn_count, total_amount,
       'SLIDING_BURST_TRANSACTIONS' as fraud_type
       from (select *, count(transaction_id) over recent as txn_count, sum(amount) over recent as total_amount
             from evt window recent as (partition by account_number order by transaction_timestamp
                   range between interval 10 minute preceding and current row)) counted
       where txn_count > 1""",
)
ORACLE["fraud_dormant_gap"] = _with(
    "txn",
    """select account_number, previous_date, transaction_date,
       cast(date_diff('day', previous_date, transaction_date) as int) as gap_days, txn_count, amount,
       'REACTIVATED_AFTER_GAP' as fraud_type
       from (select account_number, transaction_date, count(transaction_id) as txn_count, sum(amount) as amount,
                    lag(transaction_date) over (partition by account_number order by transaction_date) as previous_date
             from txn group by account_number, transaction_date) days
       where date_diff('day', previous_date, transaction_date) >= 180""",
)

COUNTS = """counts as (
  select 'HIGH_VALUE_TRANSACTION' as fraud_type, 'High Value' as title, count(*) as alerts,
         round(sum(amount), 2) as amount from high
  union all select 'RAPID_BURST_TRANSACTIONS', 'Rapid Burst', count(*), round(sum(total_amount), 2) from burst
  union all select 'HIGH_DAILY_SPEND', 'High Daily Spend', count(*), round(sum(daily_spend), 2) from spend
  union all select 'DORMANT_ACCOUNT_ACTIVE', 'Dormant Active', count(*), cast(null as double) from dormant)"""

ORACLE["fraud_summary"] = _with(
    "txn evt",
    """select fraud_type, alerts from counts
       union all select 'TOTAL', cast(sum(alerts) as bigint) from counts""",
    *RULES,
    COUNTS,
)
ORACLE["fraud_alerts_all"] = _with(
    "txn evt",
    """select fraud_type, account_number, transaction_date as event_date, amount, cast(1 as bigint) as txn_count
       from high
       union all select fraud_type, account_number, cast(window_start as date), total_amount, txn_count from burst
       union all select fraud_type, account_number, transaction_date, daily_spend, txn_count from spend
       union all select fraud_type, account_number, last_txn_date, null, total_txns from dormant""",
    *RULES,
)

# ---- reporting datasets ------------------------------------------------------------------


def _crore(x: str) -> str:
    return f"printf('₹%.1f Cr', {x} / 1e7)"


def _money(x: str) -> str:
    return f"'₹' || format('{{:,.0f}}', {x})"


ORACLE["cards_overview"] = _with(
    "txn cust cust_orphan evt",
    f"""select 'total_customers' as card, cast(count(*) as double) as value, format('{{:,}}', count(*)) as display
       from cust
       union all select 'total_transactions', cast(sum(total_transactions) as double),
         format('{{:,}}', cast(sum(total_transactions) as bigint)) from kpi
       union all select 'total_debit', round(sum(total_debit), 2), {_crore('sum(total_debit)')} from kpi
       union all select 'total_alerts', cast(sum(alerts) as double), cast(cast(sum(alerts) as bigint) as varchar)
         from counts""",
    KPI,
    *RULES,
    COUNTS,
)
ORACLE["top_customers_debit"] = _with(
    "txn cust_orphan",
    """select customer_name, account_type, total_debit from kpi
       order by total_debit desc, account_number limit 10""",
    KPI,
)
ORACLE["txns_by_account_type"] = _with(
    "txn cust_orphan",
    """select account_type, cast(sum(total_transactions) as bigint) as total from kpi
       where account_type is not null group by account_type""",
    KPI,
)
ORACLE["top_states_debit"] = _with(
    "txn cust_orphan",
    """select customer_state, round(sum(total_debit), 2) as total_debit from kpi
       where customer_state is not null group by customer_state
       order by total_debit desc, customer_state limit 10""",
    KPI,
)
ORACLE["debit_credit_by_account_type"] = _with(
    "txn cust_orphan",
    """select account_type, 'Debit' as type, round(sum(total_debit), 2) as amount from kpi
       where account_type is not null group by account_type
       union all select account_type, 'Credit', round(sum(total_credit), 2) from kpi
       where account_type is not null group by account_type""",
    KPI,
)
ORACLE["cards_fraud"] = _with(
    "txn evt",
    f"""select title as rule, alerts, amount,
       case when title = 'Dormant Active' then 'Suspicious' else {_crore('coalesce(amount, 0)')} end as display
       from counts""",
    *RULES,
    COUNTS,
)
ORACLE["fraud_counts_by_type"] = _with(
    "txn evt", "select title as type, alerts as count from counts", *RULES, COUNTS
)
ORACLE["high_value_by_channel"] = _with(
    "txn",
    "select channel, count(transaction_id) as count from high where channel is not null group by channel",
    HIGH,
)
ORACLE["preview_high_value"] = _with(
    "txn",
    f"""select transaction_id, account_number, {_money('amount')} as amount, channel, transaction_timestamp
       from high order by transaction_id limit 20""",
    HIGH,
)
ORACLE["cards_branch"] = _with(
    "txn cust_orphan branch",
    f"""select 'total_branches' as card, cast(count(*) as double) as value, cast(count(*) as varchar) as display
       from branch
       union all select 'total_transactions', cast(sum(total_transactions) as double),
         format('{{:,}}', cast(sum(total_transactions) as bigint)) from branches
       union all select 'total_amount', round(sum(total_amount), 2), {_crore('sum(total_amount)')} from branches""",
    LINKED,
    BRANCHES,
)
ORACLE["top_branches_amount"] = _with(
    "txn cust_orphan branch",
    "select * from branches order by total_amount desc, branch_id limit 10",
    LINKED,
    BRANCHES,
)
ORACLE["region_ranked"] = _with(
    "txn cust_orphan branch",
    """select *, round(total_amount / nullif((select sum(total_amount) from regions), 0), 4) as amount_share
       from regions order by total_amount desc""",
    LINKED,
    REGIONS,
)
ORACLE["region_txn_vs_customers"] = _with(
    "txn cust_orphan branch",
    """select region, 'total_transactions' as metric, total_transactions as value from regions
       union all select region, 'unique_customers', unique_customers from regions""",
    LINKED,
    REGIONS,
)
ORACLE["cards_monthly"] = _with(
    "txn cust_orphan",
    f"""select 'monthly_records' as card, cast(count(*) as double) as value, format('{{:,}}', count(*)) as display
       from monthly
       union all select 'avg_monthly_spend', {_avg('monthly_spend')}, {_money('avg(monthly_spend)')} from monthly
       union all select 'max_monthly_spend', max(monthly_spend), {_money('max(monthly_spend)')} from monthly""",
    MONTHLY,
)
ORACLE["monthly_trend"] = _with(
    "txn cust_orphan",
    """select txn_year, txn_month, account_type, round(sum(monthly_spend), 2) as total_spend,
       format('{}-{:02d}', txn_year, txn_month) as period
       from monthly where account_type is not null group by txn_year, txn_month, account_type""",
    MONTHLY,
)
ORACLE["yearly_spend"] = _with(
    "txn cust_orphan",
    """select cast(txn_year as varchar) as txn_year, round(sum(monthly_spend), 2) as total_spend
       from monthly group by txn_year""",
    MONTHLY,
)
ORACLE["top_monthly_spenders"] = _with(
    "txn cust_orphan",
    f"""select customer_name, account_type, txn_year, txn_month, {_money('monthly_spend')} as monthly_spend
       from (select * from monthly
             order by monthly_spend desc, account_number, txn_year, txn_month limit 10) best""",
    MONTHLY,
)

# ---- incremental, audit, streams ---------------------------------------------------------

ORACLE["incremental_load"] = _with("txn", "select * from txn")
ORACLE["incremental_load_late"] = _with("txn", "select * from txn")
ORACLE["incremental_load_stream"] = _with("txn", "select * from txn")

# Up to some thousand accounts of a branch the sketches are exact.
ORACLE["distinct_accounts_span"] = _with(
    "txn cust_orphan",
    """select c.branch_id, count(distinct t.account_number) as distinct_accounts
       from txn t left join cust_orphan c on t.account_number = c.account_number
       where transaction_date between date '1994-06-30' and date '1998-03-31' group by c.branch_id""",
)
ORACLE["incremental_load_moved"] = _with(
    "txn",
    """select * replace (
         cast(case when transaction_id % 10 < 2 then date_trunc('month', transaction_date) + interval 7 month
              else date_trunc('month', transaction_date) end as date) as transaction_date,
         case when transaction_id % 10 < 2 then amount + 1 else amount end as amount)
       from txn""",
)
# A corrected row takes the place of the first one; a row that was damaged at first comes in with its correction.
ORACLE["daily_incremental"] = _with(
    "txn_delivered",
    f"""select fraud_type, cast(account_number as varchar) as account_number, event_date, round(amount, 2) as amount, txn_count from (
      select 'HIGH_VALUE_TRANSACTION' as fraud_type, account_number, day as event_date, amount, cast(1 as bigint) as txn_count
      from last where amount > 490000
      union all
      select 'RAPID_BURST_TRANSACTIONS', account_number, cast(any_value(day) as date), sum(amount), count(*)
      from last group by account_number, time_bucket(interval 10 minute, moment) having count(*) > 1
      union all
      select 'HIGH_DAILY_SPEND', account_number, day, sum(amount), count(*)
      from last where transaction_type = 'DEBIT' group by account_number, day having sum(amount) > 400000
      union all
      select 'DORMANT_ACCOUNT_ACTIVE', account_number, max(day), null, count(*) from last group by account_number
      having count(*) <= 10 and max(day) >= date '2001-06-01' and date_diff('day', min(day), max(day)) > 180
      union all
      select 'KPI', account_number, null, {_debit()}, count(*) from last group by account_number) found""",
    """parsed as (
      select transaction_id, account_number, upper(trim(transaction_type)) as transaction_type, amount,
        try_cast(transaction_timestamp as timestamp) as moment, 0 as later from txn_delivered
      union all
      select transaction_id, account_number, upper(trim(transaction_type)), amount * 2,
        cast(corrected_timestamp as timestamp), 1 from txn_delivered where corrected)""",
    """last as (
      select *, cast(moment as date) as day from parsed where transaction_id is not null and amount > 0 and moment is not null
      qualify row_number() over (partition by transaction_id order by later desc) = 1)""",
)

# Step -> (rows in, rows out, rejected), each a table or a count, of a run over the damaged files.
AUDIT = {
    "bronze_customer": ("cust_dirty", "cust_dirty", None),
    "bronze_branch": ("branch_dirty", "branch_dirty", None),
    "bronze_transactions": ("txn_dirty", "txn_dirty", None),
    "silver_customer": (
        "cust_dirty",
        "silver_cust",
        "cust_dirty where customer_id is null or account_number is null or account_type is null",
    ),
    "silver_branch": (
        "branch_dirty",
        "silver_branch",
        "branch_dirty where branch_id is null or branch_name is null",
    ),
    "silver_transactions": ("txn_dirty", "silver_txn", "checked where reason is not null"),
}
_GOLD_STEPS = {
    "fraud_alerts_high_value": ("FRAUD_HIGH_VALUE", "silver_txn where amount > 490000"),
    "fraud_alerts_burst": (
        "FRAUD_BURST",
        """(select 1 from silver_txn group by account_number,
           time_bucket(interval 10 minute, transaction_timestamp) having count(*) > 1) found""",
    ),
    "fraud_alerts_high_daily_spend": (
        "FRAUD_HIGH_SPEND",
        """(select 1 from silver_txn where transaction_type = 'DEBIT' group by account_number, transaction_date
           having sum(amount) > 400000) found""",
    ),
    "fraud_alerts_dormant": (
        "FRAUD_DORMANT",
        """(select 1 from silver_txn group by account_number
           having count(*) <= 10 and max(transaction_date) >= date '2001-06-01'
              and date_diff('day', min(transaction_date), max(transaction_date)) > 180) found""",
    ),
    "customer_summary_monthly": (
        "CUSTOMER_MONTHLY",
        """(select distinct account_number, year(transaction_date), month(transaction_date) from silver_txn
           where transaction_type = 'DEBIT') found""",
    ),
    "customer_summary_overall_kpi": (
        "CUSTOMER_KPI",
        "(select distinct account_number from silver_txn) found",
    ),
    "branch_summary_by_branch": ("BRANCH_SUMMARY", "(select distinct branch_id from silver_linked) found"),
    "branch_summary_by_region": ("REGION_SUMMARY", "(select distinct region from silver_linked) found"),
}
for _step, (_table, _rows) in _GOLD_STEPS.items():
    AUDIT[_step] = ("silver_txn", _rows, None)
    AUDIT[f"warehouse_{_table.lower()}"] = (_rows, _rows, None)

SILVER_LINKED = """silver_linked as (
  select c.branch_id, b.region from silver_txn t left join silver_cust c on t.account_number = c.account_number
       left join silver_branch b on c.branch_id = b.branch_id)"""


def _count(rows: str | None) -> str:
    return f"(select count(*) from {rows})" if rows else "cast(0 as bigint)"


_NOW = ORACLE["dq_transaction"].replace("timestamp '2000-01-01'", "localtimestamp")
ORACLE["daily_quality_log"] = " union all ".join(
    f"""select '{entity}' as entity, metric, value, '{STAMP}' as run_timestamp from ({reports}) {entity}_report
        union all select '{entity}', 'malformed_rows', 0, '{STAMP}'"""
    for entity, reports in {
        "customer": ORACLE["dq_customer"],
        "branch": ORACLE["dq_branch"],
        "transactions": _NOW,
    }.items()
)
ORACLE["daily_verification"] = _with(
    "txn_dirty cust_dirty branch_dirty",
    " union all ".join(
        f"""select '{table}' as table_name, {_count(rows)} as source_rows, {_count(rows)} as target_rows,
            true as matches, '{STAMP}' as run_timestamp"""
        for table, rows in _GOLD_STEPS.values()
    ),
    CHECKED,
    SILVER_TXN,
    SILVER_CUST,
    SILVER_BRANCH,
    SILVER_LINKED,
)
ORACLE["rejected_malformed"] = _with(
    "txn",
    """select cast(transaction_id as varchar) as transaction_id, 'Malformed row' as rejection_reason,
       concat_ws(',', transaction_id, account_number, cast(transaction_date as varchar), transaction_type,
         cast(amount as varchar), 'Shop', channel) || case channel when 'ATM' then ',' || city || ',more' else '' end
         as malformed_row
       from txn where channel in ('ATM', 'CARD')""",
)
ORACLE["audit_log"] = _with(
    "txn_dirty cust_dirty branch_dirty",
    " union all ".join(
        f"""select '{step}' as step, {_count(rows_in)} as rows_in, {_count(rows_out)} as rows_out,
            {_count(rejected)} as rows_rejected, '{STAMP}' as run_timestamp"""
        for step, (rows_in, rows_out, rejected) in AUDIT.items()
    ),
    CHECKED,
    SILVER_TXN,
    SILVER_CUST,
    SILVER_BRANCH,
    SILVER_LINKED,
)
ORACLE["stream_high_value"] = ORACLE["fraud_high_value"]
# Only what the final watermark has closed is emitted.
ORACLE["stream_burst"] = _with(
    "evt",
    """select * from burst
       where window_end <= (select max(transaction_timestamp) from evt) - interval 10 minute""",
    BURST,
)
ORACLE["stream_daily_spend"] = _with(
    "txn",
    """select * from spend
       where transaction_date + interval 1 day
             <= (select max(transaction_timestamp) from txn where transaction_type = 'DEBIT') - interval 1 hour""",
    SPEND,
)
ORACLE["stream_dedup"] = _with("evt", "select * from evt")
ORACLE["stream_burst_current"] = ORACLE["fraud_burst"]
ORACLE["stream_daily_spend_current"] = ORACLE["fraud_daily_spend"]
ORACLE["stream_reactivated"] = ORACLE["fraud_dormant_gap"]
ORACLE["stream_burst_sliding"] = ORACLE["fraud_burst_sliding"]

# Days that are closed by what came first, and the watermark when all has come.
LATER_FIRST = (
    """came as (select *, transaction_date between date '1994-06-30' and date '1998-03-31' as first from txn)""",
    """marks as (
      select max(transaction_timestamp) filter (where first) - interval 1 hour as before,
             max(transaction_timestamp) - interval 1 hour as last from came)""",
    """judged as (
      select came.*, not first and transaction_date + interval 1 day <= before as late,
             transaction_date + interval 1 day > last as open from came, marks)""",
)
ORACLE["stream_late_rows"] = _with(
    "txn", "select transaction_id, account_number, amount, transaction_date, 'late' as kind from judged where late", *LATER_FIRST
)
ORACLE["stream_row_account"] = _with(
    "txn",
    """select count(*) as came, count(*) filter (where late) as late, cast(0 as bigint) as untimed,
       count(*) filter (where not late and not open) as closed, count(*) filter (where not late and open) as open from judged""",
    *LATER_FIRST,
)
