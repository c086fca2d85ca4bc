"""Views that give the shared test tables the shape of accounts, branches and transactions.

One SQL text serves both engines: base tables are written in braces, which Spark
binds to frames and the other engine gets as plain names. The modulus terms
decide which rows are damaged or copied; no row of a base table is left out.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TXN = """
select o_orderkey as transaction_id,
       o_custkey as account_number,
       o_orderdate as transaction_timestamp,
       case o_orderstatus when 'F' then 'DEBIT' when 'O' then 'CREDIT' else 'PENDING' end as transaction_type,
       o_totalprice as amount,
       concat('Merchant ', cast(o_custkey % 20 as string)) as merchant_name,
       case o_orderpriority when '1-URGENT' then 'UPI' when '2-HIGH' then 'ATM' when '3-MEDIUM' then 'CARD'
            when '4-NOT SPECIFIED' then 'NETBANKING' else 'CHEQUE' end as channel,
       concat('CITY_', cast(o_orderkey % 30 as string)) as city,
       cast(o_orderdate as date) as transaction_date
from {orders}
"""

TXN_DIRTY = """
select case when o_orderkey % 97 = 0 then null else o_orderkey end as transaction_id,
       case when o_orderkey % 89 = 1 then null else o_custkey end as account_number,
       case when o_orderkey % 71 = 5 then 'bad' else cast(o_orderdate as string) end as transaction_timestamp,
       case when o_orderstatus = 'F' then ' debit ' when o_orderstatus = 'O' then 'CREDIT' else 'PENDING' end as transaction_type,
       case when o_orderkey % 83 = 2 then null when o_orderkey % 79 = 3 then -o_totalprice
            when o_orderkey % 73 = 4 then cast(0 as double) else o_totalprice end as amount,
       concat('  Merchant ', cast(o_custkey % 20 as string), ' ') as merchant_name,
       case when o_orderkey % 3 = 0 then 'upi' when o_orderkey % 3 = 1 then ' ATM' else null end as channel,
       concat(' city_', cast(o_orderkey % 30 as string), ' ') as city
from (select * from {orders} union all select * from {orders} where o_orderkey % 67 = 6) base
"""

CUST = """
select c_custkey as customer_id,
       c_custkey as account_number,
       c_name as customer_name,
       case c_mktsegment when 'AUTOMOBILE' then 'SAVINGS' when 'BUILDING' then 'CURRENT' when 'FURNITURE' then 'SALARY'
            when 'HOUSEHOLD' then 'NRI' else 'OTHER' end as account_type,
       c_nationkey as branch_id,
       concat('CITY_', cast(c_custkey % 30 as string)) as city,
       concat('STATE_', cast(c_custkey % 12 as string)) as state,
       case when c_acctbal >= 0 then 'ACTIVE' else 'DORMANT' end as status
from {customer}
"""

# A tenth of the customers hold an account number no transaction has.
CUST_ORPHAN = """
select c_custkey as customer_id,
       case when c_custkey % 10 = 0 then -c_custkey else c_custkey end as account_number,
       c_name as customer_name,
       case c_mktsegment when 'AUTOMOBILE' then 'SAVINGS' when 'BUILDING' then 'CURRENT' when 'FURNITURE' then 'SALARY'
            when 'HOUSEHOLD' then 'NRI' else 'OTHER' end as account_type,
       c_nationkey as branch_id,
       concat('CITY_', cast(c_custkey % 30 as string)) as city,
       concat('STATE_', cast(c_custkey % 12 as string)) as state,
       case when c_acctbal >= 0 then 'ACTIVE' else 'DORMANT' end as status
from {customer}
"""

CUST_DIRTY = """
select case when c_custkey % 31 = 0 then null else c_custkey end as customer_id,
       case when c_custkey % 29 = 1 then null else c_custkey end as account_number,
       c_name as customer_name,
       case when c_custkey % 23 = 2 then null when c_custkey % 4 = 0 then 'savings' when c_custkey % 4 = 1 then 'CURRENT '
            else 'NRI' end as account_type,
       c_nationkey as branch_id,
       concat(' city_', cast(c_custkey % 30 as string)) as city,
       concat('state_', cast(c_custkey % 12 as string), '  ') as state,
       case when c_acctbal >= 0 then ' active' else 'Dormant' end as status
from (select * from {customer} union all select * from {customer} where c_custkey % 7 = 1) base
"""

BRANCH = """
select n_nationkey as branch_id,
       concat('Branch ', n_name) as branch_name,
       n_name as city,
       concat('STATE_', cast(n_nationkey % 12 as string)) as state,
       case n_regionkey when 0 then 'NORTH' when 1 then 'SOUTH' when 2 then 'EAST' when 3 then 'WEST' else 'CENTRAL' end as region
from {nation}
"""

BRANCH_DIRTY = """
select case when n_nationkey = 3 then null else n_nationkey end as branch_id,
       case when n_nationkey = 4 then null else concat('Branch ', n_name) end as branch_name,
       lower(n_name) as city,
       concat(' state_', cast(n_nationkey % 12 as string)) as state,
       case n_regionkey when 0 then 'North' when 1 then 'South' when 2 then 'East' when 3 then 'west' else null end as region
from (select * from {nation} union all select * from {nation} where n_nationkey % 5 = 2) base
"""

EVT = """
select event_id as transaction_id,
       user_id as account_number,
       ts as transaction_timestamp,
       case when event_type in ('purchase', 'click', 'view') then 'DEBIT' else 'CREDIT' end as transaction_type,
       value as amount,
       cast(ts as date) as transaction_date
from {events}
"""

# Raw lines of deliveries: one moment a day in few days, damaged rows among them. `part` is
# the delivery a row first comes with; a later one corrects some rows, day included.
TXN_DELIVERED = """
select case when o_orderkey % 97 = 0 then null else o_orderkey end as transaction_id,
       o_custkey as account_number,
       case when o_orderkey % 71 = 5 then 'bad' else concat(substr(cast(o_orderdate as string), 1, 4), '-0', cast(o_orderkey % 3 + 4 as string), '-05 10:0',
                                                           cast(o_orderkey % 10 as string), ':00') end
         as transaction_timestamp,
       case when o_orderstatus = 'F' then ' debit ' else 'CREDIT' end as transaction_type,
       case when o_orderkey % 83 = 2 then null else o_totalprice end as amount,
       'Shop' as merchant_name,
       'UPI' as channel,
       'city' as city,
       cast(o_orderkey % 3 as int) as part,
       o_orderkey % 11 = 3 as corrected,
       concat(substr(cast(o_orderdate as string), 1, 4), '-08-06 11:0', cast(o_orderkey % 10 as string), ':00') as corrected_timestamp
from {orders}
"""

VIEWS = {
    "txn": TXN,
    "txn_dirty": TXN_DIRTY,
    "cust": CUST,
    "cust_orphan": CUST_ORPHAN,
    "cust_dirty": CUST_DIRTY,
    "branch": BRANCH,
    "branch_dirty": BRANCH_DIRTY,
    "evt": EVT,
    "txn_delivered": TXN_DELIVERED,
}


def base_table(name: str) -> str:
    """The one base table a view reads."""
    fields = string.Formatter().parse(VIEWS[name])
    return next(field for _, field, _, _ in fields if field)


def over(spark: SparkSession, name: str, base: DataFrame) -> DataFrame:
    """The view over a frame of its base table, batch or stream."""
    return spark.sql(VIEWS[name], **{base_table(name): base})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return over(spark, name, spark.read.parquet(f"{sf_dir}/{base_table(name)}.parquet"))


def cte(name: str) -> str:
    """The view as a common table expression for the other engine."""
    table = base_table(name)
    return f"{name} as ({VIEWS[name].format(**{table: table}).strip()})"
