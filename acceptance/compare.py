"""Runs registered queries against their SQL and reports differences.

    python -m acceptance.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value: object) -> object:
    """One comparable form for the values of both engines; floats stay exact."""
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(float(value))
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return str(value)


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


# How the other engine names the types of both timestamp kinds, text and numbers.
TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, query, sql: str) -> str | None:
    """None when columns and rows agree exactly, else a short description."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    theirs = rows_of([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    kinds = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    other = {column[0]: str(column[1]) for column in result.description}
    if kinds != other:
        return f"types {sorted(set(kinds.items()) ^ set(other.items()))}"
    if ours[1] == theirs[1]:
        return None
    only_ours = sorted(set(ours[1]) - set(theirs[1]), key=repr)
    only_theirs = sorted(set(theirs[1]) - set(ours[1]), key=repr)
    return (
        f"rows {len(ours[1])} vs {len(theirs[1])}, {len(only_ours)} differ\n"
        f"   ours   {only_ours[:2]}\n   theirs {only_theirs[:2]}"
    )


def main() -> int:
    from acceptance.oracle import ORACLE
    from acceptance.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                found = difference(spark, con, sf_dir, QUERIES[name], ORACLE[name])
            else:
                found = f"no SQL, {QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as error:  # keep going, the report is the point
            found = f"{type(error).__name__}: {str(error)[:400]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
