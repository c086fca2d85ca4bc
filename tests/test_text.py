from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.functions.text import crore_text, money_text, period_text


@pytest.mark.parametrize("value", [0.0, 0.5, 1.5, 2.5, 999.5, 1234567.5, 12345.49, 34558.2])
def test_money_rounds_like_the_original(spark, value):
    got = spark.range(1).select(money_text(F.lit(value))).first()[0]
    assert got == f"₹{value:,.0f}"


def test_formats_on_many_values(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(0, 1e12).map(lambda x: round(x, 2)), min_size=1, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = df.select("v", money_text(F.col("v")).alias("m"), crore_text(F.col("v")).alias("c")).collect()
        for row in got:
            assert row.m == f"₹{row.v:,.0f}"
            assert row.c == f"₹{row.v / 10000000:.1f} Cr"

    check()


def test_crore_has_no_grouping_and_even_ties(spark):
    values = [2.5e6, 7.5e6, 1310000000.0, 2.5e11]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(crore_text(F.col("v"))).collect()] == [
        "₹0.2 Cr",
        "₹0.8 Cr",
        "₹131.0 Cr",
        "₹25000.0 Cr",
    ]


def test_period_is_padded(spark):
    df = spark.createDataFrame([(2025, 3), (2025, 12)], "y int, m int")
    assert [r[0] for r in df.select(period_text("y", "m")).collect()] == ["2025-03", "2025-12"]
