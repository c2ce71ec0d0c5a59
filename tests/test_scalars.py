"""The shared SQL expressions on awkward values."""

from __future__ import annotations

from datetime import date

import pytest

from tidemark.functions.scalars import (
    compensated_sum,
    is_blank,
    is_finite,
    is_security_code,
    parse_day,
    quarter_end,
    quarter_index,
)
from tidemark.session import one_by_one

D = date


def values(spark, kind, expression, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").selectExpr(f"{expression} as y").collect()]


def test_parse_day(spark):
    found = values(spark, "string", parse_day("x"), "20200229", "20200230", "2020-02-01",
                   " 2020-02-01.0 ", "20200201.0", "2020-2-3", "None", "", None, "20200101\n",
                   "202001011", "2020-13-01", "20200101.00", "2020/01/01", ".0")
    assert found == [D(2020, 2, 29), None, D(2020, 2, 1), D(2020, 2, 1), D(2020, 2, 1)] + [None] * 10


def test_finite_and_blank(spark):
    assert values(spark, "double", is_finite("x"), 1.0, float("nan"), float("inf"),
                  float("-inf"), None, 0.0) == [True, False, False, False, False, True]
    assert values(spark, "string", is_blank("x"), None, " ", "a", "\t") == [True, True, False, False]


def test_code(spark):
    assert values(spark, "string", is_security_code("x"), "000001.SZ", "A b.SH", "1.XX", ".SH",
                  "1.SH\n", None, "1.2.SH", "X1.BJ") == [True] + [False] * 6 + [True]


def test_quarters(spark):
    found = values(spark, "date", quarter_index("x"), D(2018, 3, 31), D(2018, 3, 30),
                   D(2018, 12, 31), D(2018, 2, 28))
    assert found == [2018 * 4, None, 2018 * 4 + 3, None]
    assert values(spark, "int", quarter_end("x"), 2018 * 4, 2018 * 4 + 3, 2020 * 4 - 1) == [
        D(2018, 3, 31), D(2018, 12, 31), D(2019, 12, 31)]


@pytest.mark.parametrize("terms, total", [
    (["1e16", "1", "-1e16", "1"], 2.0), (["0.1", "0.2", "0.3", "0.4"], 1.0)])
def test_compensated_sum(spark, terms, total):
    doubles = [f"double('{t}')" for t in terms]
    assert spark.range(1).selectExpr(f"{compensated_sum(doubles)} as s").first().s == total


def test_parts_are_written_one_by_one(spark):
    """What is read back are the written results, so no plan holds more than one part."""
    parts = [spark.range(n).selectExpr("count(*) as n", f"'{n}' as part") for n in (3, 5)]
    both = one_by_one(parts)
    assert sorted(map(tuple, both.collect())) == [(3, "3"), (5, "5")]
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Relation") == 2
