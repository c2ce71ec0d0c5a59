"""Merging late or overlapping pulls into a base table."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import day_of, quoted


def merge_pulls(pulls: list[DataFrame]) -> DataFrame:
    """Overlapping pulls as one table: identical rows are kept once."""
    return reduce(DataFrame.unionByName, pulls).dropDuplicates()


def route_periods(
    staged: DataFrame, base: DataFrame, head: list[str], tail: list[str]
) -> DataFrame:
    """Staged filings with their target: head periods replace, tail periods supplement.

    A tail row is kept only when the base holds no row of its security in that period; rows of
    other periods are dropped, as are all their columns the base does not know. Values are
    cast to the base's types.
    """
    targets = (
        f"case when end_date in ({', '.join(map(quoted, head))}) then 'head' "
        f"when end_date in ({', '.join(map(quoted, tail))}) then 'supplement' end"
    )
    routed = staged.selectExpr("*", f"{targets} as target").filter("target is not null")
    held = base.select("end_date", "ts_code").distinct().withColumn(
        "target", F.lit("supplement")
    )
    kept = routed.join(held, ["target", "end_date", "ts_code"], "left_anti")
    columns = [
        f"try_cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`"
        if f.name in kept.columns else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`"
        for f in base.schema.fields
    ]
    return kept.selectExpr(*columns, "target")


def code_union(sources: list[DataFrame], column: str = "ts_code") -> DataFrame:
    """Every security code any source mentions. Each source is reduced before the union."""
    distinct = [s.filter(f"{column} is not null").select(column).distinct() for s in sources]
    return reduce(DataFrame.unionByName, distinct).distinct()


def calendar_gap(existing: DataFrame, start: date, end: date) -> DataFrame:
    """One row (gap_start, gap_end): the head of [start, end] the calendar lacks, or none.

    The gap ends the day before the first known day, so old and new files never overlap.
    """
    first = existing.groupBy().agg(F.expr(f"min({day_of(existing, 'cal_date')}) as first_day"))
    return first.selectExpr(
        f"date'{start.isoformat()}' as gap_start",
        f"coalesce(date_sub(first_day, 1), date'{end.isoformat()}') as gap_end",
    ).filter("gap_start <= gap_end")
