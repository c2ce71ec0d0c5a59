"""Source profiling: report anomalies, never repair them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import SourceContract
from tidemark.functions.scalars import day_of, is_blank, quoted


def own_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_source_")]


def require_profiled(df: DataFrame, contract: SourceContract) -> None:
    wanted = {*contract.date_fields, *contract.primary_key}
    if contract.code_field:
        wanted.add(contract.code_field)
    absent = sorted(wanted - set(df.columns))
    if absent:
        raise ValueError(f"{contract.name}: configured fields not found: {absent}")


def profile_columns(df: DataFrame, contract: SourceContract) -> DataFrame:
    """One row per column: rows, null-or-blank count and rate, and date range and errors.

    All figures come from a single aggregate over one scan, then are turned to long form.
    """
    require_profiled(df, contract)
    columns = own_columns(df)
    figures, rows = ["count(*) as n"], []
    for i, name in enumerate(columns):
        figures.append(f"count_if({is_blank(f'`{name}`')}) as null_{i}")
        lo = hi = "cast(null as date)"
        bad = "cast(null as bigint)"
        if name in contract.date_fields:
            parsed = day_of(df, name)
            figures += [
                f"min({parsed}) as lo_{i}", f"max({parsed}) as hi_{i}",
                f"count_if(not {is_blank(name)} and {parsed} is null) as bad_{i}",
            ]
            lo, hi, bad = f"lo_{i}", f"hi_{i}", f"bad_{i}"
        kind = df.schema[name].dataType.simpleString()
        rows.append(
            f"struct({quoted(contract.name)} as table_name, {quoted(name)} as column_name, "
            f"{quoted(kind)} as data_type, n as row_count, null_{i} as null_count, "
            f"try_divide(double(null_{i}), double(n)) as null_rate, {lo} as date_min, "
            f"{hi} as date_max, {bad} as invalid_dates)"
        )
    counted = df.groupBy().agg(*map(F.expr, figures))
    return counted.selectExpr(f"inline(array({', '.join(rows)}))")


def profile_table(df: DataFrame, contract: SourceContract) -> DataFrame:
    """One row: rows, distinct codes, and rows beyond the first of each candidate key.

    Distinct counts are plain group-bys (null-safe, map-side combined), not an expansion of
    every row per distinct. Unconfigured figures stay NULL.
    """
    require_profiled(df, contract)
    parts = [df.groupBy().agg(F.expr("count(*) as row_count"))]
    if contract.code_field:
        parts.append(
            df.groupBy(contract.code_field).agg(F.expr("count(*) as n"))
            .groupBy().agg(F.expr(f"count({contract.code_field}) as stock_count"))
        )
    if contract.primary_key:
        parts.append(
            df.groupBy(*contract.primary_key).agg(F.expr("count(*) as n"))
            .groupBy().agg(F.expr("coalesce(sum(n - 1), 0) as duplicate_rows"))
        )
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name in ("stock_count", "duplicate_rows"):
        if name not in merged.columns:
            merged = merged.withColumn(name, F.expr("cast(null as bigint)"))
    return merged.groupBy().agg(
        F.lit(contract.name).alias("table_name"), F.max("row_count").alias("row_count"),
        F.max("stock_count").alias("stock_count"), F.max("duplicate_rows").alias("duplicate_rows"),
    )


def duplicate_issue(df: DataFrame, contract: SourceContract, samples: int = 10) -> DataFrame:
    """The first few repeated candidate keys, in key order."""
    keys = list(contract.primary_key)
    return (
        df.groupBy(*keys).agg(F.expr("count(*) as n")).filter("n > 1").orderBy(*keys)
        .limit(samples)
    )


def date_issue(df: DataFrame, contract: SourceContract, field: str, samples: int = 5) -> DataFrame:
    """The first few rows (by file, row) whose date text cannot be read."""
    bad = df.filter(f"not {is_blank(field)} and {day_of(df, field)} is null")
    lineage = [c for c in ("_source_file", "_source_row") if c in df.columns]
    return bad.orderBy(*(lineage or [field])).limit(samples)


def profile_all(
    tables: dict[str, DataFrame], contracts: dict[str, SourceContract], scope: str = "selected"
) -> tuple[DataFrame, DataFrame]:
    """(column profiles, table profiles) of many sources; every table is profiled lazily.

    A full scope refuses tables without a contract and contracts without a table.
    """
    unknown = sorted(set(tables) - set(contracts))
    absent = sorted(set(contracts) - set(tables)) if scope == "full" else []
    if unknown or absent:
        raise ValueError(f"sources without contract: {unknown}; contracts without source: {absent}")
    errors, columns, totals = {}, [], []
    for name in sorted(tables):
        try:
            columns.append(profile_columns(tables[name], contracts[name]))
            totals.append(profile_table(tables[name], contracts[name]))
        except ValueError as error:
            errors[name] = str(error)
    if errors:
        raise ValueError(f"source profiling failed: {errors}")
    return reduce(DataFrame.unionByName, columns), reduce(DataFrame.unionByName, totals)


def contract_rows(contracts: dict[str, SourceContract], df: DataFrame) -> DataFrame:
    """The contracts as (table_name, column_name, role) rows."""
    rows = [
        (c.name, column, role)
        for c in contracts.values()
        for role, names in (
            ("required", c.required), ("primary_key", c.primary_key), ("date", c.date_fields)
        )
        for column in names
    ]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, role string"
    )


def verify_profiles(columns: DataFrame, contracts: dict[str, SourceContract]) -> DataFrame:
    """(table_name, column_name, issue): contract fields lacking from a profile, fields meant as
    dates but not profiled as such, and dates that could not be read."""
    wanted = contract_rows(contracts, columns)
    joined = wanted.join(columns, ["table_name", "column_name"], "left")
    issue = (
        "case when data_type is null then 'missing_column' "
        "when role = 'date' and invalid_dates is null then 'not_profiled_as_date' "
        "when role = 'date' and invalid_dates > 0 then 'invalid_date' "
        "when role = 'primary_key' and null_count > 0 then 'null_key' end"
    )
    return joined.selectExpr("table_name", "column_name", f"{issue} as issue").filter(
        "issue is not null"
    ).distinct()
