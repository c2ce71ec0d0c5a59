"""SQL text of the expressions shared by operators.

Operators hand these to ``selectExpr``/``expr``: everything stays in whole-stage codegen, and a
plan with hundreds of expressions is still built with a handful of calls into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Exchange suffixes of a security code and the exchange each one means.
EXCHANGE_OF_SUFFIX = {"SH": "SSE", "SZ": "SZSE", "BJ": "BSE"}
# \z, not $: Java's $ also matches before a trailing newline.
CODE_PATTERN = r"^[^.\s]+\.(SH|SZ|BJ)\z"


def is_blank(x: str) -> str:
    """NULL or only spaces."""
    return f"({x} is null or trim(cast({x} as string)) = '')"


def parse_day(x: str) -> str:
    """YYYYMMDD or YYYY-MM-DD (a trailing '.0' is tolerated), anything else NULL.

    Digits are regrouped and cast once, which is much cheaper than a pattern-based parse.
    """
    trimmed = f"trim(cast({x} as string))"
    text = f"if(endswith({trimmed}, '.0'), left({trimmed}, length({trimmed}) - 2), {trimmed})"
    return (
        rf"try_cast(case when {text} rlike r'^[0-9]{{8}}\z' then "
        f"concat(left({trimmed}, 4), '-', substr({trimmed}, 5, 2), '-', substr({trimmed}, 7, 2)) "
        rf"when {text} rlike r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\z' "
        f"then left({trimmed}, 10) end as date)"
    )


def day_of(df: DataFrame, name: str) -> str:
    """A DATE from column ``name``: native dates and timestamps pass, text is parsed."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return name
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"cast({name} as date)"
    return parse_day(name)


def is_finite(x: str) -> str:
    """TRUE only for a present number that is neither NaN nor infinite; never NULL."""
    return f"({x} is not null and not isnan({x}) and abs({x}) <> double('infinity'))"


def is_security_code(x: str) -> str:
    """FALSE (never NULL) for a missing code."""
    return f"coalesce({x} rlike r'{CODE_PATTERN}', false)"


def quarter_index(day: str) -> str:
    """year * 4 + quarter - 1 for a calendar quarter end, else NULL."""
    return (
        f"case when {day} = last_day({day}) and month({day}) % 3 = 0 "
        f"then year({day}) * 4 + quarter({day}) - 1 end"
    )


def quarter_end(index: str) -> str:
    """The last day of the quarter numbered as in :func:`quarter_index`."""
    return (
        f"last_day(make_date(cast(({index}) div 4 as int), "
        f"cast((({index}) % 4 + 1) * 3 as int), 1))"
    )


def compensated_sum(terms: list[str]) -> str:
    """Neumaier sum of a few doubles, so cancellation between terms loses nothing.

    Folding an array keeps the generated code small.
    """
    return (
        f"aggregate(array({', '.join(terms)}), "
        "named_struct('s', cast(0 as double), 'c', cast(0 as double)), "
        "(a, x) -> named_struct('s', a.s + x, 'c', a.c + if(abs(a.s) >= abs(x), "
        "(a.s - (a.s + x)) + x, (x - (a.s + x)) + a.s)), a -> a.s + a.c)"
    )


def quoted(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def day_literal(value) -> str:
    return f"date'{value.isoformat()}'"


def exprs(columns: dict[str, str]) -> dict[str, Column]:
    """``withColumns`` argument from SQL text."""
    return {name: F.expr(text) for name, text in columns.items()}
