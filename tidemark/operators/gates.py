"""Input gates: rows that must not exist. Each gate is lazy; ``enforce`` is the action.

Rules are ``{check name: SQL condition}``; a condition that is NULL is not a violation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import is_blank, is_finite, is_security_code, quoted

QUOTE_NUMBERS = ["open", "high", "low", "close", "adj_factor", "vol", "amount"]
OHLC = ["open", "high", "low", "close"]


class GateError(ValueError):
    """Rows broke a precondition; nothing was written."""


def violating(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows breaking any rule."""
    return df.filter(" or ".join(f"coalesce({rule}, false)" for rule in rules.values()))


def count_violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(check_name, violations) for all rules in one pass over ``df``."""
    counted = df.groupBy().agg(
        *[F.expr(f"count_if({rule}) as v{i}") for i, rule in enumerate(rules.values())]
    )
    pairs = ", ".join(f"{quoted(name)}, v{i}" for i, name in enumerate(rules))
    return counted.selectExpr(f"stack({len(rules)}, {pairs}) as (check_name, violations)")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen more than once. Counts combine map-side, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def enforce(table: str, check: str, rows: DataFrame, samples: int = 10) -> None:
    """Action: raise with a few samples if ``rows`` is not empty."""
    found = rows.orderBy(*rows.columns).limit(samples).collect()
    if found:
        raise GateError(f"{table}: {check}: {[r.asDict() for r in found]}")


def enforce_counts(table: str, counts: DataFrame) -> None:
    """Action: raise if any (check_name, violations) row is positive."""
    found = counts.filter("violations > 0").collect()
    if found:
        raise GateError(f"{table}: " + ", ".join(f"{r.check_name}={r.violations}" for r in found))


def quote_rules() -> dict[str, str]:
    """Sanity of normalised quotes: present, finite, positive, ordered, adjustable."""
    rules = dated_rules()
    for name in QUOTE_NUMBERS:
        sign = "<" if name in ("vol", "amount") else "<="
        rules[name] = f"not {is_finite(name)} or {name} {sign} 0"
    rules["low_above_high"] = "low > high"
    for name in ("open", "close"):
        rules[f"{name}_outside_range"] = f"{name} < low or {name} > high"
    rules["adjusted_overflow"] = " or ".join(
        f"({n} * adj_factor is not null and not {is_finite(f'({n} * adj_factor)')})" for n in OHLC
    )
    return rules


def interval_rules() -> dict[str, str]:
    """Sanity of normalised name intervals."""
    return {
        "ts_code": f"not {is_security_code('ts_code')}",
        "name": "name is null",
        "start_date": "start_date is null",
        "end_date": f"not {is_blank('raw_end_date')} and end_date is null",
        "end_before_start": "end_date < start_date",
    }


def security_rules() -> dict[str, str]:
    """Sanity of normalised securities."""
    return {
        "ts_code": f"not {is_security_code('ts_code')}",
        "list_date": "list_date is null",
        "delist_date": f"not {is_blank('raw_delist_date')} and delist_date is null",
        "delist_before_list": "delist_date < list_date",
    }


def dated_rules() -> dict[str, str]:
    """A row keyed by (trade_date, ts_code) must have both."""
    return {"trade_date": "trade_date is null", "ts_code": is_blank("ts_code")}
