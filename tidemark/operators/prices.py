"""Adjusted prices and one-day returns that never cross a missing trading day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import day_of, exprs
from tidemark.operators import gates
from tidemark.operators.calendar import slice_days


def normalize_quotes(raw: DataFrame, source_table: str = "stk_factor_pro") -> DataFrame:
    """Typed quotes; any further source columns pass through untouched."""
    typed = {name: f"try_cast({name} as double)" for name in gates.QUOTE_NUMBERS}
    typed["raw_trade_date"] = "cast(trade_date as string)"
    typed["trade_date"] = day_of(raw, "trade_date")
    if "_source_file" in raw.columns:
        typed.update(source_file="_source_file", source_row="_source_row")
    return (
        raw.withColumns(exprs(typed))
        .withColumn("source_table", F.lit(source_table))
        .drop("_source_file", "_source_row")
    )


def gate_quotes(quotes: DataFrame, calendar: DataFrame) -> None:
    """Action: refuse bad values, duplicate keys and quotes on closed days."""
    gates.enforce_counts("stk_factor_pro", gates.count_violations(quotes, gates.quote_rules()))
    gates.enforce("stk_factor_pro", "duplicate quote key",
                  gates.duplicate_keys(quotes, ["trade_date", "ts_code"]))
    gates.enforce("stk_factor_pro", "quote outside the calendar",
                  off_calendar(quotes, calendar).select("trade_date", "ts_code"))


def off_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows whose trade_date is not a trading day."""
    return df.join(F.broadcast(calendar.select("trade_date")), "trade_date", "left_anti")


def adjusted_prices(
    quotes: DataFrame, calendar: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Same-day adjusted OHLC and ``ret_1d`` with a status.

    One shuffle, by security. (trade_date, ts_code) is unique after :func:`gate_quotes`, so a
    security's window holds at most one row per trading day whatever its share of the market.
    The slice comes last: the first day of a slice keeps its previous quote.
    """
    adjusted = quotes.withColumns(
        exprs({f"adjusted_{name}": f"{name} * adj_factor" for name in gates.OHLC})
    )
    links = F.broadcast(calendar.selectExpr("trade_date", "prev_trade_date as _previous_session"))
    by_date = "over (partition by ts_code order by trade_date)"
    history = adjusted.join(links, "trade_date").selectExpr(
        "*",
        f"lag(trade_date) {by_date} as prev_quote_date",
        f"lag(adjusted_close) {by_date} as _prev_close",
    )
    result = history.selectExpr(
        "*",
        "case when prev_quote_date = _previous_session "
        "then try_divide(adjusted_close, _prev_close) - 1 end as ret_1d",
        "case when prev_quote_date is null then 'no_previous_quote' "
        "when prev_quote_date <> _previous_session then 'missing_previous_trading_day' "
        "else 'available' end as return_status",
    ).drop("_previous_session", "_prev_close")
    return slice_days(result, calendar, start, end)
