"""Trading calendar: the only authority on dates.

A calendar is one row per open day of one exchange. It is bounded by the number of natural
days it spans, which :func:`trading_calendar` checks inside the plan, so it may always be
broadcast. Date lookups are equi-joins against the *spine* (one row per natural day), never
inequality joins.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import day_of, quoted
from tidemark.session import staged

# 500 years of natural days: about 10 MB as a broadcast, far below any executor's memory.
CALENDAR_DAYS = 183_000


class CalendarError(ValueError):
    """The calendar is inconsistent or does not cover the requested date."""


def source_days(source: DataFrame, exchange: str) -> DataFrame:
    """Typed natural days (cal_date, is_open) of one exchange; bad values become NULL."""
    flag = "trim(cast(is_open as string))"
    return source.filter(f"trim(cast(exchange as string)) = {quoted(exchange)}").selectExpr(
        f"{day_of(source, 'cal_date')} as cal_date",
        f"case when {flag} in ('0', '1') then cast({flag} as int) end as is_open",
    )


def calendar_source_checks(source: DataFrame, exchange: str) -> DataFrame:
    """(check_name, violations) of a calendar source, from one aggregate."""
    days = source_days(source, exchange)
    facts = days.groupBy().agg(
        *map(
            F.expr,
            [
                "count(*) as n", "count(cal_date) as dated", "count(distinct cal_date) as days",
                "coalesce(datediff(max(cal_date), min(cal_date)) + 1, 0) as span",
                "count_if(is_open is null) as bad_open", "count_if(is_open = 1) as open_days",
            ],
        )
    )
    return facts.selectExpr(
        "stack(6, 'no_source_rows', cast(n = 0 as bigint), 'invalid_date', n - dated, "
        "'duplicate_date', dated - days, 'invalid_is_open', bad_open, "
        "'missing_natural_day', cast(span as bigint) - days, "
        "'no_open_day', cast(open_days = 0 as bigint)) as (check_name, violations)"
    )


def validate_calendar_source(source: DataFrame, exchange: str) -> None:
    """Action: raise before anything is built on a broken calendar."""
    failed = calendar_source_checks(source, exchange).filter("violations > 0").collect()
    if failed:
        raise CalendarError(f"trade_cal[{exchange}]: " + ", ".join(map(str, failed)))


def trading_calendar(
    source: DataFrame, exchange: str, max_days: int = CALENDAR_DAYS
) -> DataFrame:
    """Open days with previous/next links, a 1-based index and the natural bounds.

    The calendar is broadcast by whatever uses it, and its windows run over one exchange's natural
    days, so a source of more than ``max_days`` of them is refused; nothing is cut off.
    """
    days = source_days(source, exchange).selectExpr(
        "cal_date as trade_date", "is_open", f"{quoted(exchange)} as exchange"
    )
    checked = (
        f"if(count(*) over (partition by exchange) > {max_days}, "
        f"cast(raise_error('calendar longer than {max_days} days') as date), "
    )
    bounded = days.selectExpr(
        "*",
        f"{checked} min(trade_date) over (partition by exchange)) as calendar_start",
        f"{checked} max(trade_date) over (partition by exchange)) as calendar_end",
    )
    return linked(bounded.filter("is_open = 1"))


def linked(days: DataFrame) -> DataFrame:
    """Previous/next links and a 1-based index over the given days of one exchange."""
    by_date = "over (partition by exchange order by trade_date)"
    return days.withMetadata("trade_date", {}).selectExpr(
        "trade_date",
        f"lag(trade_date) {by_date} as prev_trade_date",
        f"lead(trade_date) {by_date} as next_trade_date",
        f"cast(row_number() {by_date} as bigint) as trade_index",
        "calendar_start", "calendar_end", "exchange",
    )


def spine(calendar: DataFrame) -> DataFrame:
    """One row per natural day in coverage, read straight off the calendar's own links.

    Every open day stands for itself and for the closed days up to the next one; the first
    also stands for closed days before it. No shuffle and no window is needed.
    """
    days = calendar.selectExpr(
        "*",
        "explode(sequence(if(prev_trade_date is null, calendar_start, trade_date), "
        "coalesce(date_sub(next_trade_date, 1), calendar_end))) as cal_date",
    )
    return days.selectExpr(
        "cal_date",
        "cal_date = trade_date as is_open",
        "case when cal_date = trade_date then trade_index end as trade_index",
        "case when cal_date <= trade_date then trade_index "
        "when next_trade_date is not null then trade_index + 1 end as index_on_or_after",
        "case when cal_date >= trade_date then trade_index end as index_on_or_before",
        "case when cal_date > trade_date then trade_index "
        "when cal_date = trade_date and trade_index > 1 then trade_index - 1 end as index_before",
        "case when cal_date > trade_date then trade_date "
        "when cal_date = trade_date then prev_trade_date end as prev_trade_date",
        "if(cal_date < trade_date, trade_date, next_trade_date) as next_trade_date",
        "calendar_start",
        "calendar_end",
    )


_BOUNDS = "calendar_bounds"


def pinned(calendar: DataFrame) -> DataFrame:
    """Action: the calendar as a written table that knows its bounds; no plan over it derives the
    calendar again."""
    return bounded(staged(calendar))


def bounded(table: DataFrame) -> DataFrame:
    """Action: a written calendar with its first and last natural day and its highest index.

    They are read once and travel as metadata of ``trade_date``, so that plans over the calendar
    hold plain values in place of subqueries.
    """
    row = table.agg(F.min("calendar_start"), F.max("calendar_end"), F.max("trade_index")).first()
    if row[0] is None:
        return table
    known = [row[0].isoformat(), row[1].isoformat(), str(row[2])]
    return table.withMetadata("trade_date", {_BOUNDS: known})


def _known(calendar: DataFrame) -> tuple[date, date, int] | None:
    found = calendar.schema["trade_date"].metadata.get(_BOUNDS)
    return found and (date.fromisoformat(found[0]), date.fromisoformat(found[1]), int(found[2]))


def bounds(calendar: DataFrame) -> tuple[Column, Column, Column]:
    """(calendar_start, calendar_end, highest trade_index): plain values of a pinned calendar,
    else scalar subqueries."""
    known = _known(calendar)
    if known:
        return F.lit(known[0]), F.lit(known[1]), F.lit(known[2]).cast("bigint")
    return (
        calendar.agg(F.min("calendar_start")).scalar(),
        calendar.agg(F.max("calendar_end")).scalar(),
        calendar.agg(F.max("trade_index")).scalar(),
    )


def lookup_days(df: DataFrame, calendar: DataFrame, day: str, columns: dict[str, str]) -> DataFrame:
    """Attach spine columns (``{spine column: output name}``) for the natural day in ``day``.

    Days outside coverage find no row and get NULLs.
    """
    side = spine(calendar).selectExpr(
        "cal_date as _cal_date", *[f"{k} as {v}" for k, v in columns.items()]
    )
    return df.join(F.broadcast(side), F.expr(f"{day} = _cal_date"), "left").drop("_cal_date")


def date_facts(df: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """Is the day open, and its strict previous and next trading days; NULL = outside coverage."""
    return lookup_days(
        df, calendar, day,
        {"is_open": "is_trade_date", "prev_trade_date": "prev_trade_date",
         "next_trade_date": "next_trade_date"},
    )


def offset_days(df: DataFrame, calendar: DataFrame, day: str, n: int, name: str) -> DataFrame:
    """The trading day ``n`` sessions away; NULL when ``day`` is closed or the target is outside."""
    if isinstance(n, bool) or not isinstance(n, int):
        raise CalendarError(f"offset must be an integer: {n!r}")
    days = calendar.selectExpr("trade_date as _day", "trade_index as _index")
    moved = calendar.selectExpr(f"trade_index - ({n}) as _origin", f"trade_date as {name}")
    shift = days.join(F.broadcast(moved), F.col("_index") == F.col("_origin")).select("_day", name)
    return df.join(F.broadcast(shift), F.col(day) == F.col("_day"), "left").drop("_day")


def require_in_coverage(df: DataFrame, calendar: DataFrame, day: str, result: str) -> DataFrame:
    """Raise (when the plan runs) for any row whose lookup ``result`` is NULL."""
    message = F.concat(F.lit("date outside calendar coverage: "), F.col(day).cast("string"))
    kind = df.schema[result].dataType
    return df.withColumn(
        result, F.coalesce(F.col(result), F.raise_error(message).cast(kind))
    )


def date_window(
    calendar: DataFrame, start: date | None, end: date | None
) -> tuple[date | None, date | None]:
    """The same days once they are found to lie in order and inside coverage, else an error.

    An action over a calendar that is not pinned. As the result is plain dates, filters on it
    reach partitions and row groups of the tables they slice.
    """
    for label, value in (("start", start), ("end", end)):
        if value is not None and not isinstance(value, date):
            raise CalendarError(f"slice {label} must be a date: {value!r}")
    if start is not None and end is not None and start > end:
        raise CalendarError(f"slice start {start} is after its end {end}")
    wanted = [day for day in (start, end) if day is not None]
    if wanted:
        known = _known(calendar) or calendar.agg(F.min("calendar_start"), F.max("calendar_end")).first()
        if known[0] is None or min(wanted) < known[0] or max(wanted) > known[1]:
            raise CalendarError(f"slice lies outside calendar coverage: {wanted}")
    return start, end


def month_of(column: str) -> str:
    """Name of the partition column that holds the months (yyyy-MM) of a date column."""
    return f"{column}_month"


def within(df: DataFrame, column: str, lower: date | None, upper: date | None) -> Column:
    """Condition: the column lies between two days, an absent one being no bound. Where ``df`` is
    partitioned by the column's months, other months are not read."""
    kept, month = F.lit(True), month_of(column)
    for day, inside in ((lower, lambda x, y: x >= y), (upper, lambda x, y: x <= y)):
        if day is not None:
            kept = kept & inside(F.col(column), F.lit(day))
            if month in df.columns:
                kept = kept & inside(F.col(month), F.lit(f"{day:%Y-%m}"))
    return kept


def slice_days(
    df: DataFrame, calendar: DataFrame, start: date | None, end: date | None,
    column: str = "trade_date",
) -> DataFrame:
    """Keep rows inside the window. Apply it after history windows, never before."""
    if start is None and end is None:
        return df
    return df.filter(within(df, column, *date_window(calendar, start, end)))


def calendar_violations(calendar: DataFrame) -> DataFrame:
    """Rows of a published calendar whose links or index differ from a recomputation."""
    by_date = "over (partition by exchange order by trade_date)"
    return (
        calendar.selectExpr(
            "*",
            f"lag(trade_date) {by_date} as _prev",
            f"lead(trade_date) {by_date} as _next",
            f"row_number() {by_date} as _index",
        )
        .filter(
            "prev_trade_date is distinct from _prev or next_trade_date is distinct from _next "
            "or trade_index is distinct from _index or trade_date < calendar_start "
            "or trade_date > calendar_end"
        )
        .drop("_prev", "_next", "_index")
    )
