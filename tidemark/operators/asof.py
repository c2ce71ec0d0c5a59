"""Interval and as-of joins as equi-joins on the calendar's trade index."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import exprs
from tidemark.operators.calendar import bounds, date_window, linked, lookup_days, within


def indexed_intervals(intervals: DataFrame, calendar: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals that cover a trading day, with its first and last index: _lo and _hi.

    ``[start, end]`` is closed, a NULL end is still open. Both ends are clamped to coverage and
    mapped to trade indexes by two broadcast look-ups, so no nested loop is planned.
    """
    lo, hi, _ = bounds(calendar)
    clamped = (
        intervals.withColumns({"_lo_day": lo, "_hi_day": hi})
        .withColumns(
            exprs(
                {
                    "_lo_day": f"if({start} is not null, greatest({start}, _lo_day), null)",
                    "_hi_day": f"least(coalesce({end}, _hi_day), _hi_day)",
                }
            )
        )
        .filter("_lo_day <= _hi_day")
    )
    indexed = lookup_days(clamped, calendar, "_lo_day", {"index_on_or_after": "_lo"})
    indexed = lookup_days(indexed, calendar, "_hi_day", {"index_on_or_before": "_hi"})
    return indexed.filter("_lo <= _hi").drop("_lo_day", "_hi_day")


def expanded(spans: DataFrame, calendar: DataFrame, parallelism: int | None = None) -> DataFrame:
    """One row per trading day of each row's [_lo, _hi], adding trade_date and trade_index.

    Rows are spread over tasks before they grow; the calendar is broadcast.
    """
    days = F.broadcast(calendar.selectExpr("trade_date", "trade_index as _day_index", "calendar_start as _start"))
    return (
        spread_rows(spans, parallelism)
        .selectExpr("*", "explode(sequence(_lo, _hi)) as trade_index")
        .join(days, F.expr("trade_index = _day_index"))
        .withColumnRenamed("_start", "calendar_start")
        .drop("_lo", "_hi", "_day_index")
    )


def explode_intervals(
    intervals: DataFrame, calendar: DataFrame, start: str, end: str, parallelism: int | None = None
) -> DataFrame:
    """One row per (interval, covered trading day), adding trade_date; exactly the covered days."""
    spans = indexed_intervals(intervals, calendar, start, end)
    return expanded(spans, calendar, parallelism).drop("trade_index", "calendar_start")


def swept(
    indexed: DataFrame, key: str | list[str], totals: dict[str, str], last: Column,
    whole: DataFrame | None = None, kind: str = "bigint",
) -> DataFrame:
    """Disjoint segments (key, _lo, _hi) of the intervals of each key, with running totals.

    Every interval adds its ``totals`` (name: SQL) where it begins and takes them off behind its
    end; summed up along the sorted ends, they hold from one end to the next. Segments without any
    interval are included. Keys of ``whole`` get segments from the first day to ``last``, whether
    or not they have intervals. Work is linear in the number of intervals.
    """
    names, keys = list(totals), [key] if isinstance(key, str) else key
    quoted_keys = [f"`{k}`" for k in keys]
    by = ", ".join(quoted_keys)
    steps = ", ".join(
        f"struct({at} as at, " + ", ".join(f"{sign} * cast({sql} as {kind}) as {n}" for n, sql in totals.items()) + ")"
        for at, sign in (("_lo", 1), ("_hi + 1", -1))
    )
    ends = indexed.selectExpr(*quoted_keys, f"inline(array({steps}))")
    if whole is not None:
        ends = ends.unionByName(whole.selectExpr(*quoted_keys, "1L as at", *[f"cast(0 as {kind}) as {n}" for n in names]))
    along = f"over (partition by {by} order by at)"
    summed = ends.groupBy(*keys, "at").agg(*[F.sum(n).alias(n) for n in names]).selectExpr(
        *quoted_keys, "at as _lo", f"lead(at) {along} - 1 as _next", *[f"sum({n}) {along} as {n}" for n in names])
    return summed.withColumn("_hi", F.coalesce(F.col("_next"), last)).drop("_next").filter("_lo <= _hi")


def spread_rows(df: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Round-robin a narrow table before each of its rows is multiplied.

    A fixed partition count is used because adaptive execution would otherwise merge the
    still-tiny partitions into one task and expand everything there.
    """
    spark = df.sparkSession
    n = parallelism or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    return df.repartition(n)


def visible_on(filings: DataFrame, calendar: DataFrame, day: date) -> DataFrame:
    """Every filing version already public on ``day``; no winner is chosen."""
    day, _ = date_window(calendar, day, None)
    return filings.filter(
        (F.col("availability_status") == "available") & within(filings, "available_date", None, day)
    )


def latest_on(versions: DataFrame, calendar: DataFrame, day: date, keys: list[str]) -> DataFrame:
    """The newest version per key on ``day`` (ties by version_id, highest first).

    Keys plus available_date are unique, so a group is bounded by the calendar's length, and
    the rank limit is applied before the shuffle as well as after it.
    """
    day, _ = date_window(calendar, day, None)
    newest = Window.partitionBy(*keys).orderBy(
        F.col("available_date").desc(), F.col("version_id").desc()
    )
    return (
        versions.filter(within(versions, "available_date", None, day))
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank")
    )


def validity_ranges(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Add [valid_from, valid_to]: visible from available_date to the day before the next version."""
    return versions.selectExpr(
        "*",
        "available_date as valid_from",
        f"date_sub(lead(available_date) over (partition by {', '.join(keys)} "
        "order by available_date), 1) as valid_to",
    )


def asof_panel(versions: DataFrame, panel_days: DataFrame, keys: list[str]) -> DataFrame:
    """For every panel day and key, the version visible that day.

    ``panel_days`` is a calendar (see :func:`panel_calendar`) holding only the wanted days.
    """
    return explode_intervals(
        validity_ranges(versions, keys), panel_days, "valid_from", "valid_to"
    ).drop("valid_from", "valid_to")


def panel_totals(
    versions: DataFrame, panel_days: DataFrame, keys: list[str], by: list[str], value: str
) -> DataFrame:
    """(trade_date, by, n, total): how many versions are visible on each panel day, and their sum.

    A version counts from the first panel day that sees it and is taken off behind the last;
    these differences are added up per ``by`` and day, then along the days. Work is linear in the
    versions, whatever the number of days. ``value`` is SQL of a whole number; a total without
    any value is NULL, days without a version are absent.
    """
    visible = indexed_intervals(validity_ranges(versions, keys), panel_days, "valid_from", "valid_to")
    end = F.lit(panel_days.count())
    totals = {"_n": "1", "_valued": f"if({value} is null, 0, 1)", "_sum": f"coalesce({value}, 0)"}
    runs = swept(visible, by, totals, end, kind="decimal(28,0)").filter("_n > 0")
    return expanded(runs, panel_days).selectExpr(
        "trade_date", *[f"`{k}`" for k in by], "cast(_n as bigint) as n",
        "if(_valued > 0, _sum, null) as total",
    )


def newest_panel(
    versions: DataFrame, panel_days: DataFrame, keys: list[str], period: str, n: int = 1
) -> DataFrame:
    """For every panel day, the visible versions of the ``n`` newest periods of a group.

    A group is ``keys`` without ``period``. A version is shown until its successor comes or until
    ``n`` newer periods have come, so only what is asked for is expanded. First dates are kept per
    period, of which a group has no more than the calendar has days.
    """
    group = [k for k in keys if k != period]
    firsts = versions.groupBy(*keys).agg(F.expr("min(available_date) as _first")).groupBy(*group).agg(
        F.expr(f"reverse(array_sort(collect_list(struct(`{period}` as period, _first as first)))) as _periods"))
    newer = "array_sort(array_append(s.newest, p.first))"
    fold = (
        "aggregate(_periods, named_struct('newest', cast(array() as array<date>), 'seen', "
        "cast(array() as array<struct<period: date, hidden: date>>)), (s, p) -> named_struct("
        f"'newest', slice({newer}, 1, {n}), 'seen', "
        f"array_append(s.seen, struct(p.period as period, get(s.newest, {n - 1}) as hidden))))"
    )
    hidden = firsts.selectExpr(*[f"`{k}`" for k in group], f"inline({fold}.seen)").withColumnRenamed("period", period)
    shown = validity_ranges(versions, keys).join(hidden, keys).withColumn(
        "valid_to", F.expr("least(valid_to, date_sub(hidden, 1))")).filter("valid_to is null or valid_from <= valid_to")
    return explode_intervals(shown, panel_days, "valid_from", "valid_to").drop("valid_from", "valid_to", "hidden")


def panel_calendar(calendar: DataFrame, wanted) -> DataFrame:
    """Re-index the calendar over the trading days matching the condition ``wanted``."""
    return linked(calendar.filter(wanted))
