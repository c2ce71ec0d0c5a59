"""Can a security be bought or sold on a day? TRUE, FALSE, or NULL with a reason."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import TradeRules
from tidemark.functions.scalars import day_literal, day_of, exprs, is_finite, quoted
from tidemark.operators import gates
from tidemark.operators.calendar import slice_days
from tidemark.operators.state import DAY_KEY

# Fixed value: reasons with this suffix leave the side unknown rather than blocked.
UNKNOWN_SUFFIX = "_UNKNOWN"


def _source(raw: DataFrame) -> list[str]:
    if "_source_file" in raw.columns:
        return ["_source_file", "_source_row"]
    return ["cast(null as string) as _source_file", "cast(null as bigint) as _source_row"]


def normalize_suspensions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "ts_code", f"{day_of(raw, 'trade_date')} as trade_date",
        "upper(trim(suspend_type)) as suspend_type",
        "nullif(trim(cast(suspend_timing as string)), '') as suspend_timing",
        *_source(raw),
    )


def normalize_limit_events(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "ts_code", f"{day_of(raw, 'trade_date')} as trade_date",
        "upper(trim(`limit`)) as limit_type", *_source(raw),
    )


def normalize_limit_prices(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "ts_code", f"{day_of(raw, 'trade_date')} as trade_date",
        "try_cast(up_limit as double) as up_limit",
        "try_cast(down_limit as double) as down_limit",
        *_source(raw),
    )


VALID_LIMIT = (
    f"coalesce({is_finite('up_limit')} and {is_finite('down_limit')} "
    "and up_limit > down_limit and down_limit > 0, false)"
)


def valid_limit_prices(limit_prices: DataFrame) -> DataFrame:
    return limit_prices.filter(VALID_LIMIT)


def invalid_limit_prices(limit_prices: DataFrame) -> DataFrame:
    """Placeholder or broken limits: excluded from evidence, but reported."""
    return limit_prices.filter(f"not {VALID_LIMIT}")


def suspension_rules() -> dict[str, str]:
    return {
        **gates.dated_rules(),
        "suspend_type": "suspend_type is null or suspend_type not in ('S', 'R')",
    }


def limit_event_rules(rules: TradeRules) -> dict[str, str]:
    known = (rules.limit_up_code, rules.limit_down_code, rules.opened_limit_code)
    listed = ", ".join(map(quoted, known))
    return {
        **gates.dated_rules(), "limit_type": f"limit_type is null or limit_type not in ({listed})"
    }


def limit_day_gaps(limit_prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trading days inside the limit source's own range on which it has no row at all."""
    days = limit_prices.select("trade_date").distinct()
    lo, hi = days.agg(F.min("trade_date")).scalar(), days.agg(F.max("trade_date")).scalar()
    inside = calendar.select("trade_date").filter(F.col("trade_date").between(lo, hi))
    return inside.join(days, "trade_date", "left_anti")


def coverage_gaps(
    state: DataFrame, securities: DataFrame, calendar: DataFrame,
    start: date | None = None, end: date | None = None,
) -> DataFrame:
    """(day, code) pairs of the full grid that the state table lacks.

    The days held are gathered per code, no more of them than the calendar has; rows of a code that
    lie together are combined before they are shuffled, and only the missing days are expanded.
    """
    days = slice_days(calendar, calendar, start, end).select("trade_date")
    codes = securities.select("ts_code").distinct()
    held = (
        slice_days(state, calendar, start, end)
        .join(F.broadcast(days), "trade_date", "left_semi")
        .groupBy("ts_code").agg(F.collect_set("trade_date").alias("_held"))
    )
    every = days.agg(F.collect_list("trade_date")).scalar()
    return codes.join(held, "ts_code", "left").withColumn("_every", every).selectExpr(
        "explode(array_except(_every, coalesce(_held, cast(array() as array<date>)))) as trade_date", "ts_code")


def gate_trade_inputs(
    state: DataFrame, prices: DataFrame, quotes: DataFrame, securities: DataFrame,
    suspensions: DataFrame, limit_events: DataFrame, limit_prices: DataFrame,
    calendar: DataFrame, rules: TradeRules,
    start: date | None = None, end: date | None = None,
) -> None:
    """Action: refuse bad events, gaps in the limit source and incomplete upstream tables."""
    for table, rows, checks in (
        ("stk_limit", limit_prices, gates.dated_rules()),
        ("suspend_d", suspensions, suspension_rules()),
        ("limit_list_d", limit_events, limit_event_rules(rules)),
    ):
        gates.enforce_counts(table, gates.count_violations(rows, checks))
    gates.enforce("stk_limit", "duplicate key", gates.duplicate_keys(limit_prices, DAY_KEY))
    gates.enforce("stk_limit", "trading day without any limit price",
                  limit_day_gaps(limit_prices, calendar))
    gates.enforce("daily_stock_state", "incomplete coverage",
                  coverage_gaps(state, securities, calendar, start, end))
    gates.enforce("daily_adjusted_price", "insufficient date range",
                  date_range_gap(prices, quotes, calendar, start, end))


def date_range_gap(
    table: DataFrame, source: DataFrame, calendar: DataFrame,
    start: date | None = None, end: date | None = None,
) -> DataFrame:
    """One row if ``table`` starts later or ends earlier than the window and ``source`` allow."""
    window = slice_days(calendar, calendar, start, end)
    wanted_lo = F.greatest(window.agg(F.min("trade_date")).scalar(),
                           source.agg(F.min("trade_date")).scalar())
    wanted_hi = F.least(window.agg(F.max("trade_date")).scalar(),
                        source.agg(F.max("trade_date")).scalar())
    actual = table.agg(F.min("trade_date").alias("actual_first"),
                       F.max("trade_date").alias("actual_last"))
    return actual.withColumns({"wanted_first": wanted_lo, "wanted_last": wanted_hi}).filter(
        "wanted_first <= wanted_last and (actual_first is null "
        "or actual_first > wanted_first or actual_last < wanted_last)"
    )


def suspension_facts(suspensions: DataFrame) -> DataFrame:
    """Suspend and resume evidence per (day, code).

    Flags and the two-valued type list come from plain flags; only distinct file names are
    collected, so repeated events of a hot key never pile up in one row.
    """
    facts = [
        "bool_or(suspend_type = 'S') as observed_suspend",
        "bool_or(suspend_type = 'S' and suspend_timing is null) as observed_full_day",
        "bool_or(suspend_type = 'S' and suspend_timing is not null) as observed_intraday",
        "bool_or(suspend_type = 'R') as observed_resume",
        "array_sort(collect_set(_source_file)) as source_suspend_files",
    ]
    types = _present({"R": "observed_resume", "S": "observed_suspend"})
    return suspensions.groupBy(*DAY_KEY).agg(*map(F.expr, facts)).withColumn(
        "observed_suspend_types", F.expr(types)
    )


def limit_facts(limit_events: DataFrame, rules: TradeRules) -> DataFrame:
    """Limit-up, limit-down and opened-limit evidence per (day, code)."""
    names = {
        rules.limit_up_code: "observed_up",
        rules.limit_down_code: "observed_down",
        rules.opened_limit_code: "observed_opened",
    }
    facts = [f"bool_or(limit_type = {quoted(code)}) as {name}" for code, name in names.items()]
    facts.append("array_sort(collect_set(_source_file)) as source_limit_files")
    return limit_events.groupBy(*DAY_KEY).agg(*map(F.expr, facts)).withColumn(
        "observed_limit_events", F.expr(_present(names))
    )


def _present(flags: dict[str, str]) -> str:
    """Sorted labels whose flag column is TRUE."""
    items = ", ".join(f"if({flags[label]}, {quoted(label)}, null)" for label in sorted(flags))
    return f"array_compact(array({items}))"


def _ladder(side_flag: str, label: str) -> str:
    """First reason that applies; a NULL condition falls through."""
    return (
        "case when is_delisted then 'DELISTED' when not is_listed then 'NOT_LISTED' "
        "when is_intraday_suspended then 'INTRADAY_SUSPENSION' "
        "when is_suspended then 'FULL_DAY_SUSPENSION' "
        "when not quotation_exists then 'NO_QUOTE' when vol <= 0 then 'NO_VOLUME' "
        f"when {side_flag} then '{label}' "
        "when is_suspended is null then 'SUSPENSION_STATUS_UNKNOWN' "
        f"when {side_flag} is null then 'LIMIT_STATUS_UNKNOWN' end"
    )


def _verdict(reason: str) -> str:
    return (
        f"case when {reason} is null then true "
        f"when not endswith({reason}, '{UNKNOWN_SUFFIX}') then false end"
    )


def trade_status(
    state: DataFrame,
    prices: DataFrame,
    suspensions: DataFrame,
    limit_events: DataFrame,
    limit_prices: DataFrame,
    calendar: DataFrame,
    rules: TradeRules,
    start: date | None = None,
    end: date | None = None,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """The daily trade table, with the ``carried`` columns of the state table.

    Events are reduced to one row per (trade_date, ts_code) before joining, so every join is
    one-to-one on that key and all five inputs share one hash partitioning. The grid, by far the
    longest, is streamed past hash tables of the others and not sorted.
    """
    st = slice_days(state, calendar, start, end).selectExpr(
        *DAY_KEY, "is_listed", "is_delisted", "is_not_yet_listed",
        "source_file as source_stock_file", *carried,
    )
    if "source_file" in prices.columns:
        lineage = ["source_file as source_price_file", "source_row as source_price_row"]
    else:
        lineage = ["cast(null as string) as source_price_file",
                   "cast(null as bigint) as source_price_row"]
    quoted_days = prices.selectExpr(
        *DAY_KEY, "true as _quoted", "close as raw_close", "vol", "amount", *lineage
    )
    limits = valid_limit_prices(limit_prices).selectExpr(
        *DAY_KEY, "true as _limited", "up_limit", "down_limit",
        "_source_file as source_limit_price_file", "_source_row as source_limit_price_row",
    )
    joined = (
        st.join(quoted_days.hint("shuffle_hash"), DAY_KEY, "left")
        .join(suspension_facts(suspensions).hint("shuffle_hash"), DAY_KEY, "left")
        .join(limit_facts(limit_events, rules).hint("shuffle_hash"), DAY_KEY, "left")
        .join(limits.hint("shuffle_hash"), DAY_KEY, "left")
    )
    flags = ["observed_suspend", "observed_full_day", "observed_intraday", "observed_up",
             "observed_down", "observed_opened"]
    lists = ["source_suspend_files", "observed_suspend_types", "observed_limit_events",
             "source_limit_files"]
    suspension_known = limits_known = "false"
    if rules.suspension_events_complete:
        suffixes = ", ".join(map(quoted, rules.suspension_complete_code_suffixes))
        suspension_known = (
            f"(trade_date between {day_literal(rules.coverage_start)} "
            f"and {day_literal(rules.coverage_end)} "
            f"and split_part(ts_code, '.', 2) in ({suffixes}))"
        )
    if rules.limit_events_complete:
        limits_known = (
            f"trade_date between {day_literal(rules.limit_coverage_start)} "
            f"and {day_literal(rules.limit_coverage_end)}"
        )
    observed = {
        "quotation_exists": "coalesce(_quoted, false)",
        "limit_price_exists": "coalesce(_limited, false)",
        "has_resume_event": "coalesce(observed_resume, false)",
        **{name: f"coalesce({name}, false)" for name in flags},
        **{name: f"coalesce({name}, cast(array() as array<string>))" for name in lists},
    }
    priced = "quotation_exists and limit_price_exists"
    evidence = {
        "is_suspended": f"case when observed_suspend then true when {suspension_known} "
        "then false end",
        "is_full_day_suspended": "case when observed_full_day then true "
        f"when observed_suspend or {suspension_known} then false end",
        "is_intraday_suspended": "case when observed_intraday then true "
        f"when observed_suspend or {suspension_known} then false end",
        "price_limit_up": f"case when {priced} then raw_close >= up_limit end",
        "price_limit_down": f"case when {priced} then raw_close <= down_limit end",
    }

    def direction(seen: str, opposite: str, by_price: str) -> str:
        return (
            f"case when {seen} or {by_price} then true when {by_price} is not null then false "
            f"when {opposite} or observed_opened or {limits_known} then false end"
        )

    directions = {
        "is_limit_up": direction("observed_up", "observed_down", "price_limit_up"),
        "is_limit_down": direction("observed_down", "observed_up", "price_limit_down"),
    }
    reasons = {
        "cannot_buy_reason": _ladder("is_limit_up", "LIMIT_UP"),
        "cannot_sell_reason": _ladder("is_limit_down", "LIMIT_DOWN"),
    }
    verdicts = {
        "can_buy": _verdict("cannot_buy_reason"), "can_sell": _verdict("cannot_sell_reason")
    }
    for step in (observed, evidence, directions, reasons, verdicts):
        joined = joined.withColumns(exprs(step))
    return joined.drop("_quoted", "_limited", "observed_resume")


def unmatched_events(events: DataFrame, state: DataFrame) -> DataFrame:
    """Event rows with no (day, code) in the state table."""
    return events.join(state.select(*DAY_KEY), DAY_KEY, "left_anti")


def limit_conflicts(status: DataFrame) -> DataFrame:
    """Days on which a limit event contradicts the price evidence."""
    return status.filter(
        "(observed_up and not price_limit_up) or (observed_down and not price_limit_down)"
    ).select(*DAY_KEY, "raw_close", "up_limit", "down_limit", "observed_limit_events")
