"""Configured research universes with explicit unknown membership."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contracts import UniverseRule
from tidemark.functions.scalars import quoted
from tidemark.operators import gates
from tidemark.operators.calendar import slice_days
from tidemark.operators.state import DAY_KEY

# Reasons that leave membership unknown rather than false.
UNKNOWN_REASONS = ("IDENTITY_UNKNOWN", "LISTING_AGE_UNKNOWN", "ST_STATUS_UNKNOWN")
CONFIG_SCHEMA = (
    "universe_id string, exclude_st boolean, exclude_bj boolean, min_listing_trade_days bigint, "
    "config_id string, config_json string, status string, deferred_reason string"
)


def describe_rules(rules: tuple[UniverseRule, ...], capabilities: dict[str, str]) -> list[dict]:
    """Validated rules with their canonical text and its hash."""
    if not rules:
        raise ValueError("at least one universe rule is required")
    seen, described = set(), []
    for rule in rules:
        name, minimum = rule.universe_id, rule.min_listing_trade_days
        if not isinstance(name, str) or not name.strip() or name in seen:
            raise ValueError(f"invalid or repeated universe_id: {name!r}")
        seen.add(name)
        if not isinstance(rule.exclude_st, bool) or not isinstance(rule.exclude_bj, bool):
            raise ValueError(f"{name}: exclusion flags must be boolean")
        if not isinstance(minimum, int) or isinstance(minimum, bool) or minimum < 0:
            raise ValueError(f"{name}: min_listing_trade_days must be a nonnegative integer")
        if rule.exclude_st and capabilities.get("historical_st") != "active":
            raise ValueError(f"{name}: excluding ST needs the historical_st capability")
        text = json.dumps(
            {
                "rule": asdict(rule),
                "listing_age": "exact or proven lower bound, else unknown",
                "st": "derived from names, else unknown" if rule.exclude_st else "not required",
            },
            sort_keys=True,
        )
        described.append(
            {
                **asdict(rule),
                "config_id": hashlib.sha256(text.encode()).hexdigest(),
                "config_json": text,
                "status": "active",
                "deferred_reason": None,
            }
        )
    return described


def universe_config(
    spark: SparkSession, rules: tuple[UniverseRule, ...], capabilities: dict[str, str]
) -> DataFrame:
    """The rule table: one row per configured universe."""
    return spark.createDataFrame(describe_rules(rules, capabilities), CONFIG_SCHEMA)


def gate_universe_inputs(
    state: DataFrame, status: DataFrame, calendar: DataFrame,
    start: date | None = None, end: date | None = None,
) -> None:
    """Action: both tables must cover every session of the window, and every state row of it
    needs its trade row. An empty or short table is no empty universe; it fails."""
    window = slice_days(calendar, calendar, start, end).select("trade_date")
    for name, table in (("daily_stock_state", state), ("daily_trade_status", status)):
        uncovered = window.join(
            table.select("trade_date").distinct(), "trade_date", "left_anti"
        ).orderBy("trade_date")
        gates.enforce(name, "does not cover the window", uncovered)
    lacking = slice_days(state, calendar, start, end).select(*DAY_KEY).join(
        status.select(*DAY_KEY), DAY_KEY, "left_anti"
    )
    gates.enforce("daily_trade_status", "incomplete coverage", lacking)


def research_universe(
    state: DataFrame,
    status: DataFrame,
    calendar: DataFrame,
    rules: tuple[UniverseRule, ...],
    capabilities: dict[str, str],
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Membership per (day, code, universe) from both published tables."""
    facts = slice_days(state, calendar, start, end).selectExpr(
        *DAY_KEY, "is_listed", "is_delisted", *CARRIED, "source_file as source_stock_file",
    )
    return members(facts.join(status.select(*DAY_KEY, *_TRADE), DAY_KEY), rules, capabilities)


#: Columns of the state table that a trade table must carry for :func:`members`.
CARRIED = ("is_a_share", "exchange", "listing_trade_days", "listing_trade_days_lower_bound", "is_st")
_TRADE = ("can_buy", "can_sell", "cannot_buy_reason", "cannot_sell_reason")


def members(
    facts: DataFrame, rules: tuple[UniverseRule, ...], capabilities: dict[str, str]
) -> DataFrame:
    """Membership per (day, code, universe) from a trade table that carries :data:`CARRIED`, which
    holds both sides of a security's day in one row already.

    The handful of configured rules is a literal array exploded next to each row, without a join.
    """
    facts = facts.select(
        *DAY_KEY, "is_listed", "is_delisted", *CARRIED, "source_stock_file", *_TRADE)
    literals = ", ".join(
        f"struct({quoted(row['universe_id'])} as universe_id, {quoted(row['config_id'])} "
        f"as config_id, {row['exclude_st']} as _no_st, {row['exclude_bj']} as _no_bj, "
        f"bigint({row['min_listing_trade_days']}) as _minimum)"
        for row in describe_rules(rules, capabilities)
    )
    reason = (
        "case when is_delisted then 'DELISTED' when not is_listed then 'NOT_LISTED' "
        "when not is_a_share then 'NOT_A_SHARE' "
        "when is_listed is null or is_a_share is null then 'IDENTITY_UNKNOWN' "
        "when _no_bj and endswith(ts_code, '.BJ') then 'EXCLUDED_BJ' "
        "when _no_st and is_st then 'EXCLUDED_ST' "
        "when _no_st and is_st is null then 'ST_STATUS_UNKNOWN' "
        "when _minimum > 0 and listing_trade_days < _minimum then 'IPO_TOO_RECENT' "
        "when _minimum > 0 and listing_trade_days is null "
        "and coalesce(listing_trade_days_lower_bound < _minimum, true) "
        "then 'LISTING_AGE_UNKNOWN' end"
    )
    unknown = ", ".join(map(quoted, UNKNOWN_REASONS))
    return (
        facts.selectExpr("*", f"inline(array({literals}))")
        .withColumn("exclusion_reason", F.expr(reason))
        .withColumn(
            "is_in_universe",
            F.expr(
                "case when exclusion_reason is null then true "
                f"when exclusion_reason not in ({unknown}) then false end"
            ),
        )
        .drop("_no_st", "_no_bj", "_minimum")
    )
