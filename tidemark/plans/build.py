"""The whole build: gate, derive, publish and check each table in dependency order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import FILING_TABLES, OUTPUT_CONTRACTS, SOURCE_CONTRACTS, Rules
from tidemark.operators import feasibility, filings, prices, quarters, state, universe
from tidemark.operators.calendar import bounded, trading_calendar, validate_calendar_source
from tidemark.operators.profile import profile_all, verify_profiles
from tidemark.quality import report
from tidemark.sources.publish import Warehouse
from tidemark.sources.tables import file_inventory, require_fields, source_signature


# Which published tables each table is derived from.
UPSTREAM = {
    "daily_adjusted_price": ["daily_calendar"],
    "daily_stock_state": ["daily_calendar"],
    "daily_trade_status": ["daily_calendar", "daily_stock_state", "daily_adjusted_price"],
    "financial_available": ["daily_calendar"],
    "quarterly_financial": ["financial_available"],
    "ttm_financial": ["quarterly_financial"],
    "daily_research_universe": ["daily_calendar", "daily_stock_state", "daily_trade_status",
                                "research_universe_config"],
}


# The date by whose months a table is stored, so that slices and as-of reads skip the others.
MONTHS = {
    **{name: "trade_date" for name in ("daily_adjusted_price", "daily_stock_state",
                                       "daily_trade_status", "daily_research_universe")},
    **{name: "available_date" for name in ("financial_available", "quarterly_financial",
                                           "ttm_financial")},
}


class BuildError(ValueError):
    """A build step failed its gate; later tables were not built."""


def build(
    warehouse: Warehouse,
    raw: dict[str, DataFrame],
    rules: Rules,
    start: date | None = None,
    end: date | None = None,
    raw_root: str | None = None,
) -> dict:
    """Build and publish the nine tables from raw source tables; returns the verdict.

    Every step reads published upstream tables, so lineage never spans two steps and a rerun
    after a failure starts from files. ``raw_root`` adds the proof that sources did not change.
    """
    spark = warehouse.spark
    warehouse.config_hash = rules.config_hash()
    before = _signature(spark, raw_root)
    absent = sorted(n for n, c in SOURCE_CONTRACTS.items() if c.core and n not in raw)
    if absent:
        raise BuildError(f"sources missing from the scope of the build: {absent}")
    contracts = {name: SOURCE_CONTRACTS[name] for name in raw if name in SOURCE_CONTRACTS}
    raw = {name: require_fields(df, SOURCE_CONTRACTS[name]) if name in contracts else df
           for name, df in raw.items()}
    columns, totals = profile_all({n: raw[n] for n in contracts}, contracts)
    warehouse.publish("l0", "profile_columns", columns, ["table_name", "column_name"],
                      upstream=[])
    warehouse.publish("l0", "profile_tables", totals, ["table_name"], upstream=[])
    issues = verify_profiles(warehouse.read("profile_columns"), contracts)
    warehouse.publish("l0", "profile_issues", issues, ["table_name", "column_name", "issue"],
                      upstream=["profile_columns"])
    unsound = warehouse.read("profile_issues").filter(
        "issue in ('missing_column', 'not_profiled_as_date')"
    ).orderBy("table_name", "column_name").limit(10).collect()
    if unsound:
        raise BuildError(f"sources do not meet their contracts: {[tuple(r) for r in unsound]}")

    sources = {n: raw[n] for n in FILING_TABLES if n in raw}
    quotes = prices.normalize_quotes(raw["stk_factor_pro"])
    securities = state.normalize_securities(raw["stock_basic"])
    names = state.normalize_names(raw["namechange"])
    suspensions = feasibility.normalize_suspensions(raw["suspend_d"])
    events = feasibility.normalize_limit_events(raw["limit_list_d"])
    limit_prices = feasibility.normalize_limit_prices(raw["stk_limit"])
    results: list[dict] = []
    found: dict = {
        "calendar_source": raw["trade_cal"], "exchange": rules.calendar_exchange,
        "quotes": _within(quotes, start, end), "securities": securities, "names": names,
        "limit_prices": limit_prices, "filing_sources": sources,
        "metrics": rules.cumulative_metrics, "window": (start, end),
    }

    def step(component: str, **outputs: DataFrame) -> None:
        for name, df in outputs.items():
            contract = OUTPUT_CONTRACTS.get(name)
            key = list(contract.key) if contract else ["source_table", "record_id", "file", "row"]
            layer = contract.layer if contract else "l1"
            by_source = key[0] if key[0] == "source_table" else None
            warehouse.publish(layer, name, df, key, by_source, UPSTREAM.get(name, []), MONTHS.get(name))
            found[name] = warehouse.read(name)
        failed = report.check_component(component, found, results)
        if failed:
            raise BuildError(f"{component}: {failed}")

    validate_calendar_source(raw["trade_cal"], rules.calendar_exchange)
    step("daily_calendar",
         daily_calendar=trading_calendar(raw["trade_cal"], rules.calendar_exchange))
    calendar = found["daily_calendar"] = bounded(found["daily_calendar"])

    prices.gate_quotes(quotes, calendar)
    step("daily_adjusted_price",
         daily_adjusted_price=prices.adjusted_prices(quotes, calendar, start, end))

    state.gate_securities(securities)
    state.gate_names(names)
    step("daily_stock_state",
         daily_stock_state=state.security_state(securities, names, calendar, start, end))

    feasibility.gate_trade_inputs(
        found["daily_stock_state"], found["daily_adjusted_price"], quotes, securities,
        suspensions, events, limit_prices, calendar, rules.trade, start, end,
    )
    step("daily_trade_status", daily_trade_status=feasibility.trade_status(
        found["daily_stock_state"], found["daily_adjusted_price"], suspensions, events,
        limit_prices, calendar, rules.trade, start, end))
    diagnostics = _trade_diagnostics(found, suspensions, events, limit_prices)

    locations = [filings.record_locations(df, name) for name, df in sources.items()]
    step("financial_available",
         financial_available=filings.filings_available(sources, calendar),
         filing_locations=_union(locations))

    long = quarters.metrics_long(found["financial_available"], rules.cumulative_metrics)
    step_quarters = quarters.quarterly(quarters.period_versions(long))
    warehouse.publish("l1", "quarterly_financial", step_quarters,
                      list(OUTPUT_CONTRACTS["quarterly_financial"].key), "source_table",
                      UPSTREAM["quarterly_financial"], MONTHS["quarterly_financial"])
    found["quarterly_financial"] = warehouse.read("quarterly_financial")
    step("quarterly_and_ttm", ttm_financial=quarters.ttm(found["quarterly_financial"]))

    universe.gate_universe_inputs(
        found["daily_stock_state"], found["daily_trade_status"], calendar, start, end
    )
    step("research_universe",
         research_universe_config=universe.universe_config(
             spark, rules.universes, rules.capabilities),
         daily_research_universe=universe.research_universe(
             found["daily_stock_state"], found["daily_trade_status"], calendar, rules.universes,
             rules.capabilities, start, end))

    failed = [
        {"table_name": r.table_name, "check_name": r.problem}
        for r in report.manifest_problems(
            warehouse.manifest(), warehouse.config_hash
        ).collect()
    ]
    failed += _publish_report(warehouse, results)
    if _signature(spark, raw_root) != before:
        failed.append({"table_name": "raw", "check_name": "source_changed_during_build"})
    return {**report.verdict(failed, "core", rules.capabilities), "diagnostics": diagnostics}


def _publish_report(warehouse: Warehouse, results: list[dict]) -> list[dict]:
    """Publish the outcome of every check and the statistics of every output; returns what no
    longer is as its manifest says."""
    rows = [(r["component"], r["table_name"], r["check_name"], r["violations"], r["example"]) for r in results]
    checks = warehouse.spark.createDataFrame(
        rows, "component string, table_name string, check_name string, violations bigint, example string")
    entries = {r.table_name: r for r in warehouse.manifest().collect() if r.table_name in OUTPUT_CONTRACTS}
    tables = {name: warehouse.read(name) for name in entries}
    warehouse.publish("l0", "quality_report", checks, ["component", "table_name", "check_name"],
                      upstream=list(entries))
    warehouse.publish("l0", "table_statistics", _union(
        [report.table_statistics(name, df) for name, df in tables.items()]),
        ["table_name", "column_name"], upstream=list(entries))
    broken = _union([report.content_problems(name, df, entries[name]) for name, df in tables.items()])
    return [{"table_name": r.table_name, "check_name": r.problem} for r in broken.collect()]


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _within(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col("trade_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("trade_date") <= F.lit(end))
    return df


def _signature(spark, root: str | None):
    return None if root is None else source_signature(file_inventory(spark, root)).first()


def _trade_diagnostics(
    found: dict, suspensions: DataFrame, events: DataFrame, limit_prices: DataFrame
) -> dict[str, int]:
    """Counts of facts the trade table had to leave out or that contradict each other."""
    held = found["daily_stock_state"]
    return {
        "unmatched_suspensions": feasibility.unmatched_events(suspensions, held).count(),
        "unmatched_limit_events": feasibility.unmatched_events(events, held).count(),
        "unmatched_limit_prices": feasibility.unmatched_events(limit_prices, held).count(),
        "invalid_limit_prices": feasibility.invalid_limit_prices(limit_prices).count(),
        "limit_evidence_conflicts": feasibility.limit_conflicts(
            found["daily_trade_status"]
        ).count(),
    }
