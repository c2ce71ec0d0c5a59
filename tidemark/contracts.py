"""Rules and table contracts as plain data."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import date

# The policies a build can be asked for. Any other text is refused.
SUPPORTED_POLICIES = {
    "price_adjustment": "raw_times_adj_factor",
    "announcement_rule": "max_ann_and_f_ann_then_next_trade_day",
    "version_identity": "full_record_hash",
    "invalid_announcement_policy": "preserve_raw_exclude_available",
    "missing_quarter_policy": "null_with_reason",
    "same_effective_date_metric_conflict_policy": "null_with_ambiguous",
    "name_source": "namechange",
    "st_name_rule": "name_contains_st",
    "star_st_name_rule": "name_contains_star_st",
    "interval_semantics": "closed_start_closed_end",
    "overlap_policy": "agreed_value_else_null_ambiguous",
    "uncovered_policy": "null_with_uncovered_status",
    "limit_price_policy": "exclude_invalid_rows_with_diagnostics",
    "intraday_suspension_policy": "conservative_block_with_explicit_reason",
}

# Filing tables, and the income-statement metrics that accumulate over a year.
FILING_TABLES = ("income_vip", "balancesheet_vip", "cashflow_vip", "fina_indicator")
CUMULATIVE_METRICS = {
    "income_vip": ["revenue", "n_income_attr_p"],
    "cashflow_vip": ["n_cashflow_act"],
}


@dataclass(frozen=True)
class TradeRules:
    """What the event sources are declared to cover; outside it, absence means unknown."""

    suspension_events_complete: bool = True
    suspension_complete_code_suffixes: tuple[str, ...] = ("SH", "SZ")
    coverage_start: date = date(2018, 6, 1)
    coverage_end: date = date(2026, 9, 11)
    limit_events_complete: bool = False
    limit_coverage_start: date = date(2020, 1, 2)
    limit_coverage_end: date = date(2026, 9, 11)
    limit_up_code: str = "U"
    limit_down_code: str = "D"
    opened_limit_code: str = "Z"

    def __post_init__(self):
        for name in ("suspension_events_complete", "limit_events_complete"):
            if not isinstance(getattr(self, name), bool):
                raise ValueError(f"trade rule {name} must be boolean")
        suffixes = set(self.suspension_complete_code_suffixes)
        if not suffixes or not suffixes <= {"SH", "SZ", "BJ"}:
            raise ValueError("invalid suspension_complete_code_suffixes")


@dataclass(frozen=True)
class UniverseRule:
    universe_id: str
    exclude_st: bool
    exclude_bj: bool
    min_listing_trade_days: int


# The four shipped universes.
DEFAULT_UNIVERSES = (
    UniverseRule("all_a", False, False, 0),
    UniverseRule("all_a_ex_st", True, False, 0),
    UniverseRule("all_a_ex_st_ipo120", True, False, 120),
    UniverseRule("all_a_ex_st_ipo120_ex_bj", True, True, 120),
)

# Capability states; a deferred or limited one bars the "complete" verdict.
DEFAULT_CAPABILITIES = {
    "historical_st": "active",
    "historical_name_changes": "active",
    "historical_delisting_period": "deferred",
    "exact_listing_age_before_calendar": "deferred",
    "stock_daily_limit_prices": "active",
    "missing_financial_quarters": "limited",
    "announcement_timestamps": "deferred",
    "financial_revision_archive": "limited",
    "historical_security_code_mapping": "deferred",
    "historical_market_membership": "deferred",
}


@dataclass(frozen=True)
class Rules:
    calendar_exchange: str = "SSE"
    policies: dict = field(default_factory=lambda: dict(SUPPORTED_POLICIES))
    report_types: tuple[str, ...] = ("1",)
    update_flag_is_tiebreaker: bool = False
    cumulative_metrics: dict = field(
        default_factory=lambda: {k: list(v) for k, v in CUMULATIVE_METRICS.items()}
    )
    trade: TradeRules = TradeRules()
    universes: tuple[UniverseRule, ...] = DEFAULT_UNIVERSES
    capabilities: dict = field(default_factory=lambda: dict(DEFAULT_CAPABILITIES))

    def __post_init__(self):
        for name, supported in SUPPORTED_POLICIES.items():
            if self.policies.get(name) != supported:
                raise ValueError(f"unsupported policy {name}: {self.policies.get(name)}")
        if tuple(self.report_types) != ("1",) or self.update_flag_is_tiebreaker is not False:
            raise ValueError("unsupported report types or update-flag policy")
        for source, metrics in self.cumulative_metrics.items():
            if source not in CUMULATIVE_METRICS or not metrics or len(set(metrics)) != len(metrics):
                raise ValueError(f"invalid cumulative metrics: {source}/{metrics}")
        if not any(self.cumulative_metrics.values()):
            raise ValueError("no cumulative metrics configured")

    def config_hash(self) -> str:
        text = json.dumps(asdict(self), sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class SourceContract:
    """What a raw table must hold: used by scans, profiles and their verification."""

    name: str
    required: tuple[str, ...]
    primary_key: tuple[str, ...] = ()
    date_fields: tuple[str, ...] = ()
    code_field: str | None = "ts_code"
    core: bool = True


_FILING_KEY = ("ts_code", "end_date", "report_type", "ann_date", "f_ann_date")
_FILING_DATES = ("ann_date", "f_ann_date", "end_date")
_DAY_KEY = ("trade_date", "ts_code")
# Required fields, keys and date fields of the eleven sources that feed derivations.
SOURCE_CONTRACTS = {
    c.name: c
    for c in (
        SourceContract("trade_cal", ("exchange", "cal_date", "is_open", "pretrade_date"),
                       ("exchange", "cal_date"), ("cal_date", "pretrade_date"), None),
        SourceContract("stock_basic",
                       ("ts_code", "curr_type", "name", "market", "exchange", "list_status",
                        "list_date", "delist_date"),
                       ("ts_code",), ("list_date", "delist_date")),
        SourceContract("namechange", ("ts_code", "name", "start_date", "end_date", "ann_date"),
                       ("ts_code", "start_date"), ("start_date", "end_date", "ann_date")),
        SourceContract("stk_factor_pro",
                       ("ts_code", "trade_date", "open", "high", "low", "close", "vol", "amount",
                        "adj_factor"),
                       _DAY_KEY, ("trade_date",)),
        SourceContract("stk_limit", ("trade_date", "ts_code", "up_limit", "down_limit"),
                       _DAY_KEY, ("trade_date",)),
        SourceContract("suspend_d", ("ts_code", "trade_date", "suspend_type", "suspend_timing"),
                       ("ts_code", "trade_date", "suspend_type", "suspend_timing"),
                       ("trade_date",)),
        SourceContract("limit_list_d", ("trade_date", "ts_code", "limit", "close"),
                       ("trade_date", "ts_code", "limit"), ("trade_date",)),
        SourceContract("income_vip", _FILING_KEY + ("update_flag", "revenue", "n_income_attr_p"),
                       _FILING_KEY, _FILING_DATES),
        SourceContract("cashflow_vip", _FILING_KEY + ("update_flag", "n_cashflow_act"),
                       _FILING_KEY, _FILING_DATES),
        SourceContract("balancesheet_vip", _FILING_KEY + ("update_flag", "total_assets"),
                       _FILING_KEY, _FILING_DATES),
        SourceContract("fina_indicator", ("ts_code", "end_date", "ann_date", "update_flag"),
                       ("ts_code", "end_date", "ann_date"), ("ann_date", "end_date")),
    )
}


@dataclass(frozen=True)
class OutputContract:
    layer: str
    key: tuple[str, ...]
    columns: dict[str, str]


_QUARTER_KEY = ("source_table", "ts_code", "metric", "end_date", "available_date")
# Keys and required column types of the nine published tables.
OUTPUT_CONTRACTS = {
    "daily_calendar": OutputContract("l1", ("trade_date",), {
        "trade_date": "date", "prev_trade_date": "date", "next_trade_date": "date",
        "trade_index": "bigint"}),
    "daily_adjusted_price": OutputContract("l1", ("trade_date", "ts_code"), {
        "trade_date": "date", "ts_code": "string", "close": "double", "adj_factor": "double",
        "adjusted_close": "double", "ret_1d": "double", "prev_quote_date": "date"}),
    "daily_stock_state": OutputContract("l1", ("trade_date", "ts_code"), {
        "trade_date": "date", "ts_code": "string", "is_listed": "boolean",
        "is_delisted": "boolean", "is_a_share": "boolean", "is_st": "boolean",
        "is_star_st": "boolean", "listing_trade_days": "bigint",
        "listing_trade_days_lower_bound": "bigint", "listing_natural_days": "bigint",
        "estimated_listing_trade_days": "bigint", "historical_name": "string",
        "historical_state_status": "string"}),
    "daily_trade_status": OutputContract("l1", ("trade_date", "ts_code"), {
        "trade_date": "date", "ts_code": "string", "can_buy": "boolean", "can_sell": "boolean",
        "is_suspended": "boolean", "is_limit_up": "boolean", "is_limit_down": "boolean",
        "up_limit": "double", "down_limit": "double", "limit_price_exists": "boolean"}),
    "financial_available": OutputContract("l1", ("source_table", "record_id"), {
        "source_table": "string", "record_id": "string", "ts_code": "string",
        "end_date": "date", "ann_date": "date", "f_ann_date": "date",
        "effective_ann_date": "date", "available_date": "date",
        "availability_status": "string", "version": "bigint"}),
    "quarterly_financial": OutputContract("l1", _QUARTER_KEY, {
        "source_table": "string", "ts_code": "string", "end_date": "date",
        "available_date": "date", "value": "double", "status": "string",
        "version_id": "string", "source_record_ids": "array<string>"}),
    "ttm_financial": OutputContract("l1", _QUARTER_KEY, {
        "source_table": "string", "ts_code": "string", "end_date": "date",
        "available_date": "date", "value": "double", "status": "string",
        "version_id": "string", "source_quarter_ids": "array<string>"}),
    "research_universe_config": OutputContract("l2", ("universe_id",), {
        "universe_id": "string", "config_id": "string", "config_json": "string",
        "status": "string"}),
    "daily_research_universe": OutputContract("l2", ("trade_date", "ts_code", "universe_id"), {
        "trade_date": "date", "ts_code": "string", "universe_id": "string",
        "config_id": "string", "is_in_universe": "boolean"}),
}
