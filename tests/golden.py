"""A made-up spring market: 51 natural days, 33 sessions, six securities, all text.

Written down as a diary that can be checked by eye; every expectation in the tests was worked out
from it by hand.
"""

from __future__ import annotations

from datetime import date, timedelta

from tidemark.contracts import CUMULATIVE_METRICS, Rules, TradeRules, UniverseRule
from tidemark.operators import calendar as cal
from tidemark.operators import feasibility, filings, prices, quarters, state, universe

FIRST, LAST = date(2021, 3, 22), date(2021, 5, 11)
CLOSED = ("0405", "0503", "0504", "0505")

# code, listed, delisted, currency
SECURITIES = """
300101.SZ 0322 -    CNY
300102.SZ 0322 -    CNY
601203.SH 0414 -    CNY
601204.SH 0322 0428 CNY
430305.BJ 0322 -    CNY
688306.SH 0322 -    USD
"""
# code, first day, last day, name
NAMES = """
300101.SZ 0322 -    Alpha
300102.SZ 0322 -    Birch
601203.SH 0322 -    Cedar
601204.SH 0322 0401 Harbor
601204.SH 0402 0411 ST Harbor
601204.SH 0412 -    *ST Harbor
430305.BJ 0322 0407 North
430305.BJ 0412 -    North
688306.SH 0322 0418 ST Delta
688306.SH 0419 -    Delta
"""
# code, announced, finally announced, quarter of 2020, revised, cumulative revenue
REPORTS = """
300101.SZ 0324 0324 1 0 30
300101.SZ 0326 0326 2 0 70
300101.SZ 0327 0327 3 0 120
300101.SZ 0402 0404 4 0 200
300101.SZ 0415 0415 3 1 125
688306.SH 0323 0323 1 0 12
688306.SH 0330 0330 3 0 40
688306.SH 0420 0420 4 0 61
"""
STEADY = {"601203.SH": 12.5, "601204.SH": 3.0, "430305.BJ": 8.0, "688306.SH": 25.0}
QUARTER_ENDS = {"1": "20200331", "2": "20200630", "3": "20200930", "4": "20201231"}

CODES = [line.split()[0] for line in SECURITIES.split("\n") if line]
TRADE = TradeRules(
    suspension_complete_code_suffixes=("SH", "SZ", "BJ"), coverage_start=FIRST, coverage_end=LAST,
    limit_events_complete=True, limit_coverage_start=FIRST, limit_coverage_end=LAST,
)
UNIVERSES = (
    UniverseRule("whole", False, False, 0), UniverseRule("clean", True, False, 0),
    UniverseRule("seasoned", False, False, 3), UniverseRule("no_bj", False, True, 0),
)
RULES = Rules(trade=TRADE, universes=UNIVERSES)

COLUMNS = {
    "trade_cal": "exchange cal_date is_open pretrade_date",
    "stock_basic": "ts_code curr_type name market exchange list_status list_date delist_date",
    "namechange": "ts_code name start_date end_date ann_date",
    "stk_factor_pro": "ts_code trade_date open high low close vol amount adj_factor",
    "stk_limit": "trade_date ts_code up_limit down_limit",
    "suspend_d": "ts_code trade_date suspend_timing suspend_type",
    "limit_list_d": "trade_date ts_code close limit",
    "income_vip": "ts_code ann_date f_ann_date end_date report_type update_flag revenue n_income_attr_p",
    "cashflow_vip": "ts_code ann_date f_ann_date end_date report_type update_flag n_cashflow_act",
    "balancesheet_vip": "ts_code ann_date f_ann_date end_date report_type update_flag total_assets",
    "fina_indicator": "ts_code ann_date end_date update_flag eps",
}
FILED = ("income_vip", "balancesheet_vip", "cashflow_vip", "fina_indicator")


def this_year(day: str) -> str | None:
    return None if day == "-" else f"2021{day}"


def entries(diary: str, parts: int) -> list[list[str]]:
    return [line.split(maxsplit=parts - 1) for line in diary.strip().split("\n")]


def natural_days() -> list[date]:
    return [FIRST + timedelta(i) for i in range((LAST - FIRST).days + 1)]


def open_days() -> list[date]:
    return [d for d in natural_days() if d.weekday() < 5 and f"{d:%m%d}" not in CLOSED]


def close_of(code: str, day: date) -> tuple[float, float] | None:
    """Close and adjustment factor. 300101 gains one a session and is split 5 for 4 on 12 April;
    300102 is suspended on 8 and 9 April and simply not quoted on the 21st."""
    stamp = f"{day:%m%d}"
    if code == "300101.SZ":
        whole = 41.0 + open_days().index(day)
        return (round(whole * 0.8, 4), 1.25) if stamp >= "0412" else (whole, 1.0)
    if code == "300102.SZ":
        return None if stamp in ("0408", "0409", "0421") else ({"0413": 55.0, "0415": 45.0}.get(stamp, 50.0), 1.0)
    if (code == "601203.SH" and stamp < "0414") or (code == "601204.SH" and stamp >= "0428"):
        return None
    return STEADY[code], 1.0


def quotes() -> list[tuple]:
    rows = []
    for day in open_days():
        for code in CODES:
            if found := close_of(code, day):
                close, factor = found
                numbers = (close - 0.25, close + 0.5, close - 0.5, close, 700, close * 700, factor)
                rows.append((code, f"{day:%Y%m%d}", *map(str, numbers)))
    return rows


def limits() -> list[tuple]:
    """From 6 April 300102 may move by three, but closes at a limit on the 13th and the 15th."""
    rows = [("20210422", "430305.BJ", "99999.99", "0.0"), ("20210422", "688306.SH", "26", "24")]
    for day in open_days():
        stamp, close = f"{day:%m%d}", (close_of("300102.SZ", day) or (50.0,))[0]
        if stamp >= "0406":
            rows.append((f"2021{stamp}", "300102.SZ", str(close + 3 * (stamp != "0413")),
                         str(close - 3 * (stamp != "0415"))))
    return rows


def reports(source: str) -> list[tuple]:
    figures = {
        "income_vip": lambda v: (str(v), str(v - 5)), "cashflow_vip": lambda v: (str(-v),),
        "balancesheet_vip": lambda v: (str(1000 + v),), "fina_indicator": lambda v: (str(v / 100),),
    }[source]
    rows = []
    for code, ann, final, quarter, revised, value in entries(REPORTS, 6):
        dates = [this_year(ann), this_year(final), QUARTER_ENDS[quarter], "1"]
        if source == "fina_indicator":
            dates = [this_year(ann), QUARTER_ENDS[quarter]]
        rows.append((code, *dates, revised, *figures(int(value))))
    return rows


class Golden:
    """The market as DataFrames; every table can be replaced by other rows."""

    def __init__(self, spark):
        self.spark, self.columns = spark, COLUMNS
        opened = set(open_days())
        self.rows = {
            "trade_cal": [("SSE", f"{d:%Y%m%d}", str(int(d in opened)), None) for d in natural_days()],
            "stock_basic": [(code, money, None, None, None, None, this_year(since), this_year(until))
                            for code, since, until, money in entries(SECURITIES, 4)],
            "namechange": [(code, name, this_year(since), this_year(until), None)
                           for code, since, until, name in entries(NAMES, 4)],
            "stk_factor_pro": quotes(), "stk_limit": limits(),
            "suspend_d": [("300102.SZ", "20210408", None, "S"), ("300102.SZ", "20210409", None, "S")],
            "limit_list_d": [("20210413", "300102.SZ", "55", "U"), ("20210415", "300102.SZ", "45", "D")],
            **{source: reports(source) for source in FILED},
        }

    def frame(self, name: str, rows=None):
        rows = self.rows[name] if rows is None else rows
        fields = [f"`{n}` string" for n in COLUMNS[name].split()]
        schema = ", ".join([*fields, "_source_file string", "_source_row bigint"])
        return self.spark.createDataFrame([(*r, f"{name}/spring.csv", i) for i, r in enumerate(rows)], schema)

    def raw(self) -> dict:
        return {name: self.frame(name) for name in COLUMNS}

    def calendar(self):
        return cal.trading_calendar(self.frame("trade_cal"), "SSE")

    def prices(self, rows=None, start=None, end=None):
        normal = prices.normalize_quotes(self.frame("stk_factor_pro", rows))
        return prices.adjusted_prices(normal, self.calendar(), start, end)

    def state(self, names=None, start=None, end=None, basic=None):
        securities = state.normalize_securities(self.frame("stock_basic", basic))
        spans = state.normalize_names(self.frame("namechange", names))
        return state.security_state(securities, spans, self.calendar(), start, end)

    def events(self, **rows):
        """Suspensions, limit events and limit prices."""
        return (
            feasibility.normalize_suspensions(self.frame("suspend_d", rows.get("suspend_d"))),
            feasibility.normalize_limit_events(self.frame("limit_list_d", rows.get("limit_list_d"))),
            feasibility.normalize_limit_prices(self.frame("stk_limit", rows.get("stk_limit"))),
        )

    def status(self, rules=TRADE, start=None, end=None, **rows):
        return feasibility.trade_status(
            self.state(), self.prices(), *self.events(**rows), self.calendar(), rules, start, end)

    def sources(self, **rows) -> dict:
        return {name: self.frame(name, rows.get(name)) for name in FILED}

    def filings(self, **rows):
        return filings.filings_available(self.sources(**rows), self.calendar())

    def quarters(self, **rows):
        return quarters.quarterly_and_ttm(self.filings(**rows), CUMULATIVE_METRICS)

    def universe(self, start=None, end=None):
        return universe.research_universe(
            self.state(), self.status(), self.calendar(), UNIVERSES, RULES.capabilities, start, end)
