"""A deterministic demo market over the given tables, so every operator has real input.

Orders set the calendar span and the filings, lineitem the quotes and events, supplier the
securities and their names. Everything is derived in Spark and grows with the tables.
"""

from __future__ import annotations

from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contracts import DEFAULT_CAPABILITIES, DEFAULT_UNIVERSES, TradeRules
from tidemark.functions.scalars import day_literal
from tidemark.operators import calendar as cal
from tidemark.operators import feasibility, filings, prices, quarters, state, universe
from tidemark.session import staged

EXCHANGE = "SSE"
METRICS = {"income_vip": ["revenue", "n_income_attr_p"], "cashflow_vip": ["n_cashflow_act"]}
TRADE_RULES = TradeRules(
    coverage_start=date(1995, 6, 1), coverage_end=date(2001, 6, 30),
    limit_events_complete=True,
    limit_coverage_start=date(1998, 1, 1), limit_coverage_end=date(2000, 12, 31),
)
#: Totals of a customer's year that one task multiplies, each to some five filings of a source;
#: those of all sources are sorted in that task.
TOTALS_PER_TASK = 5_000

# SQL text of the derivations below; keys are supplier or customer numbers.
CODE = "concat(lpad(cast({key} as string), 10, '0'), element_at(array('.SH', '.SZ', '.BJ'), " \
       "cast({key} % 3 + 1 as int)))"
STAMP = "replace(cast(cast({day} as date) as string), '-', '')"
CENTS = "cast(round({column} * 100) as bigint)"


def lazily(build):
    """Build a DataFrame of the market once; it stays lazy."""

    @wraps(build)
    def cached(self):
        if build.__name__ not in self._built:
            self._built[build.__name__] = build(self)
        return self._built[build.__name__]

    return cached


class DemoMarket:
    """Lazy DataFrames of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, object] = {}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @lazily
    def span(self) -> tuple[date, date]:
        """First and last order day: two values, read once per market."""
        row = self.read("orders").selectExpr(
            "cast(min(o_orderdate) as date)", "cast(max(o_orderdate) as date)"
        ).first()
        return row[0], row[1]

    def staged(self, name: str) -> DataFrame:
        """A derived table written once and read back, for plans that use it many times."""
        key = f"staged {name}"
        if key not in self._built:
            self._built[key] = staged(getattr(self, name)())
        return self._built[key]

    # -- sources ---------------------------------------------------------------------------

    @lazily
    def calendar_source(self) -> DataFrame:
        """Natural days of the order span; open on weekdays other than 1 January."""
        first, last = self.span()
        days = self.spark.range(1).selectExpr(
            f"explode(sequence({day_literal(first)}, {day_literal(last)})) as day"
        )
        return days.selectExpr(
            f"'{EXCHANGE}' as exchange", f"{STAMP.format(day='day')} as cal_date",
            "if(dayofweek(day) in (1, 7) or (month(day) = 1 and dayofmonth(day) = 1), '0', '1') "
            "as is_open",
        )

    @lazily
    def calendar(self) -> DataFrame:
        return cal.pinned(cal.trading_calendar(self.calendar_source(), EXCHANGE))

    @lazily
    def _day_totals(self) -> DataFrame:
        """Per (supplier, ship day) integer-cent facts, reduced map-side before the shuffle."""
        facts = ["min(price) as low_c", "max(price) as high_c", "sum(price) as sum_c",
                 "count(*) as n", "sum(l_quantity) as vol"]
        return (
            self.read("lineitem")
            .selectExpr("l_suppkey as key", "cast(l_shipdate as date) as day", "l_quantity",
                        f"{CENTS.format(column='l_extendedprice')} as price")
            .groupBy("key", "day")
            .agg(*map(F.expr, facts))
            .join(F.broadcast(self.calendar().selectExpr("trade_date as day")), "day")
        )

    @lazily
    def quotes_source(self) -> DataFrame:
        return self._day_totals().selectExpr(
            f"{CODE.format(key='key')} as ts_code", "day as trade_date",
            "((low_c + high_c) div 2) / double(100) as open", "high_c / double(100) as high",
            "low_c / double(100) as low", "(sum_c div n) / double(100) as close",
            "vol", "sum_c / double(100) as amount",
            "if(key % 3 = 0 and day >= date'1998-01-01', double(2), double(1)) as adj_factor",
        )

    @lazily
    def untidy_quotes_source(self) -> DataFrame:
        """One quote per line item: duplicates, closed days and odd values remain."""
        return self.read("lineitem").selectExpr(
            f"{CODE.format(key='l_suppkey')} as ts_code",
            f"if(l_linenumber = 7, '19950230', {STAMP.format(day='l_shipdate')}) as trade_date",
            "l_extendedprice as open", "l_extendedprice + l_quantity - 2 as high",
            "l_extendedprice as low", "l_extendedprice as close", "l_quantity - 3 as vol",
            "l_extendedprice as amount",
            "case when l_tax > 0.07 then 'nan' when l_quantity = 9 then '-1' "
            "when l_quantity = 8 then 'x' else '1.0' end as adj_factor",
        )

    @lazily
    def _listed(self) -> DataFrame:
        return self.read("supplier").selectExpr(
            "s_suppkey as key", f"{CODE.format(key='s_suppkey')} as ts_code",
            "date_add(date'1994-06-01', cast(s_suppkey * 37 % 900 as int)) as first_day",
            "if(s_suppkey % 10 = 0, date_add(date'1994-06-01', "
            "cast(s_suppkey * 37 % 900 + s_suppkey % 500 + 900 as int)), null) as last_day",
        )

    @lazily
    def securities_source(self) -> DataFrame:
        return self._listed().selectExpr(
            "ts_code", "if(key % 17 = 0, 'USD', 'CNY') as curr_type",
            f"{STAMP.format(day='first_day')} as list_date",
            f"{STAMP.format(day='last_day')} as delist_date",
            "'stock_basic/stock_basic' as _source_file", "key as _source_row",
        )

    @lazily
    def names_source(self) -> DataFrame:
        """Five name spans per security with gaps, overlaps and codes nobody lists."""
        days = "case when (key + seg) % 5 = 0 then 239 when (key + seg) % 7 = 0 then 359 else 299 end"
        return (
            self._listed().filter("key % 23 <> 5")
            .selectExpr("*", "explode(sequence(0, 4)) as seg")
            .selectExpr("*", "date_add(first_day, seg * 300) as start")
            .selectExpr(
                "if(key % 29 = 3, concat('X', ts_code), ts_code) as ts_code",
                "concat(case (key + seg) % 6 when 0 then 'st S' when 1 then '*ST S' "
                "else 'Supplier ' end, cast(key as string)) as name",
                f"{STAMP.format(day='start')} as start_date",
                f"if(seg < 4, {STAMP.format(day=f'date_add(start, {days})')}, null) as end_date",
                "'namechange/by_code' as _source_file", "key * 10 + seg as _source_row",
            )
        )

    def _line_events(self, kind: str, name: str, folder: str, *extra: str) -> DataFrame:
        return self.read("lineitem").selectExpr("*", f"{kind} as kind").filter(
            "kind is not null"
        ).selectExpr(
            f"{CODE.format(key='l_suppkey')} as ts_code",
            f"{STAMP.format(day='l_shipdate')} as trade_date", f"kind as `{name}`", *extra,
            f"concat('{folder}/', date_format(l_shipdate, 'yyyyMM')) as _source_file",
            "l_orderkey * 10 + l_linenumber as _source_row",
        )

    @lazily
    def suspensions_source(self) -> DataFrame:
        return self._line_events(
            "case when l_returnflag = 'R' and l_quantity = 50 then 'S' "
            "when l_returnflag = 'A' and l_quantity = 1 then 'R' end",
            "suspend_type", "suspend_d",
            "if(l_tax > 0.05, '09:30-10:00', null) as suspend_timing",
        )

    @lazily
    def limit_events_source(self) -> DataFrame:
        return self._line_events(
            "case cast(round(l_discount * 100) as int) when 10 then 'U' "
            "when 0 then 'D' when 5 then 'z ' end",
            "limit", "limit_list_d", "l_extendedprice as close",
        )

    @lazily
    def limit_prices_source(self) -> DataFrame:
        placeholder = "key % 6 = 2 and dayofmonth(day) = 15"
        return (
            self._day_totals().filter("key % 7 <> 0")
            .selectExpr("*", "(low_c + high_c) div 2 as mid")
            .selectExpr(
                f"{CODE.format(key='key')} as ts_code", f"{STAMP.format(day='day')} as trade_date",
                f"if({placeholder}, double(99999.99), (mid * 103 div 100) / double(100)) "
                "as up_limit",
                f"if({placeholder}, double(0), (mid * 97 div 100) / double(100)) as down_limit",
                f"concat('stk_limit/', {STAMP.format(day='day')}) as _source_file",
                "key as _source_row",
            )
        )

    # -- filings ---------------------------------------------------------------------------

    @lazily
    def _filing_totals(self) -> DataFrame:
        """Cumulative cents and counts per (customer, year), the years of a customer side by side."""
        return (
            self.read("orders")
            .selectExpr("o_custkey as key", "year(o_orderdate) as year",
                        "quarter(o_orderdate) as oq",
                        f"{CENTS.format(column='o_totalprice')} as amount")
            .groupBy("key", "year")
            .agg(
                *[F.expr(f"sum(if(oq <= {i}, amount, 0)) as c{i}") for i in (1, 2, 3, 4)],
                *[F.expr(f"count_if(oq <= {i}) as n{i}") for i in (1, 2, 3, 4)],
            )
            .repartition("key").sortWithinPartitions("key", "year")
        )

    @lazily
    def _dealt_totals(self) -> DataFrame:
        """The written totals, dealt out by customer before they are multiplied.

        Readers pack small files into few tasks. A task that shuffles more than 200 ways holds all
        the wide rows it makes, so the tasks follow the totals, not the files or the session. The
        code is made before the deal, so that Spark knows the filings' rows to lie by company.
        """
        totals = self.staged("_filing_totals").withColumn("ts_code", F.expr(
            f"if(key % 47 = 9, cast(key as string), {CODE.format(key='key')})"))
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return totals.repartition(max(least, totals.count() // TOTALS_PER_TASK), "ts_code")

    @lazily
    def _filing_rows(self) -> DataFrame:
        """Cumulative cents and counts per (customer, quarter end, variant), from written totals.

        Variants: 0 original, 1 later revision, 2 conflicting tie, 3 exact copy, 4 other type.
        """
        quarters_of_year = ", ".join(f"{i}, c{i}, n{i}" for i in (1, 2, 3, 4))
        variants = (
            "array_compact(array(0, if(key % 7 = 0, 1, null), if(key % 50 = 1, 2, null), "
            "if(key % 13 = 0, 3, null), if(key % 19 = 0, 4, null)))"
        )
        return (
            self._dealt_totals()
            .selectExpr("key", "ts_code", "year", f"stack(4, {quarters_of_year}) as (q, cum, cnt)")
            .filter("not (key % 11 = 0 and q = 2)")
            .selectExpr("*", "last_day(make_date(year, q * 3, 1)) as period",
                        f"explode({variants}) as v")
            .selectExpr(
                "*", "cum + case v when 1 then q * 100 when 2 then 7 else 0 end as restated",
                "cast(if(v = 1, if(key % 14 = 0, 200, 90), 0) as int) as late",
            )
        )

    def filing_source(self, source: str) -> DataFrame:
        """All-text filings of one table, with revisions, ties, copies, gaps and bad values."""
        ann = "date_add(period, cast(key % 45 as int) + late)"
        f_ann = "date_add(period, cast(key % 45 + key % 4 as int) + late)"
        columns = {
            "ts_code": "ts_code",
            "ann_date": f"if(key % 31 = 4 and q = 2, 'None', {STAMP.format(day=ann)})",
            "end_date": STAMP.format(day="if(key % 43 = 7, date_sub(period, 1), period)"),
            "update_flag": "if(v = 1, '1', '0')",
        }
        if source != "fina_indicator":
            columns["f_ann_date"] = f"if(key % 5 <> 0, {STAMP.format(day=f_ann)}, null)"
            columns["report_type"] = "if(v = 4, '2', '1')"
        columns.update(
            {
                "income_vip": {
                    "revenue": "case when key % 37 = 2 and q = 3 then 'n/a' "
                    "when key % 41 = 2 and q = 1 then null else cast(restated as string) end",
                    "n_income_attr_p": "cast(cum div 10 as string)",
                },
                "cashflow_vip": {
                    "n_cashflow_act": "cast(cnt * 100 + if(v = 1, 1, 0) as string)"
                },
                "balancesheet_vip": {"total_assets": "cast(restated as string)"},
                "fina_indicator": {"eps": "cast(cum div 1000 as string)"},
            }[source]
        )
        return self._filing_rows().selectExpr(
            *[f"{text} as {name}" for name, text in columns.items()],
            f"concat('{source}/by_period/', {STAMP.format(day='period')}) as _source_file",
            "key * 10 + v as _source_row",
        )

    @lazily
    def filing_sources(self) -> dict[str, DataFrame]:
        names = ("income_vip", "balancesheet_vip", "cashflow_vip", "fina_indicator")
        return {name: self.filing_source(name) for name in names}

    # -- derived tables --------------------------------------------------------------------

    @lazily
    def quotes(self) -> DataFrame:
        return prices.normalize_quotes(self.quotes_source())

    @lazily
    def untidy_quotes(self) -> DataFrame:
        return prices.normalize_quotes(self.untidy_quotes_source())

    @lazily
    def adjusted(self) -> DataFrame:
        return prices.adjusted_prices(self.quotes(), self.calendar())

    @lazily
    def securities(self) -> DataFrame:
        return state.normalize_securities(self.securities_source())

    @lazily
    def names(self) -> DataFrame:
        return state.normalize_names(self.names_source())

    @lazily
    def state(self) -> DataFrame:
        return state.security_state(self.securities(), self.names(), self.calendar())

    @lazily
    def suspensions(self) -> DataFrame:
        return feasibility.normalize_suspensions(self.suspensions_source())

    @lazily
    def limit_events(self) -> DataFrame:
        return feasibility.normalize_limit_events(self.limit_events_source())

    @lazily
    def limit_prices(self) -> DataFrame:
        return feasibility.normalize_limit_prices(self.limit_prices_source())

    def _status(self, *carried: str) -> DataFrame:
        def held(name: str) -> DataFrame:
            return self._built.get(f"staged {name}", None) or getattr(self, name)()

        return feasibility.trade_status(
            held("state"), held("adjusted"), self.suspensions(), self.limit_events(),
            self.limit_prices(), self.calendar(), TRADE_RULES, carried=carried,
        )

    @lazily
    def status(self) -> DataFrame:
        return self._status()

    @lazily
    def universe(self) -> DataFrame:
        return universe.members(
            self._status(*universe.CARRIED), DEFAULT_UNIVERSES, DEFAULT_CAPABILITIES)

    @lazily
    def filings(self) -> DataFrame:
        return filings.filings_available(
            self.filing_sources(), self.calendar(), reused=False, clustered=True)

    @lazily
    def cumulative_filings(self) -> DataFrame:
        """Only the sources the quarterly figures use."""
        sources = {name: self.filing_sources()[name] for name in METRICS}
        return filings.filings_available(sources, self.calendar(), reused=False, clustered=True)

    @lazily
    def metrics(self) -> DataFrame:
        return quarters.metrics_long(self.cumulative_filings(), METRICS)

    @lazily
    def period_versions(self) -> DataFrame:
        return quarters.period_versions(self.metrics(), clustered=True)

    @lazily
    def quarterly(self) -> DataFrame:
        return quarters.quarterly(self.period_versions())

    @lazily
    def ttm(self) -> DataFrame:
        return quarters.ttm(self.quarterly())
