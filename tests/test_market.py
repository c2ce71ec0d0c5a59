"""Calendar, prices, state, trade status and universes against hand-checked values."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from golden import CODES, FIRST, LAST, TRADE, UNIVERSES, natural_days, open_days
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.contracts import DEFAULT_CAPABILITIES, Rules, TradeRules, UniverseRule
from tidemark.operators import asof, feasibility, gates, prices, state, universe
from tidemark.operators import calendar as cal

D = date


def keyed(df, *columns):
    return {(r.ts_code, r.trade_date): tuple(r[c] for c in columns) for r in df.collect()}


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# -- calendar ------------------------------------------------------------------------------


def days(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "day date")


def test_calendar_links(golden):
    rows = golden.calendar().orderBy("trade_date").collect()
    assert [r.trade_date for r in rows] == open_days()
    assert [r.trade_index for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0].prev_trade_date is None and rows[-1].next_trade_date is None
    assert (rows[0].calendar_start, rows[0].calendar_end) == (FIRST, LAST)
    assert cal.calendar_violations(golden.calendar()).count() == 0


def test_next_and_bounds(spark, golden):
    nexts = {D(2021, 3, 26): D(2021, 3, 29), D(2021, 4, 2): D(2021, 4, 6), D(2021, 4, 4): D(2021, 4, 6),
             D(2021, 4, 30): D(2021, 5, 6), D(2021, 5, 1): D(2021, 5, 6), LAST: None, D(2022, 1, 4): None}
    found = {r.day: r for r in cal.date_facts(days(spark, *nexts), golden.calendar(), "day").collect()}
    assert {d: r.next_trade_date for d, r in found.items()} == nexts
    assert found[D(2021, 4, 4)].is_trade_date is False and found[LAST].is_trade_date is True
    assert found[D(2022, 1, 4)].is_trade_date is None
    strict = cal.require_in_coverage(
        cal.date_facts(days(spark, LAST), golden.calendar(), "day"), golden.calendar(), "day", "next_trade_date")
    with pytest.raises(PySparkException, match="outside calendar coverage"):
        strict.collect()


def test_offsets(spark, golden):
    def moved(n, *asked):
        rows = cal.offset_days(days(spark, *asked), golden.calendar(), "day", n, "moved").collect()
        return {r.day: r.moved for r in rows}

    assert moved(-1, FIRST, D(2021, 4, 6), D(2021, 5, 6), D(2021, 4, 5)) == {
        FIRST: None, D(2021, 4, 6): D(2021, 4, 2), D(2021, 5, 6): D(2021, 4, 30), D(2021, 4, 5): None}
    assert moved(3, D(2021, 4, 1), D(2021, 5, 7)) == {D(2021, 4, 1): D(2021, 4, 7), D(2021, 5, 7): None}
    with pytest.raises(cal.CalendarError):
        moved(True, FIRST)


def test_pinned_calendar_knows_its_bounds(golden):
    plain, pinned = golden.calendar(), cal.pinned(golden.calendar())
    same(plain, pinned)
    asked = pinned.select(*[c.alias(n) for c, n in zip(cal.bounds(pinned), "abc")]).limit(1)
    assert tuple(asked.first()) == (FIRST, LAST, len(open_days()))
    assert "Subquery" not in asked._jdf.queryExecution().executedPlan().toString()
    panel = asof.panel_calendar(pinned, "day(trade_date) < 8")
    assert panel.select(cal.bounds(panel)[2]).first()[0] == panel.count() == 6


def test_spine_against_brute_force(golden):
    opened = open_days()
    for r in cal.spine(golden.calendar()).collect():
        d = r.cal_date
        after, before = [o for o in opened if o >= d], [o for o in opened if o < d]
        assert r.index_on_or_after == (opened.index(after[0]) + 1 if after else None)
        assert r.index_before == (len(before) or None)
        assert r.index_on_or_before == (len([o for o in opened if o <= d]) or None)
        assert r.next_trade_date == next((o for o in opened if o > d), None)
        assert r.prev_trade_date == (before[-1] if before else None)


@pytest.mark.parametrize("change, problem", [
    (lambda rows: rows + rows[:1], "duplicate_date"),
    (lambda rows: rows[:5] + rows[6:], "missing_natural_day"),
    (lambda rows: [("SSE", "20210332", "1", None)] + rows[1:], "invalid_date"),
    (lambda rows: [(*rows[0][:2], "yes", None)] + rows[1:], "invalid_is_open"),
    (lambda rows: [(*r[:2], "0", None) for r in rows], "no_open_day"),
    (lambda rows: [("XX", *r[1:]) for r in rows], "no_source_rows"),
])
def test_calendar_gate(golden, change, problem):
    source = golden.frame("trade_cal", change(golden.rows["trade_cal"]))
    with pytest.raises(cal.CalendarError, match=problem):
        cal.validate_calendar_source(source, "SSE")


def test_slice_outside_coverage(golden):
    for calendar in (golden.calendar(), cal.pinned(golden.calendar())):
        for day in (D(2021, 3, 21), D(2021, 5, 12)):
            with pytest.raises(cal.CalendarError, match="outside calendar coverage"):
                cal.slice_days(golden.prices(), calendar, day, None)
    with pytest.raises(cal.CalendarError, match="after its end"):
        golden.prices(start=D(2021, 4, 9), end=D(2021, 4, 8))


# -- prices --------------------------------------------------------------------------------


def test_returns(golden):
    found = keyed(golden.prices(), "ret_1d", "return_status", "adjusted_close")
    split, traded = "300101.SZ", "300102.SZ"
    assert found[split, FIRST][:2] == (None, "no_previous_quote")
    assert found[split, D(2021, 4, 9)][2] == pytest.approx(54)
    assert found[split, D(2021, 4, 12)][0] == pytest.approx(1 / 54)  # the split is no loss
    assert [found[traded, D(2021, 4, d)][0] for d in (13, 14, 15)] == pytest.approx([0.1, -5 / 55, -0.1])
    for d in (12, 22):
        assert found[traded, D(2021, 4, d)][:2] == (None, "missing_previous_trading_day")
    assert found[traded, D(2021, 4, 23)][0] == pytest.approx(0)


def test_price_slice_keeps_previous_quote(golden):
    start, end = D(2021, 4, 13), D(2021, 4, 20)
    same(golden.prices(start=start, end=end), golden.prices().filter(F.col("trade_date").between(start, end)))


def test_future_quote_does_not_change_past(golden):
    rows = [(*r[:5], r[3], *r[6:]) if r[1] == "20210510" else r for r in golden.rows["stk_factor_pro"]]
    drop = ["raw_trade_date", "source_row"]
    changed, plain = golden.prices(rows).drop(*drop), golden.prices().drop(*drop)
    same(changed.filter("trade_date < '2021-05-10'"), plain.filter("trade_date < '2021-05-10'"))
    assert changed.exceptAll(plain).count() > 0


@pytest.mark.parametrize("column, value", [
    ("adj_factor", "0"), ("adj_factor", "-2"), ("adj_factor", "NaN"), ("adj_factor", "-inf"),
    ("adj_factor", "1e999"), ("adj_factor", None), ("close", "0"), ("close", "4000"), ("open", "nan"),
    ("high", "inf"), ("low", "-3"), ("vol", "-1"), ("trade_date", "20210431"), ("trade_date", "20210405"),
    ("ts_code", "  "),
])
def test_quote_gate(golden, column, value):
    at = golden.columns["stk_factor_pro"].split().index(column)
    rows = list(golden.rows["stk_factor_pro"])
    rows[7] = (*rows[7][:at], value, *rows[7][at + 1:])
    with pytest.raises(gates.GateError):
        prices.gate_quotes(prices.normalize_quotes(golden.frame("stk_factor_pro", rows)), golden.calendar())


def test_quote_gate_duplicates_and_clean(golden):
    rows = golden.rows["stk_factor_pro"]
    prices.gate_quotes(prices.normalize_quotes(golden.frame("stk_factor_pro")), golden.calendar())
    twice = prices.normalize_quotes(golden.frame("stk_factor_pro", rows + rows[:1]))
    with pytest.raises(gates.GateError, match="duplicate"):
        prices.gate_quotes(twice, golden.calendar())


# -- state ---------------------------------------------------------------------------------


def test_state_by_hand(golden):
    found = keyed(golden.state(), "is_st", "is_star_st", "listing_trade_days", "listing_natural_days",
                  "is_listed", "is_delisted", "estimated_listing_trade_days", "historical_state_status")
    assert len(found) == 6 * 33
    for day in open_days():
        st, star = found["601204.SH", day][:2]
        if day < D(2021, 4, 28):
            assert (st, star) == (day >= D(2021, 4, 2), day >= D(2021, 4, 12))
        else:
            assert (st, star) == (None, None)
        assert found["688306.SH", day][0] == (day < D(2021, 4, 19))
        uncovered = day in (D(2021, 4, 8), D(2021, 4, 9))
        assert (found["430305.BJ", day][7] == "namechange_uncovered") == uncovered
        assert found["430305.BJ", day][0] == (None if uncovered else False)
    assert [found["601203.SH", D(2021, 4, d)][2] for d in (13, 14, 15, 16)] == [0, 1, 2, 3]
    assert found["601204.SH", D(2021, 4, 27)][2:6] == (26, 36, True, False)
    assert found["601204.SH", D(2021, 4, 28)][3:6] == (36, False, True)
    assert found["300101.SZ", D(2021, 4, 20)][3] == 29 and found["300101.SZ", D(2021, 4, 20)][6] == 20


def test_name_overlaps_gaps_and_return_of_an_earlier_name(golden):
    code = "300101.SZ"
    rows = [r for r in golden.rows["namechange"] if r[0] != code] + [
        (code, "Alpha", "20210322", "20210331", None), (code, "ST Alpha", "20210406", "20210413", None),
        (code, "Alpha B", "20210409", "20210420", None), (code, "*ST Alpha", "20210422", None, None),
        (code, "ST Omega", "20210427", "20210429", None),
    ]
    found = keyed(golden.state(rows), "is_st", "is_star_st", "historical_state_status", "historical_name")
    told = {d: found[code, D(2021, *d)] for d in ((4, 1), (4, 12), (4, 19), (4, 21), (4, 28), (4, 30))}
    assert told[4, 1] == told[4, 21] == (None, None, "namechange_uncovered", None)
    assert told[4, 12] == (None, False, "namechange_ambiguous", "Alpha B")
    assert told[4, 19] == (False, False, "namechange_derived", "Alpha B")
    assert told[4, 28] == (True, None, "namechange_ambiguous", "ST Omega")
    assert told[4, 30] == (True, True, "namechange_derived", "*ST Alpha")


def test_segments_equal_a_count_of_days(spark, golden):
    """Random spans with ties, nesting and gaps: the sweep against every interval on every day."""
    rng, opened = random.Random(4), open_days()
    spans = []
    for i in range(60):
        lo = rng.choice(natural_days())
        hi = None if rng.random() < 0.2 else lo + timedelta(rng.randint(0, 25))
        spans.append((f"c{i % 7}", rng.choice(["ST a", "*ST b", "c"]), f"{lo:%Y%m%d}", hi and f"{hi:%Y%m%d}", None))
    names = state.normalize_names(golden.frame("namechange", spans))
    got = {(r.ts_code, r.trade_date): (r.covering_intervals, r.any_st, r.all_st, r.any_star_st, r.all_star_st,
                                       r.historical_name, r.name_source_row)
           for r in state.name_facts(names, golden.calendar()).collect()}
    want = {}
    for code in {s[0] for s in spans}:
        for day in opened:
            stamp = f"{day:%Y%m%d}"
            on = [(i, s) for i, s in enumerate(spans) if s[0] == code and s[2] <= stamp and (s[3] or "9") >= stamp]
            if on:
                row, pick = min(on, key=lambda x: (-int(x[1][2]), x[0]))
                st, star = ["ST" in s[1] for _, s in on], ["*ST" in s[1] for _, s in on]
                want[code, day] = (len(on), any(st), all(st), any(star), all(star), pick[1], row)
    assert got == want


def test_state_expands_spans_without_shuffling_days(golden):
    calendar = cal.pinned(golden.calendar())
    held = state.security_state(state.normalize_securities(golden.frame("stock_basic")),
                                state.normalize_names(golden.frame("namechange")), calendar)
    plan = held._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("sequence(")]
    assert "Aggregate" not in above and "hashpartitioning" not in above and "Subquery" not in plan


def _listed_before(golden, code, *dates):
    return [(*r[:6], *dates, *r[6 + len(dates):]) if r[0] == code else r for r in golden.rows["stock_basic"]]


def test_left_censored_age(golden):
    found = keyed(golden.state(basic=_listed_before(golden, "300101.SZ", "20110105")), "listing_trade_days",
                  "listing_trade_days_lower_bound", "listing_age_status")
    assert found["300101.SZ", FIRST] == (None, 1, "left_censored")
    assert found["300102.SZ", FIRST] == (1, 1, "exact")


def test_delisted_before_calendar(golden):
    found = keyed(golden.state(basic=_listed_before(golden, "300101.SZ", "20110105", "20160104")),
                  "is_delisted", "listing_trade_days_lower_bound")
    assert found["300101.SZ", LAST] == (True, 0)


def test_state_slice_equals_full(golden):
    start, end = D(2021, 4, 9), D(2021, 4, 28)
    same(golden.state(start=start, end=end), golden.state().filter(F.col("trade_date").between(start, end)))


def test_future_name_does_not_change_past(golden):
    rows = [r for r in golden.rows["namechange"] if r[1] != "Delta"] + [
        ("688306.SH", "Delta", "20210419", "20210506", None), ("688306.SH", "ST Delta", "20210507", None, None)]
    changed, plain = golden.state(rows).drop("name_source_row"), golden.state().drop("name_source_row")
    same(changed.filter("trade_date < '2021-05-07'"), plain.filter("trade_date < '2021-05-07'"))
    assert changed.filter("trade_date >= '2021-05-07' and ts_code = '688306.SH' and is_st").count() == 3


@pytest.mark.parametrize("row", [
    ("300101", "n", "20210401", None, None), ("300101.SZ\n", "n", "20210401", None, None),
    ("300101.SZ", "  ", "20210401", None, None), ("300101.SZ", "n", "20210431", None, None),
    ("300101.SZ", "n", "20210401", "later", None), ("300101.SZ", "n", "20210401", "20210331", None),
    ("601204.SH", "once more", "20210402", None, None),
])
def test_name_gate(golden, row):
    names = state.normalize_names(golden.frame("namechange", golden.rows["namechange"] + [row]))
    with pytest.raises(gates.GateError):
        state.gate_names(names)


def test_security_gate_and_diagnostics(golden):
    rows = golden.rows["stock_basic"]
    securities = state.normalize_securities(golden.frame("stock_basic"))
    state.gate_securities(securities)
    for bad in ([*rows, rows[-1]], _listed_before(golden, "601204.SH", "20210322", "20210301")):
        with pytest.raises(gates.GateError):
            state.gate_securities(state.normalize_securities(golden.frame("stock_basic", bad)))
    names = state.normalize_names(golden.frame("namechange", [
        ("999998.SH", "n", "20210401", None, None), ("300101.SZ", "n", "20210401", None, None)]))
    assert [r.ts_code for r in state.unmatched_name_codes(names, securities).collect()] == ["999998.SH"]
    row = state.interval_coverage(names, securities).first()
    assert (row.stocks_without_namechange, row.stocks_with_late_first_interval) == (5, 1)


# -- trade status --------------------------------------------------------------------------


def test_trade_by_hand(golden):
    found = keyed(golden.status(), "can_buy", "can_sell", "is_suspended", "cannot_buy_reason", "cannot_sell_reason")
    code, halted, absent = "300102.SZ", "FULL_DAY_SUSPENSION", "NO_QUOTE"
    for d in (8, 9):
        assert found[code, D(2021, 4, d)] == (False, False, True, halted, halted)
    assert found[code, D(2021, 4, 13)] == (False, True, False, "LIMIT_UP", None)
    assert found[code, D(2021, 4, 14)] == (True, True, False, None, None)
    assert found[code, D(2021, 4, 15)] == (True, False, False, None, "LIMIT_DOWN")
    assert found[code, D(2021, 4, 21)] == (False, False, False, absent, absent)
    assert found["601204.SH", D(2021, 4, 28)][3] == "DELISTED"
    assert found["601203.SH", D(2021, 4, 13)][3] == "NOT_LISTED"


PARTLY = TradeRules(coverage_start=FIRST, coverage_end=LAST)


def test_unknowns_kept_without_declared_coverage(golden):
    nothing = TradeRules(suspension_events_complete=False, limit_events_complete=False)
    found = keyed(golden.status(nothing), "is_suspended", "can_buy", "cannot_buy_reason", "is_limit_up")
    unknown = "SUSPENSION_STATUS_UNKNOWN"
    assert found["688306.SH", D(2021, 4, 7)] == (None, None, unknown, None)
    assert found["688306.SH", D(2021, 4, 22)] == (None, None, unknown, False)
    assert found["430305.BJ", D(2021, 4, 22)][3] is None  # a placeholder limit is no evidence
    found = keyed(golden.status(PARTLY), "is_suspended", "cannot_buy_reason")
    assert found["430305.BJ", D(2021, 4, 22)] == (None, unknown)
    assert found["300101.SZ", D(2021, 4, 7)] == (False, "LIMIT_STATUS_UNKNOWN")


def test_intraday_and_opened_limit(golden):
    status = golden.status(
        PARTLY, suspend_d=[("300101.SZ", "20210407", "13:00-14:00", "s "), ("300101.SZ", "20210412", None, "R")],
        limit_list_d=[("20210413", "300101.SZ", "1", "Z")])
    found = keyed(status, "cannot_buy_reason", "is_intraday_suspended", "is_full_day_suspended",
                  "has_resume_event", "is_limit_up", "is_limit_down")
    assert found["300101.SZ", D(2021, 4, 7)][:3] == ("INTRADAY_SUSPENSION", True, False)
    assert found["300101.SZ", D(2021, 4, 12)][3] is True
    assert found["300101.SZ", D(2021, 4, 13)][4:] == (False, False)


def test_status_slice_equals_full(golden):
    start, end = D(2021, 4, 8), D(2021, 4, 22)
    same(golden.status(start=start, end=end), golden.status().filter(F.col("trade_date").between(start, end)))


def _gate(golden, held=None, **rows):
    feasibility.gate_trade_inputs(
        golden.state() if held is None else held, golden.prices(),
        prices.normalize_quotes(golden.frame("stk_factor_pro")),
        state.normalize_securities(golden.frame("stock_basic")), *golden.events(**rows), golden.calendar(), TRADE)


def test_trade_gates(golden):
    limits = golden.rows["stk_limit"]
    _gate(golden)
    for rows in (
        {"suspend_d": [("300102.SZ", "20210408", None, "HALT")]},
        {"suspend_d": [("300102.SZ", "20210431", None, "S")]},
        {"limit_list_d": [("20210413", "300102.SZ", "55", None)]},
        {"stk_limit": [*limits, limits[-1]]},
        {"stk_limit": [r for r in limits if r[0] != "20210419"]},
    ):
        with pytest.raises(gates.GateError):
            _gate(golden, **rows)
    holed = golden.state().filter("not (trade_date = '2021-04-19' and ts_code = '430305.BJ')")
    with pytest.raises(gates.GateError, match="incomplete coverage"):
        _gate(golden, held=holed)


def test_event_diagnostics(golden):
    _, strangers, _ = golden.events(limit_list_d=[("20210413", "999998.SH", "1", "U")])
    assert feasibility.unmatched_events(strangers, golden.state()).count() == 1
    conflicting = golden.status(limit_list_d=[("20210414", "300102.SZ", "1", "U")])
    assert [(r.ts_code, r.trade_date) for r in feasibility.limit_conflicts(conflicting).collect()] == [
        ("300102.SZ", D(2021, 4, 14))]


# -- universe ------------------------------------------------------------------------------


def test_universe_by_hand(golden):
    found = {(r.universe_id, r.ts_code, r.trade_date): r.is_in_universe for r in golden.universe().collect()}
    assert len(found) == len(UNIVERSES) * len(CODES) * len(open_days())

    def members(name, code, *dates):
        return [found[name, code, D(2021, 4, d)] for d in dates]

    assert members("whole", "601204.SH", 27, 28) == [True, False]
    assert members("whole", "300102.SZ", 8) == [True]  # a suspended security stays a member
    assert members("clean", "601204.SH", 1, 2, 12) == [True, False, False]
    assert members("clean", "430305.BJ", 7, 8, 12) == [True, None, True]
    assert members("seasoned", "601203.SH", 13, 15, 16) == [False, False, True]
    assert members("no_bj", "430305.BJ", 22) == [False] and members("no_bj", "300101.SZ", 22) == [True]
    assert members("whole", "688306.SH", 22) == [False]  # quoted in dollars


def test_universe_unknowns(golden):
    held = golden.state(names=[r for r in golden.rows["namechange"] if r[0] != "300102.SZ"],
                        basic=_listed_before(golden, "300101.SZ", "20110105"))
    rules = (UniverseRule("st", True, False, 0), UniverseRule("old", False, False, 3))
    result = universe.research_universe(held, golden.status(), golden.calendar(), rules, DEFAULT_CAPABILITIES)
    found = {(r.universe_id, r.ts_code, r.trade_date): (r.is_in_universe, r.exclusion_reason)
             for r in result.collect()}
    assert found["st", "300102.SZ", FIRST] == (None, "ST_STATUS_UNKNOWN")
    assert found["old", "300101.SZ", D(2021, 3, 23)] == (None, "LISTING_AGE_UNKNOWN")
    assert found["old", "300101.SZ", D(2021, 3, 24)] == (True, None)  # the lower bound proves it


def test_universe_rules_validated():
    first = universe.describe_rules(UNIVERSES, DEFAULT_CAPABILITIES)
    assert first == universe.describe_rules(UNIVERSES, DEFAULT_CAPABILITIES)
    for bad in ((), (UNIVERSES[0], UNIVERSES[0]), (UniverseRule("x", 1, False, 0),),
                (UniverseRule("x", False, False, -1),), (UniverseRule("x", False, False, True),)):
        with pytest.raises(ValueError):
            universe.describe_rules(bad, DEFAULT_CAPABILITIES)
    with pytest.raises(ValueError, match="historical_st"):
        universe.describe_rules(UNIVERSES, {"historical_st": "deferred"})


def test_universe_gate(golden):
    with pytest.raises(gates.GateError):
        universe.gate_universe_inputs(
            golden.state(), golden.status().filter("ts_code <> '430305.BJ'"), golden.calendar())


def test_policies_refused():
    with pytest.raises(ValueError):
        Rules(policies={**Rules().policies, "overlap_policy": "latest_wins"})
    with pytest.raises(ValueError):
        Rules(cumulative_metrics={"balancesheet_vip": ["total_assets"]})
    with pytest.raises(ValueError):
        TradeRules(suspension_complete_code_suffixes=("XX",))


def test_panel(spark, golden):
    versions = spark.createDataFrame(
        [("k", D(2021, 3, 25), 1), ("k", D(2021, 4, 14), 2)], "k string, available_date date, v int")
    wanted = [D(2021, 3, 24), D(2021, 3, 31), D(2021, 4, 13), D(2021, 4, 14), D(2021, 5, 6)]
    ends = asof.panel_calendar(golden.calendar(), F.col("trade_date").isin(wanted))
    found = {r.trade_date: r.v for r in asof.asof_panel(versions, ends, ["k"]).collect()}
    assert found == dict(zip(wanted[1:], (1, 1, 2, 2)))


def test_panels_against_every_day_asked(spark, golden):
    """Totals by differences and the newest periods, held against a plain walk over the days."""
    calendar = golden.calendar()
    ends = asof.panel_calendar(calendar, "dayofweek(trade_date) = 6")
    days = sorted(r.trade_date for r in ends.collect())
    every = sorted(r.trade_date for r in calendar.collect())
    rows = []
    for i in range(90):
        key, period = f"k{i % 3}", date(2001, 1 + i % 7, 1)
        rows.append((key, period, every[(i * 11) % len(every)], i % 4, None if i % 5 == 0 else i))
    rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
    versions = spark.createDataFrame(
        rows, "k string, period date, available_date date, kind int, value bigint").repartition(4)
    seen = {}
    for day in days:
        for r in sorted(rows, key=lambda r: r[2]):
            if r[2] <= day:
                seen[day, r[0], r[1]] = r
    totals = {}
    for (day, _, _), r in seen.items():
        n, values = totals.get((day, r[3]), (0, []))
        totals[day, r[3]] = (n + 1, values + ([] if r[4] is None else [r[4]]))
    got = asof.panel_totals(versions, ends, ["k", "period"], ["kind"], "value").collect()
    assert {(r.trade_date, r.kind): (r.n, None if r.total is None else int(r.total)) for r in got} == {
        k: (n, sum(v) if v else None) for k, (n, v) in totals.items()}
    for n in (1, 2, 3):
        wanted = set()
        for day in days:
            for key in ("k0", "k1", "k2"):
                mine = sorted((p for d, k, p in seen if (d, k) == (day, key)), reverse=True)[:n]
                wanted |= {(day, key, p, seen[day, key, p][2]) for p in mine}
        got = asof.newest_panel(versions, ends, ["k", "period"], "period", n).collect()
        assert len(got) == len(wanted)
        assert {(r.trade_date, r.k, r.period, r.available_date) for r in got} == wanted
    none = versions.filter("false")
    assert asof.panel_totals(none, ends, ["k", "period"], ["kind"], "value").count() == 0
    assert asof.newest_panel(none, ends, ["k", "period"], "period").count() == 0


def test_the_grid_is_neither_sorted_nor_shuffled_again(golden):
    """One join per input by hash; membership follows in the same rows, without another join."""
    from tidemark.contracts import DEFAULT_UNIVERSES
    from tidemark.operators import universe

    status = feasibility.trade_status(
        golden.state(), golden.prices(), *golden.events(), golden.calendar(), TRADE, carried=universe.CARRIED)
    found = universe.members(status, DEFAULT_UNIVERSES, DEFAULT_CAPABILITIES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [trade_date" not in plan and plan.count("ShuffledHashJoin [trade_date") >= 4
    plain = universe.research_universe(
        golden.state(), status, golden.calendar(), DEFAULT_UNIVERSES, DEFAULT_CAPABILITIES)
    assert plain.exceptAll(found).count() == found.exceptAll(plain).count() == 0 < plain.count()
