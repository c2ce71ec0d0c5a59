"""Filings, quarters and TTM: hand values, edge cases and a brute-force snapshot recompute."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import fingerprint
from tidemark.functions import ranking
from tidemark.functions.ranking import split_row_number
from tidemark.operators import asof, filings, quarters

D = date
KEYS = ["source_table", "ts_code", "metric", "end_date"]


def test_available_dates(golden):
    rows = golden.filings().filter("source_table = 'income_vip' and ts_code = '300101.SZ'").orderBy(
        "effective_ann_date").collect()
    # The third was announced on a Saturday; the fourth counts from its final announcement, a Sunday.
    assert [r.available_date for r in rows] == [
        D(2021, 3, 25), D(2021, 3, 29), D(2021, 3, 29), D(2021, 4, 6), D(2021, 4, 16)]
    assert [(r.end_date, r.version) for r in rows][2:] == [
        (D(2020, 9, 30), 1), (D(2020, 12, 31), 1), (D(2020, 9, 30), 2)]


def _income(golden, *extra):
    return [*golden.rows["income_vip"], *extra]


def filed(end, revenue="1", ann="20210412", final="", code="601203.SH", kind="1"):
    """An income filing, announced once unless ``final`` says otherwise."""
    return (code, ann, ann if final == "" else final, end, kind, "0", revenue, "1")


def test_statuses(golden):
    odd = {
        "invalid_code": filed("20201231", code="601203"), "invalid_report_date": filed("20200931"),
        "missing_announcement": filed("20201231", ann=" ", final=None),
        "invalid_announcement": filed("20201231", ann="soon", final=None),
        "announcement_before_report": filed("20201231", ann="20201230"),
        "calendar_before_coverage": filed("20201231", ann="20210201"),
        "calendar_after_coverage": filed("20201231", ann="20210511"),
    }
    found = golden.filings(income_vip=_income(golden, *odd.values())).filter("source_table = 'income_vip'")
    counts = {r.availability_status: r["count"] for r in found.groupBy("availability_status").count().collect()}
    assert counts == {**dict.fromkeys(odd, 1), "available": len(golden.rows["income_vip"])}
    assert found.filter("(availability_status = 'available') = (available_date is null)").count() == 0


def test_later_announcement_wins(golden):
    extra = filed("20201231", ann="20210407", final="20210412")
    row = golden.filings(income_vip=_income(golden, extra)).filter(
        "source_table = 'income_vip' and ts_code = '601203.SH'").first()
    assert (row.effective_ann_date, row.available_date) == (D(2021, 4, 12), D(2021, 4, 13))


def test_copies_merge_and_nulls_do_not_collide(golden):
    base = golden.rows["income_vip"]
    left, right = filed("20201231")[:-1] + (None,), filed("20201231", revenue=None)
    raw = golden.frame("income_vip", [*base, *base[:1], left, right, base[0]])
    found = filings.dedup_records(raw, "income_vip")
    assert found.count() == len(base) + 2
    (copied,) = found.filter("source_count > 1").collect()
    assert (copied.source_count, copied.source_row, copied.revenue) == (3, 0, "30")
    places = filings.record_locations(raw, "income_vip").groupBy("record_id").count()
    assert places.join(found, "record_id").filter("count <> source_count").count() == 0


def test_each_source_is_scanned_twice_and_identified_once(golden, monkeypatch):
    """Once for ids and places, once for the wide rows, which are met by place and never hashed."""
    from tidemark.functions import fingerprint as marks

    calls, plain = [], marks.record_id
    monkeypatch.setattr(filings, "record_id", lambda *a: calls.append(a[0]) or plain(*a))
    plan = golden.filings()._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(calls) == sorted(golden.sources()) and "sha2" not in plan


def test_hash_survives_column_order(golden):
    raw = golden.frame("income_vip")
    turned = raw.select(*reversed(raw.columns))
    ids = filings.dedup_records(raw, "income_vip").select("record_id")
    assert ids.exceptAll(filings.dedup_records(turned, "income_vip").select("record_id")).count() == 0


@pytest.mark.parametrize("large", [0, 90, 10_000])
def test_split_numbering_equals_one_window(spark, monkeypatch, large):
    monkeypatch.setattr(ranking, "LARGE", large)
    monkeypatch.setattr(ranking, "MAX_LARGE", 10_000)
    random.seed(5)
    rows = [(random.choice("aab"), random.choice([None, "x", "y"]),
             random.choice([None, D(2020, 1, 1), D(2020, 1, 2)]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, h string, d date, i int").withColumn(
        "id", F.sha2(F.col("i").cast("string"), 256))
    plain = df.selectExpr("*", "cast(row_number() over (partition by g, h order by d nulls last, id) "
                               "as bigint) as n")
    split = split_row_number(df, ["g", "h"], "d", "id", "n")
    assert plain.exceptAll(split).count() == 0 and split.count() == 600


def test_visible_on(golden):
    found = asof.visible_on(golden.filings(), golden.calendar(), D(2021, 3, 29)).filter("source_table = 'income_vip'")
    assert {(r.ts_code, r.end_date.month) for r in found.collect()} == {
        ("300101.SZ", 3), ("300101.SZ", 6), ("300101.SZ", 9), ("688306.SH", 3)}


def _known(golden, table, day, metric="revenue", code="300101.SZ"):
    rows = asof.latest_on(table, golden.calendar(), day, KEYS).filter(
        (F.col("metric") == metric) & (F.col("ts_code") == code)).orderBy("end_date").collect()
    return [r.value for r in rows], rows


@pytest.mark.parametrize("metric, before, after, year", [
    ("revenue", [30, 40, 50, 80], [30, 40, 55, 75], 200),
    ("n_income_attr_p", [25, 40, 50, 80], [25, 40, 55, 75], 195),
    ("n_cashflow_act", [-30, -40, -50, -80], [-30, -40, -55, -75], -200),
])
def test_quarters_before_and_after_revision(golden, metric, before, after, year):
    quarterly, ttm = golden.quarters()
    assert _known(golden, quarterly, D(2021, 4, 2), metric)[0] == before[:3]
    for day, values in ((D(2021, 4, 6), before), (D(2021, 4, 15), before), (D(2021, 4, 16), after)):
        assert _known(golden, quarterly, day, metric)[0] == values
        assert _known(golden, ttm, day, metric)[0] == [None, None, None, year]


def test_missing_quarter(golden):
    quarterly, ttm = golden.quarters()
    values, rows = _known(golden, quarterly, D(2021, 4, 21), code="688306.SH")
    assert values == [12, None, 21] and rows[1].status == "missing_previous_quarter"
    last = _known(golden, ttm, D(2021, 4, 21), code="688306.SH")[1][-1]
    assert (last.value, last.status) == (None, "missing_quarter")
    assert last.missing_source_end_dates == [D(2020, 6, 30)]
    assert last.unavailable_source_end_dates == [D(2020, 9, 30)]


def test_ties_and_odd_periods(golden):
    quarterly, ttm = golden.quarters(income_vip=_income(
        golden, filed("20200331", "14"), filed("20200331", "15"), filed("20200630", "33"),
        filed("20200229", "2"), filed("20201231", "n.a."), filed("20200930", "50", kind="2"),
        # Announced on Saturday and Sunday, both are available on Monday.
        filed("20190331", "7", ann="20210424"), filed("20190331", "8", ann="20210425"),
    ))
    mine = "ts_code = '601203.SH' and metric = 'revenue'"
    found = {r.end_date: r for r in quarterly.filter(mine).collect()}
    assert {d: r.status for d, r in found.items()} == {
        D(2019, 3, 31): "available", D(2020, 2, 29): "unsupported_report_period",
        D(2020, 3, 31): "ambiguous_metric", D(2020, 6, 30): "ambiguous_metric",
        D(2020, 12, 31): "invalid_metric+missing_previous_quarter"}
    assert found[D(2019, 3, 31)].value == 8 and len(found[D(2020, 3, 31)].source_record_ids) == 2
    assert len({r.version_id for r in found.values()}) == len(found)
    totals = {r.end_date: r.status for r in ttm.filter(mine).collect()}
    assert totals[D(2020, 6, 30)] == totals[D(2020, 12, 31)] == "ambiguous_quarter"
    assert totals[D(2020, 2, 29)] == "unsupported_report_period"


def test_later_revision_keeps_earlier_versions(golden):
    unrevised = [r for r in golden.rows["income_vip"] if r[1] != "20210415"]
    early = "available_date < '2021-04-16' and source_table = 'income_vip'"
    before = golden.quarters(income_vip=unrevised)[0].filter(early).drop("version_id")
    after = golden.quarters()[0].filter(early).drop("version_id")
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0 < after.count()


# -- brute force ---------------------------------------------------------------------------


def ends(year, q):
    return [D(year, 3, 31), D(year, 6, 30), D(year, 9, 30), D(year, 12, 31)][q]


def shift(day, k):
    """The quarter end k quarters away."""
    index = day.year * 4 + day.month // 3 - 1 + k
    return ends(index // 4, index % 4)


def is_quarter(day):
    return day in [ends(day.year, q) for q in range(4)]


def snapshot(records, day):
    """Quarter and TTM figures of one group from everything visible on a day."""
    own = {}
    for period in {r["end_date"] for r in records if r["available_date"] <= day}:
        seen = [r for r in records if r["end_date"] == period and r["available_date"] <= day]
        top = max(r["effective_ann_date"] for r in seen)
        tied = [r for r in seen if r["effective_ann_date"] == top]
        claims = {(r["value_state"], r["metric_value"]) for r in tied}
        ids = sorted(r["record_id"] for r in tied)
        state, value = claims.pop() if len(claims) == 1 else ("ambiguous_metric", None)
        own[period] = (value, state, ids)
    single = {}
    for period, (value, state, ids) in own.items():
        if not is_quarter(period):
            single[period] = (None, "unsupported_report_period", ids)
        elif period.month == 3:
            single[period] = (value, state, ids)
        elif shift(period, -1) not in own:
            parts = ([] if state == "available" else [state]) + ["missing_previous_quarter"]
            single[period] = (None, "+".join(parts), ids)
        else:
            pv, ps, pids = own[shift(period, -1)]
            bad = sorted({s for s in (state, ps) if s != "available"})
            both = sorted({*ids, *pids})
            single[period] = (
                (None, "+".join(bad), both) if bad else (value - pv, "available", both))
    yearly = {}
    for period in single:
        if not is_quarter(period):
            yearly[period] = (None, "unsupported_report_period", single[period][2])
            continue
        four = [single.get(shift(period, -k)) for k in (3, 2, 1, 0)]
        there = [f for f in four if f]
        ids = sorted({i for f in there for i in f[2]})
        if any("ambiguous" in f[1] for f in there):
            yearly[period] = (None, "ambiguous_quarter", ids)
        elif any("invalid" in f[1] for f in there):
            yearly[period] = (None, "invalid_quarter", ids)
        elif len(there) < 4 or any(f[1] != "available" for f in there):
            yearly[period] = (None, "missing_quarter", ids)
        else:
            yearly[period] = (sum(f[0] for f in four), "available", ids)
    return single, yearly


def random_records(seed, groups):
    rng = random.Random(seed)
    records = []
    for g in range(groups):
        for n in range(rng.randint(3, 22)):
            period = ends(rng.choice([2018, 2019]), rng.randrange(4))
            if rng.random() < 0.05:
                period -= timedelta(days=1)
            day = D(2020, 1, 1) + timedelta(days=rng.randint(0, 30))
            state = rng.choices(["available", "missing_metric", "invalid_metric"], [8, 1, 1])[0]
            records.append({
                "source_table": "income_vip", "ts_code": f"{g:06d}.SH", "metric": "revenue",
                "end_date": period,
                # Several announcement days can share one available day.
                "effective_ann_date": day, "available_date": D(2020, 2, 1) + timedelta(
                    days=(day - D(2020, 1, 1)).days // 2),
                "record_id": f"{g}-{n:03d}",
                "metric_value": float(rng.randint(-3, 4)) if state == "available" else None,
                "value_state": state,
            })
    return records


def test_versions_equal_snapshots(spark):
    """On every day, for every group, the newest versions equal a recompute from scratch."""
    records = random_records(11, 40)
    long = spark.createDataFrame(
        records, "source_table string, ts_code string, metric string, end_date date, "
        "effective_ann_date date, available_date date, record_id string, metric_value double, "
        "value_state string")
    quarterly = quarters.quarterly(quarters.period_versions(long))
    derived = {"q": quarterly.collect(), "t": quarters.ttm(quarterly).collect()}
    checked = 0
    for code in {r["ts_code"] for r in records}:
        mine = [r for r in records if r["ts_code"] == code]
        for day in sorted({r["available_date"] for r in mine}):
            for kind, truth in zip("qt", snapshot(mine, day)):
                latest = {}
                for r in derived[kind]:
                    if r.ts_code == code and r.available_date <= day:
                        old = latest.get(r.end_date)
                        if old is None or old.available_date < r.available_date:
                            latest[r.end_date] = r
                found = {p: (r.value, r.status, list(r.source_record_ids))
                         for p, r in latest.items()}
                assert found == truth, (code, day, kind)
                checked += 1
    assert checked > 500
    for kind in "qt":  # no version repeats its predecessor
        keys = [(r.ts_code, r.end_date, r.available_date) for r in derived[kind]]
        assert len(keys) == len(set(keys))


def test_fingerprint_sees_nulls_and_order(spark):
    def mark(rows, schema="a int, b string"):
        return fingerprint(spark.createDataFrame(rows, schema)).first()

    assert mark([(1, None), (2, "x")]) == mark([(2, "x"), (1, None)]) != mark([(1, "x"), (2, None)])
    assert mark([(1, None)], "a int, b int") != mark([(None, 1)], "a int, b int")
    assert mark([([1, None],)], "a array<int>") != mark([([None, 1],)], "a array<int>")
    assert mark([]) != mark([(None, None)])


def test_filings_are_shuffled_once_and_stay_by_company(golden):
    """From raw rows to TTM no exchange follows the one that brings a company's rows together."""
    rows = filings.filings_available(golden.sources(), golden.calendar(), reused=False)
    long = quarters.metrics_long(rows, {"income_vip": ["revenue"]})
    ttm = quarters.ttm(quarters.quarterly(quarters.period_versions(long, clustered=True)))
    plan = ttm._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_companies_are_numbered_by_slices(golden, monkeypatch):
    """Whichever companies count as large, versions, counts and first places are the same."""
    extra = [golden.rows["income_vip"][0], filed("20201231", ann=" ", final=None)]
    sources = {**golden.sources(), "income_vip": golden.frame("income_vip", _income(golden, *extra, extra[0]))}
    columns = ["source_table", "record_id", "version", "source_count", "source_file", "source_row", "raw_end_date"]
    plain = filings.versioned_filings(sources).select(*columns)
    for limit in (0, 3):
        monkeypatch.setattr(filings, "LARGE", limit)
        mixed = filings.versioned_filings(sources, reused=False).select(*columns)
        assert plain.exceptAll(mixed).count() == mixed.exceptAll(plain).count() == 0 < plain.count()


def test_filings_said_to_be_dealt_out_are_numbered_right_when_they_are_not(golden):
    """The claim only saves a shuffle: rows dealt out otherwise are numbered and counted the same."""
    spread = {name: raw.repartition(5) for name, raw in golden.sources().items()}
    columns = ["source_table", "record_id", "version", "source_count", "source_file", "source_row"]
    plain = filings.versioned_filings(golden.sources(), reused=False).select(*columns)
    claimed = filings.versioned_filings(spread, reused=False, clustered=True).select(*columns)
    assert plain.exceptAll(claimed).count() == claimed.exceptAll(plain).count() == 0 < plain.count()
