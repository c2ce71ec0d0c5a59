"""Sources, publishing, the full build and quality checks on damaged tables."""

from __future__ import annotations

import dataclasses
import hashlib
import os
import tempfile
from datetime import date

import pytest
from golden import RULES
from pyspark.sql import functions as F

from tidemark.contracts import SOURCE_CONTRACTS, SourceContract
from tidemark.operators import asof, backfill, compare, profile
from tidemark.operators import calendar as cal
from tidemark.operators import state as st
from tidemark.operators.gates import GateError
from tidemark.plans.build import BuildError, build
from tidemark.quality import report
from tidemark.sources import tables
from tidemark.sources.publish import CommitConflict, PublishError, Warehouse, key_gate


def fresh(name: str) -> str:
    return os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), name)


@pytest.fixture(scope="module")
def built(spark, golden):
    """One full build of the golden market; its tables feed the damage tests."""
    warehouse = Warehouse(spark, fresh("warehouse"))
    verdict = build(warehouse, golden.raw(), RULES)
    return warehouse, verdict


@pytest.fixture(scope="module")
def published(built, golden):
    warehouse, _ = built
    names = ("daily_calendar", "daily_adjusted_price", "daily_stock_state", "daily_trade_status",
             "financial_available", "quarterly_financial", "ttm_financial",
             "research_universe_config", "daily_research_universe", "filing_locations")
    found = {name: warehouse.read(name).cache() for name in names}
    from tidemark.operators import feasibility, prices

    found.update(
        calendar_source=golden.frame("trade_cal"), filing_sources=golden.sources(),
        quotes=prices.normalize_quotes(golden.frame("stk_factor_pro")),
        securities=st.normalize_securities(golden.frame("stock_basic")),
        names=st.normalize_names(golden.frame("namechange")),
        limit_prices=feasibility.normalize_limit_prices(golden.frame("stk_limit")),
    )
    return found


def test_build_passes(built):
    warehouse, verdict = built
    assert verdict["passed"] and not verdict["full_phase_passed"]
    assert verdict["diagnostics"]["invalid_limit_prices"] == 1
    rows = {r.table_name: r for r in warehouse.manifest().collect()}
    assert {"daily_calendar", "ttm_financial", "daily_research_universe"} <= set(rows)
    assert rows["daily_stock_state"].row_count == 6 * 33
    assert list(rows["daily_adjusted_price"].upstream) == ["daily_calendar"]
    for name in ("financial_available", "daily_adjusted_price"):
        assert report.content_problems(name, warehouse.read(name), rows[name]).count() == 0
        assert report.schema_problems(name, warehouse.read(name)) == []
    problems = report.manifest_problems(warehouse.manifest(), "other").collect()
    assert {r.problem for r in problems} == {"stale_configuration"}


def test_report_is_published(built):
    """Every check of the build with its outcome, and the statistics of every output."""
    warehouse, _ = built
    rows = warehouse.read("quality_report").collect()
    assert {r.component for r in rows} == set(report.COMPONENTS) and not any(r.violations for r in rows)
    ran = {(r.table_name, r.check_name) for r in rows}
    assert {("daily_stock_state", "invented_history"), ("ttm_financial", "four_source_quarters")} <= ran
    held = warehouse.read("table_statistics").filter("column_name = 'ts_code'").collect()
    assert {r.table_name: r.row_count for r in held}["daily_stock_state"] == 6 * 33


def test_absent_source_stops_build(spark, golden):
    raw = {n: df for n, df in golden.raw().items() if n != "fina_indicator"}
    warehouse = Warehouse(spark, fresh("warehouse"))
    with pytest.raises(BuildError, match="fina_indicator"):
        build(warehouse, raw, RULES)
    assert warehouse.manifest().count() == 0


def test_changed_content_fails_the_report(spark):
    from tidemark.plans.build import _publish_report

    warehouse = Warehouse(spark, fresh("warehouse"))
    days = spark.sql("select date'2021-04-01' as trade_date, 1L as trade_index")
    row = warehouse.publish("l1", "daily_calendar", days, ["trade_date"])
    passed = [{"component": "c", "table_name": "t", "check_name": "x", "violations": 0, "example": None}]
    assert _publish_report(warehouse, passed) == []
    days.withColumn("trade_index", F.lit(2).cast("bigint")).write.mode("overwrite").parquet(row["location"])
    assert _publish_report(warehouse, passed) == [
        {"table_name": "daily_calendar", "check_name": "content_fingerprint"}]


def test_published_order(built):
    warehouse, _ = built
    table = warehouse.read("daily_trade_status")
    rows = table.selectExpr("_metadata.file_path as f", "_metadata.row_index as i", "trade_date", "ts_code",
                            "trade_date_month as m").orderBy("f", "i").collect()
    files = {r.f: r.m for r in rows}
    assert len(files) > 1 and all(f"trade_date_month={m}/" in f for f, m in files.items())
    for name in files:
        keys = [(r.trade_date, r.ts_code) for r in rows if r.f == name]
        assert keys == sorted(keys)


def test_slices_read_only_their_months(built):
    """The day asked for reaches the scans of published tables, and days outside still raise."""
    warehouse, _ = built
    warehouse.spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    calendar = cal.bounded(warehouse.read("daily_calendar"))
    day = date(2021, 4, 15)

    def scan(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [x for x in plan.splitlines() if "FileScan" in x and "_month" in x]
        assert found, plan
        return found

    keys = ["source_table", "ts_code", "metric", "end_date"]
    sliced = {
        "financial_available": lambda t, d: asof.visible_on(t, calendar, d),
        "quarterly_financial": lambda t, d: asof.latest_on(t, calendar, d, keys),
        "daily_stock_state": lambda t, d: cal.slice_days(t, calendar, d, d),
    }
    for name, build_slice in sliced.items():
        column = "trade_date" if name == "daily_stock_state" else "available_date"
        for line in scan(build_slice(warehouse.read(name), day)):
            parts, pushed = line.split("PartitionFilters: [")[1].split("PushedFilters: [")
            assert f"{column}_month" in parts and "2021-04" in parts, line
            assert f"({column},2021-04-15)" in pushed, line
        assert build_slice(warehouse.read(name), day).count() > 0 or name == "quarterly_financial"
        with pytest.raises(cal.CalendarError, match="outside"):
            build_slice(warehouse.read(name), date(2031, 1, 1))


def test_bad_input_publishes_nothing(spark, golden):
    warehouse = Warehouse(spark, fresh("warehouse"))
    raw = golden.raw()
    raw["stk_factor_pro"] = golden.frame(
        "stk_factor_pro", [(*r[:8], "-1") for r in golden.rows["stk_factor_pro"]])
    with pytest.raises(GateError):
        build(warehouse, raw, RULES)
    assert warehouse.entry("daily_calendar") is not None
    assert warehouse.entry("daily_adjusted_price") is None


def test_publish_gate_and_versions(spark):
    warehouse = Warehouse(spark, fresh("warehouse"), "c")
    good = spark.range(10).selectExpr("id", "id % 3 as v")
    assert warehouse.publish("l1", "t", good, ["id"])["version"] == 1
    for bad in (good.selectExpr("v as id", "v"), good.selectExpr("nullif(id, 3) as id", "v")):
        with pytest.raises(PublishError):
            warehouse.publish("l1", "t", bad, ["id"])
    assert warehouse.read("t").count() == 10
    assert warehouse.publish("l1", "t", good.filter("id < 4"), ["id"])["version"] == 2
    assert warehouse.read("t").count() == 4 and warehouse.manifest(latest=False).count() == 2
    assert warehouse.publish("l1", "u", good, ["id"])["upstream"].keys() == {"t"}
    warehouse.publish("l1", "t", good, ["id"])
    assert [r.problem for r in report.manifest_problems(warehouse.manifest(), "c").collect()] == [
        "stale_upstream:t"]
    with pytest.raises(PublishError):
        warehouse.read("absent")
    late = warehouse.prepare("l1", "t", good, ["id"])
    warehouse.publish("l1", "t", good.filter("id < 2"), ["id"])
    with pytest.raises(CommitConflict, match="version"):
        warehouse.commit(late)
    assert warehouse.read("t").count() == 2 and not os.path.exists(late["location"])
    gate = key_gate(good.union(good.limit(1)), ["id"]).first()
    assert (gate.row_count, gate.null_key_rows, gate.duplicate_rows) == (11, 0, 1)


# Each case damages one cell or row and names the check that must see it.
DAMAGE = {
    ("daily_calendar", "calendar_consistency"): {"trade_index": "trade_index + 1"},
    ("daily_calendar", "source_calendar_coverage"): {"calendar_end": "date_add(calendar_end, 1)"},
    ("daily_adjusted_price", "non_trading_date"): {"trade_date": "date'2021-04-10'"},
    ("daily_adjusted_price", "adjustment"): {"adjusted_open": "adjusted_open + 1"},
    ("daily_adjusted_price", "return_across_gap"): {
        "prev_quote_date": "date'2021-03-01'", "ret_1d": "1.0"},
    ("daily_adjusted_price", "return_value"): {"ret_1d": "0.5"},
    ("daily_adjusted_price", "invented_quote"): {"ts_code": "'999998.SH'"},
    ("daily_adjusted_price", "raw_price_coverage"): {"ts_code": "'999998.SH'"},
    ("daily_adjusted_price", "original_source_values"): {"vol": "vol + 1"},
    ("daily_adjusted_price", "null_primary_key"): {"ts_code": "null"},
    ("daily_stock_state", "historical_listing"): {"is_delisted": "not is_delisted"},
    ("daily_stock_state", "invented_history"): {"board": "'main'"},
    ("daily_stock_state", "missing_security_date"): {"ts_code": "'999998.SH'"},
    ("daily_trade_status", "directional_constraints"): {"is_suspended": "true"},
    ("daily_trade_status", "unknown_and_reasons"): {"can_buy": "null"},
    ("daily_trade_status", "limit_price_sources"): {"limit_price_exists": "not limit_price_exists"},
    ("daily_trade_status", "missing_security_date"): {"trade_date": "date'2021-04-10'"},
    ("financial_available", "original_date_consistency"): {"end_date": "date'2018-01-01'"},
    ("financial_available", "invalid_record_must_not_be_available"): {"ts_code": "'bad'"},
    ("financial_available", "strict_announcement_delay"): {"available_date": "ann_date"},
    ("financial_available", "original_record_hash"): {"update_flag": "'9'"},
    ("financial_available", "location_reconciliation"): {"source_row": "source_row + 1"},
    ("financial_available", "source_conservation"): {"source_count": "source_count + 1"},
    ("quarterly_financial", "value_status"): {"value": "null", "status": "'available'"},
    ("quarterly_financial", "cumulative_metric_whitelist"): {"metric": "'total_assets'"},
    ("quarterly_financial", "source_periods"): {"source_end_dates": "array(date'2018-01-31')",
                                                "status": "'available'"},
    ("quarterly_financial", "source_record_lineage"): {"source_record_ids": "array('none')"},
    ("quarterly_financial", "latest_visible_source_versions"): {
        "source_record_ids": "array('none')"},
    ("quarterly_financial", "cumulative_difference_value"): {"value": "12345.0"},
    ("ttm_financial", "four_source_quarters"): {"source_quarter_ids": "array('a', 'b')",
                                                "status": "'available'"},
    ("ttm_financial", "quarter_lineage_and_sum"): {"source_quarter_ids": "array('none')"},
    ("ttm_financial", "original_record_lineage"): {"source_record_ids": "array('none')"},
    ("ttm_financial", "latest_visible_quarter_versions"): {
        "available_date": "date'2021-05-10'"},
    ("daily_research_universe", "config_trace"): {"config_id": "'none'"},
    ("daily_research_universe", "missing_member_row"): {"universe_id": "'none'"},
    ("daily_research_universe", "historical_membership"): {"is_in_universe": "not is_in_universe"},
    ("daily_research_universe", "trade_facts_preserved"): {
        "can_buy": "case when can_buy then false else true end"},
    ("research_universe_config", "rule_identity_or_deferral"): {"config_json": "'{}'"},
}


def _where(table: str, name: str) -> str:
    if table == "daily_calendar":
        return "trade_date = '2021-04-14'"
    if table in ("daily_adjusted_price", "daily_stock_state", "daily_trade_status",
                 "daily_research_universe"):
        return "trade_date = '2021-04-13' and ts_code = '300102.SZ'"
    if table == "financial_available":
        return "source_table = 'income_vip' and ts_code = '300101.SZ' and available_date is not null"
    if name in ("cumulative_difference_value", "source_periods"):
        return "ts_code = '300101.SZ' and status = 'available'"
    return "ts_code = '300101.SZ'" if table != "research_universe_config" else "universe_id = 'whole'"


def test_damage_is_seen(published):
    """All damaged variants, counted together; every named check must fire."""
    clean = report.violations(published).filter("violations > 0").collect()
    assert clean == []
    counts = []
    for (table, name), change in DAMAGE.items():
        damaged = published[table].withColumns({
            c: F.expr(f"if({_where(table, name)}, {text}, {c})") for c, text in change.items()})
        check = next(c for c in report.CHECKS if (c.table, c.name) == (table, name))
        rows = check.rows({**published, table: damaged})
        counts.append(rows.groupBy().agg(
            F.lit(f"{table}/{name}").alias("check"), F.expr("count(*) as n")))
    silent = []
    for part in counts:
        row = part.first()
        if row.n == 0:
            silent.append(row.check)
    assert silent == []
    doubled = published["daily_calendar"].union(published["daily_calendar"])
    found = report.samples({"daily_calendar": doubled}, "daily_calendar", "duplicate_primary_key")
    assert found.count() == 5


def test_component_gate(published):
    assert report.check_component("daily_calendar", published) == []
    broken = {**published, "daily_calendar": published["daily_calendar"].drop("trade_index")}
    assert report.check_component("daily_calendar", broken)[0]["check_name"] == "schema"
    with pytest.raises(ValueError):
        report.check_component("unknown", published)


def test_stale_step_stops_build(spark, golden, monkeypatch):
    monkeypatch.setattr(report, "check_component", lambda *a: [{"check_name": "x"}])
    with pytest.raises(BuildError, match="daily_calendar"):
        build(Warehouse(spark, fresh("warehouse")), golden.raw(), RULES)


# -- sources -------------------------------------------------------------------------------


def test_scans(spark):
    root = fresh("raw")
    spark.createDataFrame([(1, "a")], "k int, x string").coalesce(1).write.parquet(f"{root}/t/p=1")
    spark.createDataFrame([(2, 3.0), (3, 4.0)], "k int, y double").coalesce(1).write.parquet(
        f"{root}/t/p=2")
    found = tables.scan_parquet(spark, root, "t")
    assert set(found.columns) == {"k", "x", "y", "_source_file", "_source_row"}
    rows = found.orderBy("k").collect()
    assert [r._source_row for r in rows] == [0, 0, 1]
    assert rows[0]._source_file.startswith("t/p=1/part-") and rows[0].y is None
    with pytest.raises(tables.ContractError, match="missing"):
        tables.scan_parquet(spark, root, "t", SourceContract("t", ("absent",)))
    with pytest.raises(tables.ContractError, match="escapes"):
        tables.scan_parquet(spark, root, "../t")
    info = tables.readability(spark, root, "t").first()
    assert (info.file_count, info.sample_rows) == (2, 1)

    os.makedirs(f"{root}/csv")
    with open(f"{root}/csv/stock.csv", "w") as out:
        out.write("ts_code,list_date\n000001.SZ,20181217\n000002.SZ,\n")
    rows = tables.scan_csv(spark, root, "csv/stock.csv").orderBy("_source_row").collect()
    assert [(r.list_date, r._source_row, r._source_file) for r in rows] == [
        ("20181217", 0, "csv/stock.csv"), (None, 1, "csv/stock.csv")]


def test_csv_rows_of_many_splits_are_numbered(spark):
    """A file read in pieces by many tasks is numbered as it stands, beside a second file."""
    root = fresh("long")
    os.makedirs(f"{root}/c")
    for name, n in (("a", 5000), ("b", 3)):
        with open(f"{root}/c/{name}.csv", "w") as out:
            out.write("k,file\n" + "".join(f"{i},{name}\n" for i in range(n)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = tables.scan_csv(spark, root, "c")
        assert found.select(F.spark_partition_id()).distinct().count() > 2
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(rows) == 5003
    assert all(r._source_row == int(r.k) and r._source_file == f"c/{r.file}.csv" for r in rows)


def test_row_checks_share_a_scan(spark):
    """Checks of single rows are one aggregate; counts and examples are those of each alone."""
    rows = [("available", None), ("available", 1.0), ("missing", 2.0), ("missing", None)]
    sound = spark.createDataFrame(
        [(f"v{i}" if i else None, "income_vip", "000001.SZ", "revenue" if i != 1 else "odd", date(2001, 3, 31),
          date(2001, 4, 2 + i), s, v, [date(2001, 3, 31)]) for i, (s, v) in enumerate(rows)],
        "version_id string, source_table string, ts_code string, metric string, end_date date, "
        "available_date date, status string, value double, source_end_dates array<date>")
    held = {"quarterly_financial": sound}
    together = {r.check_name: r for r in report.violations(held).collect()}
    for c in report.runnable(held):
        wrong = c.rows(held).collect()
        assert together[c.name].violations == len(wrong)
        assert (together[c.name].example is None) == (not wrong)
    assert together["value_status"].violations == 2
    assert together["cumulative_metric_whitelist"].violations == 1
    of_rows = [c for c in report.runnable(held) if c.wrong]
    plan = report._counted_together(held, "quarterly_financial", of_rows)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert len(of_rows) >= 4 and physical.count("Scan ExistingRDD") == 1


def test_inventory(spark):
    root = fresh("files")
    os.makedirs(f"{root}/d")
    for name, text in (("d/a", "1"), ("d/b", "22"), ("NOTES.md", "x")):
        with open(f"{root}/{name}", "w") as out:
            out.write(text)
    files = tables.file_inventory(spark, root, checksums=True)
    local = compare.scoped_inventory(files).cache()
    assert {(r.path, r.size) for r in local.collect()} == {("d/a", 1), ("d/b", 2)}
    assert compare.compare_inventories(local, local).count() == 0
    other = local.selectExpr("if(path = 'd/a', 'd/c', path) as path", "size + 1 as size",
                             "sha2(path, 256) as sha256")
    assert {(r.path, r.difference) for r in compare.compare_inventories(local, other).collect()} == {
        ("d/a", "extra_local"), ("d/c", "missing_local"), ("d/b", "size_mismatch"),
        ("d/b", "hash_mismatch")}
    unhashed = local.withColumn("sha256", F.lit(None).cast("string"))
    assert compare.compare_inventories(local, unhashed).count() == 2
    assert compare.compare_inventories(local, unhashed, checksums=False).count() == 0
    assert compare.inventory_problems(local.union(local)).count() == 2
    with pytest.raises(compare.ComparisonError, match="d/a"):
        compare.compare_inventories(local.union(local), local)
    first = tables.source_signature(tables.file_inventory(spark, root)).first()
    with open(f"{root}/d/a", "w") as out:
        out.write("changed")
    assert tables.source_signature(tables.file_inventory(spark, root)).first() != first


def test_inventory_is_complete_on_any_root(spark):
    root = fresh("d") + "/raw"
    contents = {"a+b.txt": "1", "c d.txt": "22", "_hidden.txt": "333", ".dot.txt": "4444",
                "empty.txt": "", "p%20q.txt": "5", "sub/raw/x.txt": "66", "_under/y.txt": "777"}
    for name, text in contents.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as out:
            out.write(text)
    for top in (root, f"file://{root}", f"{root}/"):
        plain = tables.file_inventory(spark, top)
        assert {(r.path, r.size) for r in plain.collect()} == {
            (n, len(t)) for n, t in contents.items()}
        hashed = {r.path: r.sha256 for r in tables.file_inventory(spark, top, True).collect()}
        assert hashed == {n: hashlib.sha256(t.encode()).hexdigest() for n, t in contents.items()}
    spark.range(3).coalesce(1).write.parquet(f"{root}/raw/t+1 %")
    for top in (root, f"file://{root}"):
        files = {r[0] for r in tables.scan_parquet(spark, top, "raw/*").select(
            "_source_file").distinct().collect()}
        assert len(files) == 1 and next(iter(files)).startswith("raw/t+1 %/part-"), files


def test_a_file_beyond_two_gigabytes_is_hashed(spark):
    root = fresh("large")
    os.makedirs(f"{root}/.hidden/deep")
    with open(f"{root}/.hidden/deep/_sparse", "w") as out:
        out.truncate(3 << 30)  # holds no blocks on disk
    row = tables.file_inventory(spark, root, checksums=True).first()
    want = hashlib.sha256()
    for _ in range(3 * 64):
        want.update(bytes(1 << 24))
    assert (row.path, row.size, row.sha256) == (".hidden/deep/_sparse", 3 << 30, want.hexdigest())


def test_no_file_name_or_content_is_collected(spark, monkeypatch):
    root = fresh("many")
    for i in range(40):
        os.makedirs(f"{root}/d{i % 7}", exist_ok=True)
        with open(f"{root}/d{i % 7}/f{i}", "w") as out:
            out.write("x" * i)
    files = tables._listing(spark, root)
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and files.count() == 40


def test_a_file_that_changes_fails_the_inventory(spark, monkeypatch):
    root = fresh("moving")
    os.makedirs(root)
    with open(f"{root}/a", "w") as out:
        out.write("one")
    whole = tables._hashed

    def meddled(*args):
        found = whole(*args)
        with open(f"{root}/a", "w") as out:
            out.write("other")
        return found

    monkeypatch.setattr(tables, "_hashed", meddled)
    with pytest.raises(tables.FileChangedError, match="a"):
        tables.file_inventory(spark, root, checksums=True)


def test_table_diff_with_null_and_repeated_keys(spark):
    table = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, 2, "z")],
                                  "a int, b int, c string")
    assert compare.table_diff(table, table, ["a", "b"]).count() == 0
    assert compare.table_diff(table.select("a"), table.select("a"), ["a"]).count() == 0
    other = table.withColumn("c", F.expr("if(c = 'y', null, c)"))
    rows = compare.table_diff(table, other, ["a", "b"]).collect()
    assert [(r.a, r.difference, r.changed_columns) for r in rows] == [(None, "changed", "c")]
    twice = table.union(table.filter("a = 2"))
    kinds = {r.a: r.difference for r in compare.table_diff(table, twice, ["a", "b"]).collect()}
    assert kinds == {2: "repeated_key"}
    fewer = compare.table_diff(table, table.filter("a is not null"), ["a", "b"]).collect()
    assert [(r.a, r.difference) for r in fewer] == [(None, "only_first")]


def test_hash_trees_find_what_differs(spark, monkeypatch):
    base = spark.range(3000).selectExpr("if(id % 50 = 0, null, id) as a", "id div 7 as b", "cast(id as string) as c",
                                        "array(id, null) as d")
    same_rows = base.repartition(5)
    leaves = [compare.hash_tree(df, ["a", "b"]) for df in (base, same_rows)]
    assert compare.differing_buckets(*leaves).count() == 0 and leaves[0].agg({"row_count": "sum"}).first()[0] == 3000

    def unused(*args):
        assert all(not df.head(1) for df in args[:2]), "rows of equal tables were held against each other"
        return table_diff(*args)

    table_diff = compare.table_diff
    monkeypatch.setattr(compare, "table_diff", unused)
    assert compare.compare_tables(base, same_rows, ["a", "b"]).count() == 0
    monkeypatch.undo()
    other = base.filter("b <> 17").withColumn("c", F.expr("if(b = 3 or (a is null and b > 400), null, c)"))
    want = compare.table_diff(base, other, ["a", "b"])
    got = compare.compare_tables(base, other, ["a", "b"])
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0 < got.count()
    buckets = compare.differing_buckets(compare.hash_tree(base, ["a", "b"]), compare.hash_tree(other, ["a", "b"]))
    assert buckets.count() <= got.count()


def test_profile(spark):
    contract = SourceContract("t", ("ts_code",), ("ts_code", "day"), ("day",))
    df = spark.createDataFrame(
        [("a", "20200101", 1.0), ("a", "20200101", None), ("b", "20200230", 2.0), (None, " ", 1.0)],
        "ts_code string, day string, v double")
    columns = {r.column_name: r for r in profile.profile_columns(df, contract).collect()}
    assert columns["v"].null_count == 1 and columns["v"].null_rate == 0.25
    assert columns["day"].invalid_dates == 1 and columns["day"].null_count == 1
    assert columns["day"].date_min == columns["day"].date_max == date(2020, 1, 1)
    total = profile.profile_table(df, contract).first()
    assert (total.row_count, total.stock_count, total.duplicate_rows) == (4, 2, 1)
    assert profile.duplicate_issue(df, contract).first().n == 2
    assert profile.date_issue(df, contract, "day").first().ts_code == "b"
    with pytest.raises(ValueError):
        profile.profile_columns(df.drop("day"), contract)
    with pytest.raises(ValueError):
        profile.profile_all({"t": df}, {"t": contract, "u": contract}, "full")
    issues = profile.verify_profiles(
        profile.profile_columns(df, contract),
        {"t": dataclasses.replace(contract, required=("ts_code", "gone"))}).collect()
    assert {(r.column_name, r.issue) for r in issues} == {
        ("gone", "missing_column"), ("day", "invalid_date"), ("ts_code", "null_key"),
        ("day", "null_key")}


def test_compare_builds(built, spark):
    manifest = built[0].manifest()
    assert compare.compare_manifests(manifest, manifest).count() == 0
    changed = manifest.filter("table_name <> 'ttm_financial'").withColumn(
        "hash_sum", F.expr("if(table_name = 'daily_calendar', 'x', hash_sum)"))
    assert {(r.table_name, r.field) for r in compare.compare_manifests(manifest, changed).collect()
            } == {("daily_calendar", "hash_sum"), ("ttm_financial", "missing_second")}
    table = built[0].read("daily_adjusted_price").drop("extra")
    damaged = table.withColumn("close", F.expr("if(ts_code = '601204.SH', close + 1, close)"))
    rows = compare.table_diff(table, damaged, ["trade_date", "ts_code"])
    assert {r.changed_columns for r in rows.collect()} == {"close"}
    with pytest.raises(ValueError):
        compare.table_diff(table, table.drop("close"), ["trade_date", "ts_code"])


def test_backfill(spark):
    staged = spark.createDataFrame(
        [("a", "20171231", "1"), ("a", "20260331", "2"), ("b", "20260331", "x"), ("a", "2019", "3")],
        "ts_code string, end_date string, v string")
    base = spark.createDataFrame([("a", "20260331", 1.0)],
                                 "ts_code string, end_date string, v double")
    rows = backfill.route_periods(staged, base, ["20171231"], ["20260331"]).collect()
    assert {(r.ts_code, r.end_date, r.v, r.target) for r in rows} == {
        ("a", "20171231", 1.0, "head"), ("b", "20260331", None, "supplement")}
    known = spark.createDataFrame([("20180601",)], "cal_date string")
    gap = backfill.calendar_gap(known, date(2018, 1, 1), date(2020, 1, 1)).first()
    assert (gap.gap_start, gap.gap_end) == (date(2018, 1, 1), date(2018, 5, 31))
    assert backfill.calendar_gap(known, date(2018, 6, 1), date(2020, 1, 1)).count() == 0
    assert backfill.merge_pulls([staged, staged]).count() == 4


def test_contracts_cover_every_source():
    assert len(SOURCE_CONTRACTS) == 11 and all(c.core for c in SOURCE_CONTRACTS.values())
