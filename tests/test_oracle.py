"""Every registered query against its DuckDB SQL, and the shape of the plans behind them."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tidemark.plans import catalog, demo  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, SF) == ""


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 60


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["adjusted_price", "security_state", "trade_status", "universe",
                                  "filings_available", "quarterly", "ttm", "asof_panel",
                                  "asof_panel_newest", "interval_days", "coverage_gaps", "checks_filings"])
def test_no_nested_loops_or_python(spark, name):
    """Interval, as-of and grid joins stay equi-joins, and no row leaves the JVM."""
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                     "MapInPandas"):
        assert operator not in plan


def test_scans_are_pruned(spark):
    plan = queries()["adjusted_price"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double," \
           "l_shipdate:timestamp_ntz>" in plan


def test_windows_after_clustering_do_not_shuffle(spark):
    """Quarter and TTM windows reuse the one partitioning by (source, code, metric)."""
    def exchanges(name):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    assert exchanges("ttm") == exchanges("quarterly") == exchanges("period_versions")


def test_no_fixed_number_of_tasks_deals_rows_out(spark):
    """The rows dealt out anew follow the session's partitions, so a task's share does not grow."""
    plan = queries()["fingerprint_properties"](spark, SF)._jdf.queryExecution().toString()
    assert "RepartitionByExpression [l_orderkey" in plan and "Repartition 7" not in plan


@pytest.mark.parametrize("name", ["table_fingerprint", "manifest"])
def test_identities_are_held_against_sql(spark, name):
    """Both say by SQL that the identity does not depend on the order of rows."""
    assert "free_of_order" in oracle_sql()[name]
    assert queries()[name](spark, SF).first().free_of_order is True
    assert {"hash_sum", "hash_xor"} <= set(queries()[name.replace("table_fingerprint", "table") + "_hashes"](spark, SF).columns)


def test_tables_of_a_histogram_are_counted_one_by_one(spark):
    """The union reads four written counts; no plan holds the shuffles of all four tables."""
    plan = queries()["status_histogram"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("staged-") == 4


def test_key_conflicts_neither_hash_nor_sort_records(spark):
    """Records are told apart by their columns in aggregates; none is identified or numbered first."""
    plan = queries()["candidate_key_conflicts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "sha2(" not in plan and "Window" not in plan and "Sort " not in plan


def test_filings_are_multiplied_in_tasks_that_follow_the_totals(spark, monkeypatch):
    """However few files the totals lie in, a task multiplies a bounded number of them, and a
    customer's years together."""
    monkeypatch.setattr(demo, "TOTALS_PER_TASK", 20, raising=False)
    market = demo.DemoMarket(spark, SF)
    tasks = market.staged("_filing_totals").count() // 20
    rows = market.filing_source("income_vip")
    assert rows.rdd.getNumPartitions() == tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = rows.selectExpr("ts_code", "spark_partition_id() as task").groupBy("ts_code").agg(
        F.count_distinct("task").alias("tasks"))
    assert held.filter("tasks > 1").isEmpty() and not held.isEmpty()


@pytest.mark.parametrize("name", ["record_dedup", "quarters_asof"])
def test_filings_dealt_out_by_company_are_not_shuffled_again(spark, name):
    """Totals are dealt out by code before they are multiplied; no wide row, which has a source
    file, is shuffled after that."""
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # Everything but the look-up of days lies above the union of the sources, without an exchange.
    above = plan[:plan.index("Union")]
    assert "Window" in above and "Exchange" not in above
    assert all("ts_code" in line for line in plan.split("\n") if "Exchange hashpartitioning" in line)


def test_cited_records_meet_their_quarters_without_a_shuffle(spark):
    """Filings and quarters are neither written nor shuffled to re-derive the differences."""
    plan = queries()["check_diff_value"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanges and all("ts_code" in line and "record_id" not in line and "version_id" not in line for line in exchanges)
    assert "Join [source_table" not in plan


@pytest.mark.parametrize("broken", [False, True])
def test_universe_checks_send_no_security_days_through_the_driver(spark, broken):
    """Written tables are small in files and large in memory; joins on security-days must not broadcast."""
    found = catalog._universe_tables(catalog.market(spark, SF))
    for name in ("missing_member_row", "historical_membership", "trade_facts_preserved"):
        if broken:
            _, _, table, do, _ = next(b for b in catalog._BREAKS if b[1] == name)
            found = {**found, table: do(found[table])}
        check = next(c for c in catalog.report.CHECKS if c.name == name)
        plan = check.rows(found)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [trade_date" in plan
        assert not [line for line in plan.split("\n") if "BroadcastHashJoin" in line and "trade_date" in line]


@pytest.mark.parametrize("name", ["source_record_lineage", "latest_visible_source_versions", "cumulative_difference_value",
                                  "quarter_lineage_and_sum", "latest_visible_quarter_versions", "original_record_lineage"])
def test_lineage_checks_shuffle_each_table_once_by_company(spark, name):
    """Hex ids do not compress, so no table is dealt out by them, and none is dealt out twice."""
    check = next(c for c in catalog.report.CHECKS if c.name == name)
    plan = check.rows(catalog._finance(catalog.market(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(ts_code" in line for line in exchanges)


def test_the_hashes_of_a_fingerprint_are_held_against_sql(spark, tmp_path):
    """The query returns the identity itself, and its SQL computes it anew, nulls and signs included."""
    full = (1, -2, 3, 4, 5.5, -0.0, 0.1, float("nan"), "R", "", "1998-01-01 00:00:01.5")
    rows = [full, full, (7, 2, 3, 1, 1e300, 0.0, -1.0, 2.0, "ABC", "é", "1960-02-29 12:00:00")]
    rows += [tuple(None if i == j else v for j, v in enumerate(full)) for i in range(11)] + [(None,) * 11]
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string")
    lines = spark.createDataFrame(rows, schema).withColumn("l_shipdate", F.expr("cast(l_shipdate as timestamp_ntz)"))
    for name, table in (("some", lines), ("none", lines.filter("false"))):
        table.write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/{name}/lineitem.parquet/*.parquet')")
        assert compare(spark, con, "table_fingerprint", f"{tmp_path}/{name}") == ""
    assert {"hash_sum", "hash_xor", "free_of_order"} <= set(queries()["table_fingerprint"](spark, SF).columns)
    assert "hash_sum" not in queries()["fingerprint_properties"](spark, SF).columns
