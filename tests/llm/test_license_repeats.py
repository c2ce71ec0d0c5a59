"""Repeated rows with finds in the license scan."""

from __future__ import annotations

from tidemark.llm import licenses


def test_repeated_rows_report_their_own_places(spark):
    text = "see the MIT License and the mit license " + "word " * 40 + "apache license"
    once = spark.createDataFrame([(1, text), (None, text)], "doc_id bigint, text string")
    rows = licenses.license_scan(once).collect()
    assert {r.n_base for r in rows} == {3}
    thrice = licenses.license_scan(once.union(once).union(once)).collect()
    assert sorted(map(str, thrice)) == sorted(map(str, rows * 3))
