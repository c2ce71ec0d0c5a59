"""Fences of groups with a wide spread."""

from __future__ import annotations

from tidemark.llm import quality


def test_a_wide_group_does_not_switch_its_own_rule_off(spark):
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" for k in range(10)) + " " + "#" * symbols
    rows = [(i, text(i, 3 * i), "en", "tables") for i in range(100)]
    rows.append((100, text(100, 2000), "en", "tables"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    failed = [r.doc_id for r in quality.quality_report(docs).filter("failed = 'symbols'").collect()]
    assert failed == [100]
    for name, most in quality.CEILINGS.items():
        assert quality.MEASURES[name][1] < most < (200 if name == "repeats" else 1000)
