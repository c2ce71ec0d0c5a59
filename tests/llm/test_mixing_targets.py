"""Words taken against the target, also beside one very long document."""

from __future__ import annotations

from collections import Counter

import pytest

from tidemark.llm import mixing


@pytest.mark.parametrize("share", [20, 40, 60])
@pytest.mark.parametrize("weights", [(1, 3), (3, 1)])
def test_a_dominant_document_is_compensated(spark, share, weights):
    sizes = [20 + i * 37 % 61 for i in range(500)]
    sizes.append(sum(sizes) * share // (100 - share))
    rows = [(i, "w " * n, "a") for i, n in enumerate(sizes)]
    rows += [(1000 + i, "w " * (sum(sizes) // 400), "b") for i in range(400)] + [(2000, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = mixing.copies(docs, weights).collect()
    assert len(got) == len(rows)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r["size"] * r.copies
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert abs(taken["a"] - target["a"]) <= sum(sizes) / len(sizes)
    again = {(r.doc_id, r.copies) for r in mixing.copies(docs, weights).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}
