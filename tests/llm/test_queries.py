"""Registered queries against their DuckDB SQL, and the parts that SQL cannot say."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidemark.llm.components import components  # noqa: E402
from tidemark.llm.fmindex import FMIndex  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402
from tidemark.llm.repeats import anchors, stretch_hashes  # noqa: E402
from tidemark.llm.wordhash import ALNUM, words  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted([*QUERIES, "pipeline"]))
def test_query_matches_its_sql(spark, name):
    assert name in queries() and (name in oracle_sql() or name in ("op3_token_counts", "op12_toxicity"))
    assert compare(spark, duck(SF), name, SF) == ""


def test_native_queries_run_no_python(spark):
    for name in ("op1_license_scan", "op2_sharding", "op9_quality_rules"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}}


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(5)
    for _ in range(30):
        text = rng.integers(0, 4, rng.integers(1, 200))
        text[-1] = 0
        index = FMIndex(text, step=int(rng.integers(1, 9)))
        phrases = []
        for _ in range(40):
            size = int(rng.integers(1, 6))
            phrases.append(np.concatenate((np.zeros(6 - size, np.int64), rng.integers(1, 5, size))))
        lo, hi = index.search(np.array(phrases))
        for p, a, b in zip(phrases, lo, hi):
            p = p[p > 0]
            want = [i for i in range(len(text) - len(p) + 1) if (text[i:i + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


def test_words_on_bytes_across_blocks(monkeypatch):
    from tidemark.llm import wordhash
    text = ("Ab é1-x " + "long" * 50 + " AB, ab\n") * 20
    data = np.frombuffer(text.encode(), np.uint8)
    whole = words(data, ALNUM)
    monkeypatch.setattr(wordhash, "BLOCK", 16)
    pieces = words(data, ALNUM)
    assert all((a == b).all() for a, b in zip(whole, pieces))
    found = [data[a:b].tobytes().lower() for a, b in zip(*whole[:2])]
    by_word = dict(zip(found, whole[2].tolist()))
    assert len(by_word) == len(set(by_word.values())) == 4
    assert [by_word[w] for w in found] == whole[2].tolist()


def test_every_window_has_its_anchor(monkeypatch):
    from tidemark.llm import repeats
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[1499] = data[2999] = 10
    starts = np.array([0, 1500, 3000])
    found, hashes = anchors(data, starts)
    h = stretch_hashes(data)
    assert (h[found] == hashes).all()
    want = set()
    for a, b in zip(starts, starts[1:] - 1):
        for i in range(a, b - 200 + 1):
            part = h[i:i + 137]
            want.update(i + np.flatnonzero(part == part.min()))
    assert set(found.tolist()) == want
    monkeypatch.setattr(repeats, "_BLOCK", 257)
    assert (anchors(data, starts)[0] == found).all()
