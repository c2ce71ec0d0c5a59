"""Filter audit, toxicity and collocations against plain-Python versions and held-out labels."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import SCHEMA, SPACED, awkward_rows
from tidemark.llm import audit, collocations, toxicity

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0), "clash") for i in range(0, 24)]
    return spark.createDataFrame(
        rows + [(6, 0, 1, None), (7, None, None, None), (None, 1, 1, None), (999, 1, 1, None)], LABELS)


# -- filter audit --------------------------------------------------------------------------


def plain_audit(rows, labels):
    good, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    holders = defaultdict(set)
    for r in rows:
        if r[0] is not None:
            holders[r[1] or ""].add(r[0])
    docs = defaultdict(list)
    for r in rows:
        text = r[1] or ""
        words = SPACED.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": r[0] is not None and any(i < r[0] for i in holders[text]),
        }
        docs[r[2] or ""].append((fails, r[0] in good and r[0] is not None, r[0] in toxic and r[0] is not None))
    out, share = {}, Counter()
    for part, held in docs.items():
        for order in map("".join, permutations("ABCDE")):
            left = list(held)
            for step, x in enumerate(order, 1):
                gone = [d for d in left if d[0][x]]
                before = [d for d in held if d[0][x] and d not in left]
                left = [d for d in left if not d[0][x]]
                share[part, x] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(d[0][x] for d in held) - len(gone),
                    sum(d[0][x] and sum(d[0].values()) == 1 for d in held),
                    sum(d[1] for d in gone), sum(d[2] for d in gone))
                assert len(before) <= sum(d[0][x] for d in held)
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_plain_python(spark, awkward, labels):
    found = audit.filter_audit(awkward, labels).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*audit.MEASURES, "shapley")) for r in found}
    want = plain_audit(awkward_rows(), [tuple(r) for r in labels.collect()])
    assert got == want and len(found) == 600 * len({r[2] or "" for r in awkward_rows()})


def test_audit_of_nothing_and_of_other_filters(spark, awkward, empty, labels):
    assert audit.filter_audit(empty, labels).count() == 0
    assert audit.filter_audit(awkward, labels.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0
    two = {"S": "words < 3", "R": "repeats"}
    rows = audit.filter_audit(awkward, labels, two).collect()
    assert {r.filter_order for r in rows} == {"SR", "RS"} and all(r.step in (1, 2) for r in rows)


def test_packed_fields_do_not_carry():
    """A part of 2^62 documents of one mask keeps every count apart."""
    pd = pytest.importorskip("pandas")
    n = 1 << 62
    rows = audit.report_of("ABCDE")(pd.DataFrame(
        {"part": ["x", "x"], "mask": [31, 1], "good": [True, False], "toxic": [True, True], "n": [n - 1, 1]}))
    first = rows[(rows.step == 1)]
    assert set(first.removed) == {n, n - 1} and set(first.good_lost) == {n - 1}
    assert set(rows[rows.step == 5].kept) == {0}


# -- collocations --------------------------------------------------------------------------


def plain_phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und" if lang is None else lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [b for p, b in f.items() if len(p) == len(phrase) + 1 <= 3 and b >= least
                      and phrase in (p[:-1], p[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


PHRASES = [
    (1, "the cat sat on the mat. The cat sat! the cat, sat on the mat\r\nthe cat sat on", "en"),
    (2, "a a a a a a; a a", "en"), (3, None, "en"), (4, "", None), (5, "x y z x y z x y z x y w", None),
    (6, "é É é É  b\té É", ""), (7, ".,;:", "en"), (8, "the cat sat on the mat", "de"),
    (9, "b\x00c d b\x00c d b\x00c d", "de"), (9, "b\x00c d b\x00c d b\x00c d", "de"),
]


@pytest.mark.parametrize("least, top", [(2, 2000), (3, 2), (1, 50)])
def test_collocations_against_plain_python(spark, monkeypatch, least, top):
    """Small batches, stripes cut into pieces and several stripes of a prefix per task."""
    rows = PHRASES * 3 + [(r[0], r[1], r[2]) for r in awkward_rows() if r[1] is None or len(r[1]) < 5000]
    monkeypatch.setattr(collocations, "HELD_WORDS", 40)
    monkeypatch.setattr(collocations, "CUT", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        docs = spark.createDataFrame([(*r, 1, "s") for r in rows],
                                     "doc_id bigint, text string, lang string, n bigint, phrase string").repartition(3)
        found = collocations.collocations(docs, least, top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == plain_phrases(rows, least, top)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    got = spark.sql(f"select {collocations.score(f'{a}L', f'{left}L', f'{right}L')}").first()[0]
    assert got == 1000000 * a * a // (left * right)
    top = 10 ** 16 - 1
    assert spark.sql(f"select {collocations.score(f'{top}L', f'{top}L', f'{top}L')}").first()[0] == 1000000


# -- toxicity ------------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.toxicity(docs, known).join(known, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    apart = [r for r in rows if r.held_out]
    hits = sum(r.predicted for r in apart if r.toxic)
    assert hits >= 0.85 * sum(r.toxic for r in apart)
    assert sum(r.predicted for r in apart if not r.toxic) <= 0.015 * len(apart)


def test_toxicity_edges_and_what_it_learns_from(spark, awkward, empty, labels):
    words = "good fine nice calm kind".split()
    texts = [(i, " ".join(words[(i * k) % 5] for k in range(1, 30)) + (" vile nasty" if i % 4 == 0 else ""), "en")
             for i in range(400)]
    marks = [(i, 1, int(i % 4 == 0), None) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    fitted = toxicity.train(docs, spark.createDataFrame(marks, LABELS))
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, q, t, x in marks]
    assert toxicity.train(docs, spark.createDataFrame(flipped, LABELS)) == fitted
    far = docs.limit(0).unionByName(spark.createDataFrame(
        [(1, "calm kind " * 30000 + "vile nasty", "en"), (2, "calm kind " * 30000, None), (3, None, "en"),
         (3, "", "fr"), (None, "vile nasty", "en")], docs.schema))
    rows = toxicity.toxicity(docs.unionByName(far), spark.createDataFrame(marks, LABELS)).filter(
        "doc_id is null or doc_id in (1, 2, 3)").collect()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id, r.lang].add(round(r.score, 6))
    assert max(by[1, "en"]) >= 0.5 and max(by[2, None]) < 0.5 and min(by[None, "en"]) >= 0.5
    assert not next(r.held_out for r in rows if r.doc_id is None)
    assert by[3, "fr"] <= by[3, "en"]
    scored = toxicity.toxicity(awkward, labels)
    assert scored.count() == len(awkward_rows()) and scored.filter("score is null").count() == 0
    assert scored.columns[:6] == ["doc_id", "lang", "source", "n_chars", "size", "slot"]
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(awkward, labels.limit(0)).filter("score between 0 and 1").count() == len(awkward_rows())


def test_maxima_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    net = toxicity.Network()
    net.table[:-1] = rng.standard_normal(net.table[:-1].shape)
    texts = pa.array(["", "a b c", None, " ".join(f"w{i}" for i in range(500)), "x", "", "y z " * 40])
    (rows, sizes), = toxicity.documents(texts)
    whole = net.maxima(rows, sizes)
    for block in (1, 7, 64):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.allclose(net.maxima(rows, sizes), whole, atol=1e-5)
    alone = [net.maxima(*next(toxicity.documents(texts.slice(i, 1)))) for i in range(len(texts))]
    assert np.allclose(np.concatenate(alone), whole, atol=1e-5)
    again = toxicity.Network.load(net.save())
    assert all((getattr(net, n) == getattr(again, n)).all() for n in net.names())
    assert SCHEMA.startswith("doc_id")


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Beyond one learner's documents and in texts of any length; twice gives the same weights."""
    monkeypatch.setattr(toxicity, "LEARNER", 100)
    known = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame(
        [(i, ("calm kind " * (8000 if i == known[0] else 5)) + (" vile" if i % 4 == 0 else " nice"), "en")
         for i in range(1000)] + [(known[1], "calm", "en")], "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0), None) for i in range(1000)], LABELS)
    learned = toxicity.labelled(docs, marks).collect()
    assert sorted(r.doc_id for r in learned) == known and max(len(r.text) for r in learned) > 60_000
    assert next(r.text for r in learned if r.doc_id == known[1]) == "calm"
    fitted = toxicity.train(docs, marks)
    assert toxicity.train(docs.repartition(5), marks) == fitted
    scored = toxicity.toxicity(docs, marks).filter("held_out").collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in scored)
