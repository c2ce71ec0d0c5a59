"""Verdicts of the quality rules against a plain version of the whole rule."""

from __future__ import annotations

import random
import re

from tidemark.llm import quality


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    chars = sum(map(len, words))
    return len(words), len(covered), {
        "symbols": 1000 * sum(c in "#*$%&|<>" for c in text) // max(1, chars),
        "dup_lines": 1000 * (len(lines) - len(set(lines))) // max(1, len(lines)),
        "repeats": 1000 * len(covered) // max(1, len(words)),
        "word_length": 100 * chars // max(1, len(words)),
    }


def plain_verdicts(rows):
    """doc_id -> rule that failed (None: kept), by sorting the values of every group."""
    measured = [(doc, lang, source, *counts(text)) for doc, text, lang, source in rows]
    good = [m for m in measured if m[3] >= 10 and 100 * m[4] <= 20 * m[3]]

    def top(members, name):
        shift = {v: max(0, v.bit_length() - 5) for v in (m[5][name] for m in members)}
        values = sorted((m[5][name] >> shift[m[5][name]]) << shift[m[5][name]] for m in members)
        _, least, low, high = quality.MEASURES[name]
        low, high = (values[-(-len(values) * q // 100) - 1] for q in (low, high))
        return min(quality.CEILINGS.get(name, 10**9),
                   high + quality.FENCE * max(high - low, least))

    out = {}
    for doc, lang, source, n, repeated, values in measured:
        if n < 10:
            out[doc] = "words"
        elif 100 * repeated > 20 * n:
            out[doc] = "repeats"
        else:
            for members in ([m for m in good if m[1:3] == (lang, source)],
                            [m for m in good if m[1] == lang], good):
                if len(members) >= quality.MIN_GROUP or members is good:
                    break
            out[doc] = next((k for k in quality.MEASURES if values[k] > top(members, k)), None)
    return out


def corpus():
    """Groups of one's own limits: null, small, narrow and wide ones, with outliers in each."""
    rng = random.Random(7)
    rows = []
    for lang, source, n, length, junk in (("en", "a", 90, 4, 0), ("en", "b", 70, 9, 6),
                                          ("en", None, 60, 5, 2), (None, "a", 20, 6, 1),
                                          ("de", "a", 30, 8, 0), ("de", "b", 30, 8, 25)):
        for i in range(n):
            words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(length + rng.randrange(2)))
                     for _ in range(rng.randrange(4, 60))]
            words += ["#" * rng.randrange(1, 4)] * rng.randrange(junk + 1)
            if i % 17 == 3:
                words = [w * 4 for w in words]
            if i % 19 == 4:
                words += ["#$" * 40]
            if i % 11 == 5:
                words += words[:rng.randrange(5, 9)]
            lines = [" ".join(words[k:k + 9]) for k in range(0, len(words), 9)]
            if i % 29 == 6:
                lines = [part for line in lines for part in (line, "menu")]
            rows.append((len(rows), "\n".join(lines), lang, source))
    rows += [(len(rows), None, "en", "a"), (len(rows) + 1, "", "en", "a"), (len(rows) + 2, "\n ", None, None)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string"


def test_verdicts_equal_a_plain_version(spark):
    rows = corpus()
    got = {r.doc_id: r.failed for r in quality.quality_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    expected = plain_verdicts(rows)
    assert got == expected
    assert set(expected.values()) == {"words", *quality.MEASURES, None}


def test_sketches_decide(spark):
    """The same document is kept or goes with the sketch of its group, in both directions."""
    def text(i, length):
        return " ".join(f"{'x' * (length - 4)}{i % 7}{k % 10}{k // 10}z" for k in range(30))

    rows = [(i, text(i, 5 + i % 2), "en", "plain") for i in range(80)]
    rows += [(100 + i, text(i, 9 + i % 5), "en", "long") for i in range(80)]
    rows += [(200, text(3, 14), "en", "plain"), (201, text(3, 14), "en", "long")]
    report = quality.quality_report(spark.createDataFrame(rows, SCHEMA))
    assert {r.doc_id for r in report.filter("not kept").collect()} == {200}
    counted = quality.counted(spark.createDataFrame(rows, SCHEMA))
    limits = quality.thresholds(counted)
    for change, lost in (("0", len(rows)), ("2 * max_word_length", 0)):
        changed = limits.withColumn("max_word_length", quality.F.expr(change))
        assert quality.judged(counted, changed).filter("not kept").count() == lost
