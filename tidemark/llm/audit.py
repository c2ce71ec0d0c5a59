"""How quality filters interact: what each removes in every order in which they could be applied.

A document's failures are a mask with one bit per filter. For all orders of k filters there are
k! * k steps, and what happens to a document at each of them depends on its mask alone. So every
mask is mapped to one wide integer whose fields, one per measure, order and step, hold these
outcomes as 0 or 1. The integers of a part are added up, and one sum then holds every count of the
report. A field is 64 bits wide and no part has 2^63 documents, so no field carries into the next.

Documents are counted per part, mask and label first, in the partial aggregates of their own tasks;
a mask found n times adds n times its integer. A part thus adds at most 4 * 2^k integers, however
many documents it has.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
#: When a document fails each filter, as SQL over text, words and distinct (numbers of words) and
#: the flag repeats: that a smaller doc_id has the same text.
FILTERS = {
    "A": "words < 100",
    "B": "100 * distinct < 80 * words",
    "C": "100 * regexp_count(text, '[A-Z]') > 10 * length(text)",
    "D": "text rlike '[#$%&*|]'",
    "E": "repeats",
}
#: Counts of one step, in the order of their fields: documents left after it, removed by it,
#: failing its filter but removed before, failing its filter only, removed although labelled good,
#: removed and labelled toxic.
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
REPORT = ("part string, filter_order string, step int, "
          + ", ".join(f"{m} bigint" for m in MEASURES) + ", shapley bigint")


def orders(letters: str) -> np.ndarray:
    """All orders of the filters, one row each, as indexes into ``letters``."""
    return np.array(list(permutations(range(len(letters)))))


def outcomes(order: np.ndarray, mask: int, good: bool, toxic: bool) -> np.ndarray:
    """0 or 1 per measure, order and step for a document of this mask."""
    fails = (mask >> order) & 1 == 1
    gone = np.cumsum(fails, axis=1) > 0
    before = np.zeros_like(gone)
    before[:, 1:] = gone[:, :-1]
    removed = fails & ~before
    only = fails & (mask == 1 << order)
    return np.array([~gone, removed, fails & before, only, removed & good, removed & toxic])


def report_of(letters: str):
    """Function from the counted masks of one part to its rows of the report."""
    order = orders(letters)

    def packed(mask: int, good: bool, toxic: bool) -> int:
        fields = outcomes(order, mask, good, toxic).astype("<u8")
        return int.from_bytes(fields.tobytes(), "little")

    def report(counted: pd.DataFrame) -> pd.DataFrame:
        total = sum(
            int(n) * packed(int(mask), bool(good), bool(toxic))
            for mask, good, toxic, n in zip(counted["mask"], counted["good"], counted["toxic"], counted["n"])
        )
        shape = (len(MEASURES), *order.shape)
        fields = np.frombuffer(total.to_bytes(8 * int(np.prod(shape)), "little"), "<u8")
        fields = fields.reshape(shape).astype(np.int64)
        removed = fields[MEASURES.index("removed")]
        share = np.zeros(len(letters), np.int64)
        np.add.at(share, order, removed)
        steps = np.broadcast_to(np.arange(1, len(letters) + 1), order.shape)
        names = np.array(["".join(letters[i] for i in row) for row in order], object)
        return pd.DataFrame({
            "part": counted["part"].iloc[0], "filter_order": np.repeat(names, len(letters)),
            "step": steps.ravel(), **{m: f.ravel() for m, f in zip(MEASURES, fields)},
            "shapley": share[order].ravel(),
        })

    return report


def failures(docs: DataFrame, filters: dict[str, str]) -> DataFrame:
    """(part, doc_id, mask): the filters each document row fails, the first in the lowest bit.

    ``part`` is the language, empty for null; null text counts as empty. A row whose text equals
    that of a smaller doc_id fails the filter on repeats. Rows without doc_id neither fail it nor
    make others fail; rows of one doc_id do not count as repeats of each other. Texts are compared
    by SHA-256, so only digests are shuffled, and rows find the first holder of their text by
    digest and doc_id together: thousands of copies of a text spread over all tasks.
    """
    counted = docs.selectExpr(
        "doc_id", "coalesce(lang, '') as part", "coalesce(text, '') as text",
        rf"filter(split(coalesce(text, ''), r'{WORD_BREAK}'), w -> w <> '') as _words",
    ).selectExpr("doc_id", "part", "text", "cast(size(_words) as bigint) as words",
                 "cast(size(array_distinct(_words)) as bigint) as distinct")
    bits = {letter: 1 << i for i, letter in enumerate(filters)}
    own = " + ".join(f"if({sql}, {bits[x]}, 0)" for x, sql in filters.items() if sql != "repeats")
    narrow = stage(counted.selectExpr(
        "doc_id", "part", f"{own or 0} as mask", "unhex(sha2(text, 256)) as digest"))
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    again = sum(bits[x] for x, sql in filters.items() if sql == "repeats")
    return narrow.alias("d").join(
        first.withColumnRenamed("digest", "_digest"), F.expr("digest = _digest and doc_id = _first"), "left"
    ).selectExpr("part", "doc_id",
                 f"mask + if(doc_id is not null and _first is null, {again}, 0) as mask")


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS) -> DataFrame:
    """One row per part, order and step with the counts of :data:`MEASURES` and ``shapley``: what
    the step's filter removes, summed over all orders.

    A document is good or toxic where a row of ``labels`` with its doc_id says 1; documents without
    label are neither. Repeated document rows count once each, other columns play no part. No
    documents: no rows. The report has k! * k rows a part, so k is for a handful of filters.
    """
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.expr("bool_or(quality <=> 1)").alias("good"), F.expr("bool_or(toxic <=> 1)").alias("toxic"))
    counted = (
        failures(docs, filters).join(marks, "doc_id", "left")
        .selectExpr("part", "mask", "coalesce(good, false) as good", "coalesce(toxic, false) as toxic")
        .groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    )
    return counted.groupBy("part").applyInPandas(report_of("".join(filters)), REPORT)
