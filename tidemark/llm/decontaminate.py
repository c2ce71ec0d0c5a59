"""Benchmark decontamination with an FM-index per shard of the training data.

Test items are cut into windows of consecutive words. Each task gathers its documents into shards
of bounded size, builds an FM-index over a shard's words and searches all windows backwards
through it; occurrences are located by sampled suffix positions, and overlapping ones are merged
into spans to remove. Documents stay where they are read: nothing but the items' windows travels.

Words that no item has cannot be part of an occurrence. They separate stretches in the indexed
sequence, and stretches shorter than the shortest window are left out; this loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import keyed
from tidemark.llm.fmindex import FMIndex
from tidemark.llm.wordhash import ALNUM, texts, words

WINDOW = 13
#: A document is contaminated when at least this share, one in so many, of its words is hit.
ONE_IN = 20
SHARD_WORDS = 1 << 19
SHARD_DOCS = 20_000
#: Items are searched in blocks of about this many bytes of text, so what travels is bounded.
ITEM_BYTES = 8 << 20
SPAN = "struct<first_word: bigint, end_word: bigint, first_byte: bigint, end_byte: bigint>"
COLUMNS = (f"doc_id bigint, _id bigint, _th bigint, n_words bigint, spans array<{SPAN}>, "
           "items array<bigint>")


@dataclass
class Phrases:
    """The windows of a block of items, as numbers over the block's own words."""

    vocabulary: np.ndarray  # sorted word hashes; word number = place + 1
    windows: np.ndarray  # one distinct window per row, padded with 0 on the left
    item_of: np.ndarray  # (window, item) pairs, by window
    item_from: np.ndarray  # first pair of each window
    shortest: int

    @staticmethod
    def of(items: list[tuple[int | None, str | None]], window: int) -> Phrases:
        hashed = []
        for item, text in items:
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            hashed.append((item, words(data, ALNUM)[2]))
        vocabulary = np.unique(np.concatenate([h for _, h in hashed] or [np.zeros(0, np.uint64)]))
        rows, owners = [np.zeros((0, window), np.int64)], []
        for item, h in hashed:
            numbers = np.searchsorted(vocabulary, h) + 1
            if 0 < len(numbers) < window:
                part = np.concatenate((np.zeros(window - len(numbers), np.int64), numbers))[None]
            elif len(numbers):
                part = np.lib.stride_tricks.sliding_window_view(numbers, window)
            else:
                continue
            rows.append(part)
            owners += [item] * len(part)
        distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = sorted({(int(w), o) for w, o in zip(which.ravel(), owners) if o is not None})
        lengths = (distinct > 0).sum(axis=1)
        return Phrases(
            vocabulary, distinct, np.array([o for _, o in pairs], np.int64),
            np.searchsorted([w for w, _ in pairs], np.arange(len(distinct) + 1)),
            int(lengths.min(initial=window)),
        )


class _Shard:
    """Documents and their stretches of item words until an index is built over them."""

    def __init__(self):
        self.docs, self.parts, self.size = [], [], 0

    def add(self, numbers, doc, word, first_byte, end_byte):
        self.parts.append((numbers, doc, word, first_byte, end_byte))
        self.size += len(numbers)

    def rows(self, phrases: Phrases) -> list[tuple]:
        """(doc_id, _id, _th, n_words, spans, items) of every document held."""
        out = [(*head, [], []) for head in self.docs]
        if not self.size:
            return out
        numbers, doc, word, lo_byte, hi_byte = map(np.concatenate, zip(*self.parts))
        index = FMIndex(numbers)
        lo, hi = index.search(phrases.windows)
        found = np.flatnonzero(hi > lo)
        count = hi[found] - lo[found]
        if not len(found):
            return out
        which = np.repeat(found, count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[which]
        at = index.locate(rows)
        length = (phrases.windows[which] > 0).sum(axis=1)
        cover = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        hit = np.cumsum(cover) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        for start, end in zip(edges[::2], edges[1::2]):
            out[doc[start]][4].append({
                "first_word": int(word[start]), "end_word": int(word[end - 1]) + 1,
                "first_byte": int(lo_byte[start]), "end_byte": int(hi_byte[end - 1])})
        for d, w in np.unique(np.stack((doc[at], which), axis=1), axis=0):
            out[d][5].extend(phrases.item_of[phrases.item_from[w]:phrases.item_from[w + 1]])
        return [(*r[:5], sorted(set(map(int, r[5])))) for r in out]


def _scan(phrases: Phrases):
    """Task function: batches of (doc_id, text, _id, _th) to rows of :data:`COLUMNS`."""
    span = pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "first_byte",
                                                 "end_byte")])
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "_id", "_th", "n_words")]
                       + [("spans", pa.list_(span)), ("items", pa.list_(pa.int64()))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << 20, bool)  # a first test on the leading bits of the hash
        known[phrases.vocabulary >> np.uint64(44)] = True
        shard = _Shard()
        for batch in batches:
            heads = list(zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))))
            for first, last, data, starts in texts(batch.column(1)):
                lo, hi, hashes = words(data, ALNUM)
                doc = np.searchsorted(starts, lo, "right") - 1
                begin = np.searchsorted(doc, np.arange(last - first + 1))
                maybe = np.flatnonzero(known[hashes >> np.uint64(44)])
                place = np.searchsorted(phrases.vocabulary, hashes[maybe])
                place[place == len(phrases.vocabulary)] = 0
                sure = phrases.vocabulary[place] == hashes[maybe] if len(maybe) else maybe > 0
                at, number = maybe[sure], place[sure] + 1
                # Stretches of consecutive item words within one document.
                cut = np.flatnonzero((np.diff(at, prepend=-2) != 1)
                                     | (np.diff(doc[at], prepend=-1) != 0))
                size = np.diff(np.append(cut, len(at)))
                keep = size >= phrases.shortest
                cut, size, kept = cut[keep], size[keep], np.cumsum(size[keep])
                done = 0
                owner = doc[at[cut]] if len(cut) else cut
                for i in range(last - first):
                    upto = int(np.searchsorted(owner, i, "right"))
                    if upto > done:
                        picked = np.concatenate([np.append(np.arange(a, a + s), -1)
                                                 for a, s in zip(cut[done:upto], size[done:upto])])
                        gap = picked < 0
                        w = at[picked]
                        shard.add(np.where(gap, 0, number[picked]),
                                  np.full(len(picked), len(shard.docs)), w - begin[i],
                                  lo[w] - starts[i], hi[w] - starts[i])
                        done = upto
                    shard.docs.append((*heads[first + i], int(begin[i + 1] - begin[i])))
                    if shard.size >= SHARD_WORDS or len(shard.docs) >= SHARD_DOCS:
                        yield batch_of(shard.rows(phrases))
                        shard = _Shard()
        if shard.docs:
            yield batch_of(shard.rows(phrases))

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several blocks of items, brought together per document, made disjoint."""
    for batch in batches:
        at = batch.schema.get_field_index("spans")
        joined = []
        for spans in batch.column(at).to_pylist():
            out = []
            for s in sorted(spans, key=lambda s: s["first_word"]):
                if out and s["first_word"] <= out[-1]["end_word"]:
                    if s["end_word"] > out[-1]["end_word"]:
                        out[-1].update(end_word=s["end_word"], end_byte=s["end_byte"])
                else:
                    out.append(s)
            joined.append(out)
        yield batch.set_column(at, batch.schema.field(at),
                               pa.array(joined, batch.schema.field(at).type))


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Where the windows of ``items`` (item_id, text) occur in ``docs`` (doc_id, text).

    Per document row: doc_id, its key (_id, _th), n_words, ``spans`` (merged, disjoint, in order;
    words from 0 and bytes, ends exclusive) and ``items`` (distinct ids with an occurring window,
    sorted). Repeated rows are reported each. Null and empty texts have no words; items
    without words occur nowhere. Rows of one item_id are one item; an item without id marks words
    but is not listed. Adjacent spans are joined. Without items or documents nothing is found.
    """
    found = items.agg(F.expr("coalesce(sum(octet_length(text)), 0)")).first()[0]
    blocks = max(1, -(-int(found) // item_bytes))
    narrow = keyed(docs.selectExpr("cast(doc_id as bigint) as doc_id", "text"))
    results = []
    for block in range(blocks):
        part = items.selectExpr("cast(item_id as bigint) as item_id", "text").filter(
            f"pmod(xxhash64(item_id, text), {blocks}) = {block}"
        )
        phrases = Phrases.of([(r.item_id, r.text) for r in part.toLocalIterator()], window)
        results.append(narrow.mapInArrow(_scan(phrases), COLUMNS))
    if blocks == 1:
        return results[0]
    union = results[0]
    for more in results[1:]:
        union = union.unionByName(more)
    joined = union.groupBy("_id", "_th").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"),
    )
    return narrow.select("doc_id", "_id", "_th").join(joined, ["_id", "_th"]).select(
        "doc_id", "_id", "_th", "n_words", "spans", "items"
    ).mapInArrow(_merged, COLUMNS)


def verdicts(found: DataFrame) -> DataFrame:
    """:func:`find_items` with n_hit, n_items, items_sha256 and contaminated."""
    return found.selectExpr(
        "*", "aggregate(spans, 0L, (n, s) -> n + s.end_word - s.first_word) as n_hit",
        "cast(size(items) as bigint) as n_items",
        "sha2(array_join(array_sort(transform(items, i -> cast(i as string))), ','), 256) "
        "as items_sha256",
    ).selectExpr("*", f"n_hit > 0 and {ONE_IN} * n_hit >= n_words as contaminated")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    bad = verdicts(find_items(docs, items)).filter("contaminated").select("_id", "_th").distinct()
    key = docs.selectExpr(
        "struct(*) as _row", "coalesce(cast(doc_id as bigint), -9223372036854775808) as _id",
        "xxhash64(doc_id is null, coalesce(text, '')) as _th",
    )
    return key.join(bad, ["_id", "_th"], "left_anti").select("_row.*")
