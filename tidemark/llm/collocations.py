"""Phrases whose words occur together more often than apart, mined from stripes.

A stripe is a prefix with an associative counter of the words found right after it; the counter's
empty word stands for places where no counted word follows, so a stripe's sum is the frequency of
its prefix. Tasks make stripes of their own texts, and stripes of one prefix are merged element by
element. One merged structure then holds extensions (its elements), prefix totals (its sum) and,
for subsumption, the best extension (its maximum).

Stripes are made twice: first for prefixes of one word, then for those of two words. A phrase of
three words cannot be frequent unless both its pairs are, so the second pass keeps only places
where a bitmap of the frequent pairs says so. The bitmap is bounded; where two pairs fall on one
bit, a few more places are kept than needed, and none is lost.

Frequent prefixes have large stripes. A prefix whose stripes hold more than a fixed share of all
elements is cut by its next words into pieces of about equal size, which are merged apart; so no
task holds a whole vocabulary, and what is known of cut prefixes, their sizes, is bounded by the
inverse of that share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import drop_stage, stage
from tidemark.llm.wordhash import texts

LEAST = 10                #: occurrences of a candidate
COVERED_PERCENT = 50      #: a longer candidate as frequent as this hides what lies inside it
TOP = 2000                #: phrases reported per language
#: Words a task gathers before it writes their stripes; keys of these many words fit 63 bits.
HELD_WORDS = 1_500_000
#: A prefix is cut where its stripes hold more elements than this and than all / MAX_CUT.
CUT, MAX_CUT = 1 << 18, 10_000
#: Sizes are added up by a hash of the prefix first: only prefixes in buckets beyond the limit can
#: be beyond it themselves.
SIZE_BUCKETS = 1 << 16
#: Bits of the map of frequent pairs: this many per pair, at most 16 MB.
BITS_PER_PAIR, MAX_BITS = 32, 1 << 27
#: Reports are ranked in this many parts per language first.
PARTS = 64

# Bytes of words, of gaps between words and of breaks between pieces.
_KIND = np.zeros(256, np.int8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Odd factors under 2^29, for sums of products with CRCs that stay below 2^63.
_FACTORS = (420_196_141, 369_492_977, 505_290_271)

# Until stripes are merged, their words are one string joined by spaces, which no word holds.
LOCAL = "lang string, prefix string, size int, next string, n array<int>"
PIECES = "lang string, prefix string, cut int, next string, n array<int>"
MERGED = "lang string, prefix string, cut int, total bigint, best bigint, next array<string>, n array<bigint>"


def _crcs(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w.as_buffer()) if w.is_valid else 0 for w in words.cast(pa.binary())], np.int64)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _joined(offsets: np.ndarray, words: pa.Array) -> pa.Array:
    return pc.binary_join(_lists(offsets, words), " ")


class _Words:
    """Words of many texts in a row, with their language and piece."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.size, self.breaks, self.words, self.pieces, self.owners = 0, 0, [], [], []
        self.langs: dict[str, int] = {}

    def add(self, batch: pa.RecordBatch) -> Iterator[None]:
        """A step for about every megabyte of text."""
        names = batch.column("lang").to_pylist()
        for first, last, data, starts in texts(batch.column("text")):
            codes = np.array([self.langs.setdefault(x, len(self.langs)) for x in names[first:last]], np.int32)
            kind = _KIND[data]
            inside = np.zeros(len(data) + 2, np.int8)
            inside[1:-1] = kind == 0
            edges = np.flatnonzero(np.diff(inside))
            lo, hi = edges[::2], edges[1::2]
            offsets = np.zeros(len(lo) + 1, np.int64)
            np.cumsum(hi - lo, out=offsets[1:])
            values = _LOWER[data[kind == 0]]
            self.words.append(pa.Array.from_buffers(
                pa.large_string(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(values)]))
            count = np.cumsum(kind == 2, dtype=np.int32)
            self.pieces.append(count[lo] + np.int32(self.breaks))
            self.breaks += int(count[-1]) if len(count) else 0
            self.owners.append(codes[np.searchsorted(starts, lo, "right") - 1])
            self.size += len(lo)
            yield

    def stripes(self, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Stripes of one word, or of the pairs in the bitmap."""
        coded = pa.chunked_array(self.words, pa.large_string()).dictionary_encode().unify_dictionaries()
        code = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
        names = coded.chunk(0).dictionary.cast(pa.string())
        piece, owner = np.concatenate(self.pieces), np.concatenate(self.owners)
        langs = pa.array(list(self.langs), pa.string())
        self.clear()
        del coded
        end = len(names)  # the empty word
        names = pa.concat_arrays([names, pa.array([""], pa.string())])
        base = len(names)
        joined = np.zeros(len(code), bool)
        joined[:-1] = piece[1:] == piece[:-1]
        del piece
        after = np.full(len(code), end, np.int32)
        after[:-1][joined[:-1]] = code[1:][joined[:-1]]
        prefix = owner.astype(np.int64) * base + code
        if pairs is None:
            keys = prefix * base + after
        else:
            crc = _crcs(names)
            a, b, c = _FACTORS
            at = (crc[code] * a + crc[after] * b + _crcs(langs)[owner] * c) % (8 * len(pairs))
            joined &= pairs[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            del at
            follow = np.full(len(code), end, np.int32)
            follow[:-1][joined[1:]] = after[1:][joined[1:]]
            two, which = np.unique((prefix * base + after)[joined], return_inverse=True)
            keys = which * base + follow[joined]
            del follow, which
        del code, owner, after, prefix, joined
        keys, n = np.unique(keys, return_counts=True)
        owner_of, word = keys // base, keys % base
        del keys
        heads = np.flatnonzero(np.diff(owner_of, prepend=-1))
        step = max(1, len(heads) * 200_000 // max(1, len(word)))  # stripes in about 200,000 elements
        for lo in range(0, len(heads), step):
            some = heads[lo:lo + step]
            stop = heads[lo + step] if lo + step < len(heads) else len(word)
            held = owner_of[some]
            if pairs is None:
                phrase = names.take(pa.array(held % base))
            else:
                held, second = two[held] // base, two[held] % base
                phrase = pc.binary_join_element_wise(
                    names.take(pa.array(held % base)), names.take(pa.array(second)), " ")
            offsets = np.append(some, stop) - some[0]
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(held // base)), phrase, pa.array(np.diff(offsets), pa.int32()),
                _joined(offsets, names.take(pa.array(word[some[0]:stop]))),
                _lists(offsets, pa.array(n[some[0]:stop], pa.int32())),
            ], ["lang", "prefix", "size", "next", "n"])


def _local(pairs):
    """Function that turns texts into stripes of one word, or of pairs where a bitmap is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        held = _Words()
        for batch in batches:
            for _ in held.add(batch):
                if held.size >= HELD_WORDS:
                    yield from held.stripes(bitmap)
        if held.size:
            yield from held.stripes(bitmap)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes cut into pieces 1..cuts by the CRC of their next words."""
    for batch in batches:
        lists, n = pc.split_pattern(batch.column("next"), " "), batch.column("n").flatten()
        coded = lists.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        crc = _crcs(coded.dictionary)[coded.indices.to_numpy()]
        piece = crc % batch.column("cuts").to_numpy()[row] + 1
        order = np.lexsort((piece, row))
        row, piece = row[order], piece[order]
        heads = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(piece, prepend=0) != 0))
        which, offsets, taken = pa.array(row[heads]), np.append(heads, len(row)), pa.array(order)
        yield pa.RecordBatch.from_arrays([
            batch.column("lang").take(which), batch.column("prefix").take(which),
            pa.array(piece[heads], pa.int32()),
            _joined(offsets, coded.dictionary.take(coded.indices.take(taken))), _lists(offsets, n.take(taken)),
        ], ["lang", "prefix", "cut", "next", "n"])


def _merge(least: int):
    """Function that adds up neighbouring stripes of one key; rows come sorted by key."""

    def added(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Its keys, one row each, with the start of each key's elements, words and counts."""
        keys = [table.column(c).combine_chunks() for c in ("lang", "prefix", "cut")]
        fresh = np.ones(table.num_rows, bool)
        fresh[1:] = np.logical_or.reduce(
            [pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False) for k in keys])
        group = np.cumsum(fresh) - 1
        lists = pc.split_pattern(table.column("next").combine_chunks(), " ")
        coded = lists.flatten().dictionary_encode()
        base = len(coded.dictionary) + 1
        element = np.repeat(group, pc.list_value_length(lists).to_numpy()) * base + coded.indices.to_numpy()
        order = np.argsort(element, kind="stable")
        element = element[order]
        heads = np.flatnonzero(np.diff(element, prepend=-1))
        n = table.column("n").combine_chunks().flatten().to_numpy().astype(np.int64)[order]
        n = np.add.reduceat(n, heads) if len(heads) else n
        element = element[heads]
        starts = np.searchsorted(element // base, np.arange(group[-1] + 2))
        first = pa.array(np.flatnonzero(fresh))
        return table.select(["lang", "prefix", "cut"]).take(first), starts, element // base, \
            coded.dictionary.take(pa.array(element % base)), n

    def told(keys, starts, group, words, n) -> pa.RecordBatch:
        total = np.add.reduceat(n, starts[:-1])
        often = (n >= least) & pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        best = np.zeros(len(total), np.int64)
        np.maximum.at(best, group[often], n[often])
        sizes = np.bincount(group[often], minlength=len(total))
        cut = keys.column("cut").to_numpy()
        kept = np.flatnonzero((total >= least) | (cut > 0))
        rest = np.flatnonzero((total < least) & (cut == 0))  # these have no frequent element
        lang = keys.column("lang").combine_chunks()
        spare = lang.take(pa.array(rest)).dictionary_encode()
        sums = np.bincount(spare.indices.to_numpy(), weights=total[rest], minlength=len(spare.dictionary))
        k, m = pa.array(kept), len(spare.dictionary)
        offsets = np.zeros(len(kept) + m + 1, np.int64)
        np.cumsum(sizes[kept], out=offsets[1:len(kept) + 1])
        offsets[len(kept) + 1:] = offsets[len(kept)]
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([lang.take(k), spare.dictionary]),
            pa.concat_arrays([keys.column("prefix").combine_chunks().take(k), pa.array([""] * m, pa.string())]),
            pa.array(np.append(cut[kept], np.zeros(m)), pa.int32()),
            pa.array(np.append(total[kept], sums.astype(np.int64))),
            pa.array(np.append(best[kept], np.zeros(m, np.int64))),
            _lists(offsets, words.filter(pa.array(often))), _lists(offsets, pa.array(n[often])),
        ], ["lang", "prefix", "cut", "total", "best", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key = None  # the last key of a batch goes on in the next one
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.set_column(4, "n", table.column("n").cast(pa.list_(pa.int64())))
            if not table.num_rows:
                continue
            if open_key is not None:
                table = pa.concat_tables([open_key, table]).combine_chunks()
            keys, starts, group, words, n = added(table)
            at, last = int(starts[-2]), keys.num_rows - 1
            open_key = keys.slice(last).append_column(
                "next", _joined(np.array([0, len(n) - at]), words.slice(at))
            ).append_column("n", _lists(np.array([0, len(n) - at]), pa.array(n[at:])))
            if last:
                yield told(keys.slice(0, last), starts[:-1], group[:at], words.slice(0, at), n[:at])
        if open_key is not None:
            yield told(*added(open_key))

    return run


def merged_stripes(local: DataFrame, least: int) -> DataFrame:
    """Staged: one row per (lang, prefix, cut) with the sum over all its elements, its frequent
    elements and the largest of them; prefixes rarer than ``least`` come as one or more rows per
    language with an empty prefix."""
    entries = local.agg(F.expr("coalesce(sum(size), 0)")).first()[0]
    limit = max(CUT, entries // MAX_CUT)
    sizes = local.selectExpr("lang", "prefix", "size", f"pmod(xxhash64(lang, prefix), {SIZE_BUCKETS}) as bucket")
    heavy = sizes.groupBy("bucket").agg(F.sum("size").alias("entries")).filter(f"entries > {limit}").select("bucket")
    # Fewer than MAX_CUT prefixes can hold more than a MAX_CUT-th of all elements.
    large = sizes.join(F.broadcast(heavy), "bucket").groupBy("lang", "prefix").agg(
        F.sum("size").alias("entries")).filter(
        f"entries > {limit}").selectExpr("lang", "prefix", f"cast(ceil(entries / {limit}) as bigint) as cuts")
    large = F.broadcast(stage(large))
    whole = local.join(large, ["lang", "prefix"], "left_anti").selectExpr(
        "lang", "prefix", "0 as cut", "next", "n")
    pieces = local.join(large, ["lang", "prefix"]).select("lang", "prefix", "next", "n", "cuts").mapInArrow(
        _cut, PIECES)
    dealt = whole.unionByName(pieces).repartition("lang", "prefix", "cut")
    return stage(dealt.sortWithinPartitions("lang", "prefix", "cut").mapInArrow(_merge(least), MERGED))


def stripes(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Merged stripes of one-word and of two-word prefixes."""
    rows = docs.selectExpr("coalesce(lang, 'und') as lang", "coalesce(text, '') as text")
    spark = docs.sparkSession
    local = stage(rows.mapInArrow(_local(None), LOCAL))
    ones = merged_stripes(local, least)
    drop_stage(local)
    pairs = ones.selectExpr("lang", "prefix", "explode(next) as next")
    bits = 1 << 15
    while bits < min(MAX_BITS, BITS_PER_PAIR * pairs.count()):
        bits *= 2
    a, b, c = _FACTORS
    at = " + ".join(f"crc32(cast({x} as binary)) * {f}L" for x, f in (("prefix", a), ("next", b), ("lang", c)))
    parts = pairs.selectExpr(f"({at}) % {bits} + 1 as v").groupBy(
        F.expr("bitmap_bucket_number(v) as part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(v)) as b"))
    bitmap = bytearray(bits // 8)
    for part, piece in parts.collect():
        bitmap[(part - 1) * 4096:part * 4096] = piece
    sent = spark.sparkContext.broadcast(bytes(bitmap))
    local = stage(rows.mapInArrow(_local(sent), LOCAL))
    twos = merged_stripes(local, least)
    drop_stage(local)
    return ones, twos


def score(a: str, left: str, right: str) -> str:
    """SQL text: floor(1000000 * a * a / (left * right)), exact as the products have 38 digits."""
    wide = [f"cast({x} as decimal(18, 0))" for x in (a, left, right)]
    return f"((1000000 * {wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]}))"


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words per
    language by score, frequency and phrase.

    Null language is ``und``, null text empty; repeated rows count as often as they occur; other
    columns play no part; no documents, or no phrase found ``least`` times: no rows. ``a`` is the
    phrase's frequency, ``l`` and ``r`` those of its parts at the lowest-scoring cut, ``n`` the
    words of the language. Words are told apart by their characters, never by hashes.
    """
    ones, twos = stripes(docs, least)
    words = ones.filter("prefix <> ''").groupBy("lang", "prefix").agg(F.sum("total").alias("f")).filter(f"f >= {least}")
    words = words.selectExpr("lang as wl", "prefix as word", "f")
    sizes = ones.groupBy("lang").agg(F.sum("total").alias("n")).withColumnRenamed("lang", "nl")
    pair = stage(
        ones.selectExpr("lang", "prefix", "inline(arrays_zip(next, n))").selectExpr(
            "lang", "concat(prefix, ' ', next) as phrase", "prefix", "next", "n as a")
        .join(words.withColumnRenamed("f", "l"), F.expr("lang = wl and prefix = word")).drop("wl", "word")
        .join(words.withColumnRenamed("f", "r"), F.expr("lang = wl and next = word")).drop("wl", "word")
    )
    triple = twos.selectExpr("lang", "prefix", "inline(arrays_zip(next, n))").selectExpr(
        "lang", "concat(prefix, ' ', next) as phrase", "split(prefix, ' ')[0] as head", "prefix",
        "concat(split(prefix, ' ')[1], ' ', next) as rest", "next", "n as a")
    two = pair.selectExpr("lang as wl", "phrase as word", "a as f")
    triple = stage(
        triple.join(words.withColumnRenamed("f", "l1"), F.expr("lang = wl and head = word")).drop("wl", "word")
        .join(two.withColumnRenamed("f", "r1"), F.expr("lang = wl and rest = word")).drop("wl", "word")
        .join(two.withColumnRenamed("f", "l2"), F.expr("lang = wl and prefix = word")).drop("wl", "word")
        .join(words.withColumnRenamed("f", "r2"), F.expr("lang = wl and next = word")).drop("wl", "word")
        .selectExpr("*", f"{score('a', 'l1', 'r1')} as s1", f"{score('a', 'l2', 'r2')} as s2")
        .selectExpr("lang", "phrase", "rest", "a", "if(s1 <= s2, l1, l2) as l", "if(s1 <= s2, r1, r2) as r",
                    "least(s1, s2) as score")
    )
    # The most frequent candidate around a pair, on either side of it.
    around = twos.filter("best > 0").selectExpr("lang as wl", "prefix as word", "best").unionByName(
        triple.selectExpr("lang as wl", "rest as word", "a as best")
    ).groupBy("wl", "word").agg(F.max("best").alias("best"))
    shown = pair.join(around, F.expr("lang = wl and phrase = word"), "left").filter(
        f"best is null or 100 * best < {COVERED_PERCENT} * a"
    ).selectExpr("lang", "phrase", "a", "l", "r", f"{score('a', 'l', 'r')} as score").unionByName(
        triple.drop("rest"))
    ranked = "row_number() over (partition by lang{} order by score desc, a desc, phrase)"
    return (
        shown.withColumn("part", F.expr(f"pmod(xxhash64(phrase), {PARTS})"))
        .withColumn("rank", F.expr(ranked.format(", part"))).filter(f"rank <= {top}")
        .withColumn("rank", F.expr(ranked.format(""))).filter(f"rank <= {top}")
        .join(F.broadcast(sizes) if sizes.count() <= MAX_CUT else sizes, F.expr("lang = nl"))
        .selectExpr("lang", "cast(rank as bigint) as rank", "phrase", "a", "l", "r", "n", "score")
    )
