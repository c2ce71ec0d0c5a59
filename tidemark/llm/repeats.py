"""Suffix-array dedup: removal of every byte covered by a long string that occurs twice.

A full suffix array is not needed: suffixes have to be in order only through the first ``DEPTH``
bytes, and only as far as they have company. So suffixes are radix sorted by most significant
digits, a group that has shrunk to one suffix is dropped, and groups still together at ``DEPTH``
are exactly the repeated windows.

First digit. In every window of DEPTH bytes the stretch of KEY bytes with the least hash is its
anchor. Equal windows have equal anchors at equal places, so windows are dealt out by their
anchor's hash; about one position in seventy is an anchor. Anchors met once in the corpus drop
out with all their windows.

Second digit. Each remaining anchor is looked at with the bytes around it that any of its windows
can hold. Contexts that are equal throughout, by a 64-bit hash beside the anchor's, are counted,
where they are read first: copies of a passage collapse here, however many there are.

Further digits. The distinct contexts of an anchor are sorted byte by byte outward from the
anchor, to the right and to the left, groups of one dropping out, for many anchors at once. The
window that reaches o bytes to the left is repeated when two contexts share both groups. An anchor
with very many distinct contexts is dealt to several tasks; what these leave open is settled by
counting window digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import drop_stage, keyed, stage
from tidemark.llm.wordhash import mix, texts

DEPTH = 200
KEY = 64
#: Distinct contexts sorted together; an anchor with more is dealt to several tasks.
GROUP = 20_000
_BLOCK = 1 << 20
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(np.arange(7, 40, dtype=np.uint64)) | np.uint64(1)
_SPANS = "array<struct<lo: bigint, hi: bigint>>"


def stretch_hashes(data: np.ndarray, size: int = KEY) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes (a power of two) from each position."""
    h, width = _LETTER[data], 1
    while width < size:
        h = h[:-width] * _FACTORS[width.bit_length()] + h[width:]
        width *= 2
    return mix(h)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    n, have = len(x) - width + 1, 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:n], x[width - have:width - have + n])


def anchors(data: np.ndarray, starts: np.ndarray, depth: int = DEPTH
            ) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all windows that lie within one document.

    ``starts`` are the documents' first bytes in ``data``, and its end; a document's last byte is
    a separator. Long inputs are worked on in overlapping blocks.
    """
    width = depth - KEY + 1
    inside = np.zeros(len(data) + 1, np.int32)
    long = np.diff(starts) - 1 >= depth
    np.add.at(inside, starts[:-1][long], 1)
    np.add.at(inside, starts[1:][long] - depth, -1)
    valid = np.cumsum(inside[:-1]) > 0
    places, hashes = [], []
    for at in range(0, max(0, len(data) - depth + 1), _BLOCK):
        block = data[at:at + _BLOCK + depth - 1]
        h = stretch_hashes(block)
        least = _sliding(h, width, np.minimum)
        least[~valid[at:at + len(least)]] = 0
        padded = np.concatenate((np.zeros(width - 1, np.uint64), least,
                                 np.zeros(width - 1, np.uint64)))
        chosen = np.flatnonzero(h == _sliding(padded, width, np.maximum))
        places.append(chosen + at)
        hashes.append(h[chosen])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found, first = np.unique(np.concatenate(places), return_index=True)
    return found, np.concatenate(hashes)[first]


def _anchor_rows(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in texts(batch.column(0)):
                at, h = anchors(data, starts, depth)
                doc = np.searchsorted(starts, at, "right") - 1
                take = pa.array(doc + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), batch.column(1).take(take),
                     batch.column(2).take(take), pa.array(at - starts[doc])],
                    names=["h", "_id", "_th", "pos"])

    return run


def _context_rows(depth: int):
    """(text, _id, _th, anchors) to (h, c, _id, _th, pos, lv, size): every anchor's context, hashed.

    ``lv`` is how many of its ``size`` bytes stand before the anchor.
    """
    reach = depth - KEY
    names = ["h", "c", "_id", "_th", "pos", "lv", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for i in range(batch.num_rows):
                text = (batch.column(0)[i].as_py() or "").encode("utf-8", "surrogatepass")
                found = batch.column(3)[i].values
                pos = found.field("pos").to_numpy(zero_copy_only=False)
                lv = np.minimum(pos, reach)
                c = [digest(text[p - v:p + depth], seed=v)
                     for p, v in zip(pos.tolist(), lv.tolist())]
                n = len(pos)
                yield pa.RecordBatch.from_arrays([
                    found.field("h"), pa.array(np.array(c, np.uint64).view(np.int64)),
                    pa.repeat(batch.column(1)[i], n), pa.repeat(batch.column(2)[i], n),
                    pa.array(pos), pa.array(lv),
                    pa.array(np.minimum(pos + depth, len(text)) - pos + lv),
                ], names=names)

    return run


def _context_bytes(depth: int):
    """(text, wanted) to (h, salt, parts, c, lv, context, n) of the contexts wanted of a text."""
    names = ["h", "salt", "parts", "c", "lv", "context", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(0)[i].as_py().encode("utf-8", "surrogatepass")
                want = batch.column(1)[i].values
                pos, lv = (want.field(x).to_pylist() for x in ("pos", "lv"))
                context = pa.array([text[p - v:p + depth] for p, v in zip(pos, lv)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [context if x == "context" else want.field(x) for x in names], names=names)

    return run


def _refined(digits: np.ndarray, valid: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Group of each row by its first t digits, t = 0..width; -1 once a row is alone or ended."""
    rows, width = digits.shape
    out = np.full((width + 1, rows), -1, np.int32)
    live = np.arange(rows)
    now = group.astype(np.int64)
    for t in range(width + 1):
        if t:
            live = live[valid[live] >= t]
            now = now[live] * 256 + digits[live, t - 1] if len(live) else now[:0]
        _, which, count = np.unique(now, return_inverse=True, return_counts=True)
        together = count[which] > 1
        live = live[together]
        out[t, live] = which[together]
        if not len(live):
            break
        now = np.zeros(rows, np.int64)
        now[live] = which[together]
    return out


def repeated_windows(groups: np.ndarray, lefts: np.ndarray, contexts: list[bytes],
                     depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(repeated, class): for context k and o bytes to the left, is that window found elsewhere?

    ``class`` numbers equal windows per o, -1 where a window is alone or leaves the context.
    """
    reach, rows = depth - KEY, len(contexts)
    right, left = np.zeros((rows, reach), np.uint8), np.zeros((rows, reach), np.uint8)
    rights = np.zeros(rows, np.int64)
    first: dict[tuple[int, bytes], int] = {}
    start = np.zeros(rows, np.int64)
    for k, context in enumerate(contexts):
        lv = int(lefts[k])
        # The anchor's own bytes are the first digit, so equal hashes alone never match.
        start[k] = first.setdefault((int(groups[k]), context[lv:lv + KEY]), len(first))
        after = np.frombuffer(context, np.uint8)[lv + KEY:]
        rights[k] = len(after)
        right[k, :len(after)] = after
        left[k, :lv] = np.frombuffer(context, np.uint8)[:lv][::-1]
    by_right, by_left = _refined(right, rights, start), _refined(left, lefts, start)
    classes = np.full((rows, reach + 1), -1, np.int64)
    for o in range(reach + 1):
        a, b = by_left[o], by_right[reach - o]
        both = np.flatnonzero((a >= 0) & (b >= 0))
        if len(both):
            key = a[both].astype(np.int64) * (rows + 1) + b[both]
            _, which, count = np.unique(key, return_inverse=True, return_counts=True)
            more = count[which] > 1
            classes[both[more], o] = which[more]
    return classes >= 0, classes


def _spans_of(offsets: np.ndarray, depth: int) -> list[dict]:
    """Bytes relative to the anchor that the windows reaching these offsets to the left cover."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > 1)
    lows, highs = np.append(offsets[0], offsets[cut + 1]), np.append(offsets[cut], offsets[-1])
    return [{"lo": -int(h), "hi": depth - int(low)} for low, h in zip(lows, highs)]


def _sorted_groups(depth: int):
    """Rows (h, salt, parts, c, lv, context, n) in groups to (h, c, spans, open)."""
    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    window = pa.list_(pa.struct([("w", pa.binary()), ("o", pa.int64()), ("alone", pa.bool_())]))
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("spans", span), ("open", window)])

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        keys = [r[:2] for r in rows]
        number = np.cumsum([0] + [a != b for a, b in zip(keys[1:], keys)])
        lefts, contexts = np.array([r[4] for r in rows]), [r[5] for r in rows]
        repeated, classes = repeated_windows(number, lefts, contexts, depth)
        out, seen = [], set()
        for k, (h, _, parts, c, lv, context, n) in enumerate(rows):
            spans = _spans_of(np.flatnonzero(repeated[k]), depth) if n == 1 else []
            left = []
            if parts > 1:
                for o in range(max(0, depth - len(context) + lv), lv + 1):
                    mark = (number[k], o, classes[k, o])
                    if classes[k, o] >= 0 and mark in seen:
                        continue
                    seen.add(mark)
                    digest = hashlib.blake2b(context[lv - o:lv - o + depth], digest_size=16)
                    left.append({"w": digest.digest(), "o": o,
                                 "alone": bool(classes[k, o] < 0 and n == 1)})
            if spans or left:
                out.append((h, c, spans, left))
        columns = list(zip(*out)) if out else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if len(held) >= GROUP and row[:2] != held[-1][:2]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _th, text, spans) to (_id, _th, spans merged, n_removed, kept_sha256)."""
    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for batch in batches:
        out = []
        for key, th, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
            merged: list[list[int]] = []
            for lo, hi in sorted({(s["lo"], s["hi"]) for s in spans}):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            data, kept, at = (text or "").encode("utf-8", "surrogatepass"), hashlib.sha256(), 0
            for lo, hi in merged:
                kept.update(data[at:lo])
                at = hi
            kept.update(data[at:])
            out.append((key, th, [{"lo": lo, "hi": hi} for lo, hi in merged],
                        sum(hi - lo for lo, hi in merged), kept.hexdigest()))
        kinds = [pa.int64(), pa.int64(), span, pa.int64(), pa.string()]
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds)],
            names=["_id", "_th", "spans", "n_removed", "kept_sha256"])


def repeated_spans(docs: DataFrame, depth: int = DEPTH, group: int = GROUP) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, spans, n_removed, kept_sha256.

    ``spans`` are the maximal runs of bytes [lo, hi) covered by a string of ``depth`` bytes that
    also starts elsewhere, in the same document or another; strings never cross documents, and are
    judged on the input. Repeated rows are copies of each other: each is removed whole if it has
    ``depth`` bytes. Null text is empty. Texts under ``depth`` bytes keep everything.
    """
    narrow = keyed(docs.selectExpr("cast(doc_id as bigint) as doc_id", "text"))
    found = stage(narrow.filter(f"octet_length(text) >= {depth}").select("text", "_id", "_th")
                  .mapInArrow(_anchor_rows(depth), "h bigint, _id bigint, _th bigint, pos bigint"))
    # Written, so that the join below deals out both sides itself and can split a hot anchor.
    twice = stage(found.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h"))
    # A document's own anchors: their number is bounded by its length.
    per_doc = stage(found.join(twice, "h").groupBy("_id", "_th").agg(
        F.expr("collect_set(struct(h, pos)) as anchors")
    ))
    drop_stage(found, twice)
    held = stage(narrow.select("text", "_id", "_th").join(per_doc, ["_id", "_th"])
                 .select("text", "_id", "_th", "anchors"))
    drop_stage(per_doc)
    # Texts by key; repeated rows are told apart only by being counted in ``occurring``.
    one = held.select("_id", "_th", "text").dropDuplicates(["_id", "_th"])
    occurring = stage(held.mapInArrow(
        _context_rows(depth), "h bigint, c bigint, _id bigint, _th bigint, pos bigint, "
        "lv bigint, size bigint"
    ))
    contexts = stage(occurring.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.expr("min(struct(_id, _th, pos, lv, size)) as at")
    ).select("h", "c", "n", "at.*"))
    whole = contexts.filter(f"n > 1 and size >= {depth}").selectExpr(
        "h", "c", "array(struct(-lv as lo, size - lv as hi)) as spans"
    )
    sizes = contexts.groupBy("h").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    # Bytes are only needed where an anchor has several contexts, one of each.
    wanted = contexts.join(sizes.filter("k > 1 and least = 1"), "h").selectExpr(
        "_id", "_th", f"struct(h, pmod(c, 1 + k div {group}) as salt, 1 + k div {group} as parts, "
        "c, pos, lv, n) as want",
    ).groupBy("_id", "_th").agg(F.collect_list("want").alias("wanted"))
    dealt = one.join(wanted, ["_id", "_th"]).select("text", "wanted").mapInArrow(
        _context_bytes(depth), "h bigint, salt bigint, parts bigint, c bigint, lv bigint, "
        "context binary, n bigint"
    ).repartition("h", "salt").sortWithinPartitions("h", "salt", "c")
    sorted_ = stage(dealt.mapInArrow(
        _sorted_groups(depth), f"h bigint, c bigint, spans {_SPANS}, "
        "open array<struct<w: binary, o: bigint, alone: boolean>>"
    ))
    opened = sorted_.selectExpr("h", "c", "inline(open)")
    again = opened.groupBy("h", "o", "w").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
    late = opened.filter("alone").join(again, ["h", "o", "w"]).selectExpr(
        "h", "c", f"array(struct(-o as lo, {depth} - o as hi)) as spans"
    )
    covered = whole.unionByName(sorted_.filter("size(spans) > 0").select("h", "c", "spans"))
    covered = covered.unionByName(late)
    spans = stage(occurring.select("h", "c", "_id", "_th", "pos").join(covered, ["h", "c"])
                  .groupBy("_id", "_th").agg(F.expr(
        "flatten(collect_list(transform(spans, s -> struct(s.lo + pos as lo, s.hi + pos as hi)))) "
        "as spans"
    )))
    drop_stage(occurring, contexts, sorted_)
    cut = stage(one.join(spans, ["_id", "_th"]).select("_id", "_th", "text", "spans").mapInArrow(
        _removed, f"_id bigint, _th bigint, spans {_SPANS}, n_removed bigint, kept_sha256 string"
    ))
    drop_stage(held, spans)
    plain = narrow.selectExpr(
        "doc_id", "_id", "_th", "cast(octet_length(coalesce(text, '')) as bigint) as n_bytes",
        "sha2(coalesce(text, ''), 256) as whole",
    )
    return plain.join(cut, ["_id", "_th"], "left").selectExpr(
        "doc_id", "n_bytes", f"coalesce(spans, cast(array() as {_SPANS})) as spans",
        "coalesce(n_removed, 0L) as n_removed", "coalesce(kept_sha256, whole) as kept_sha256",
    )
