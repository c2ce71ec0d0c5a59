"""Toxicity of texts by a small convolutional network over hashed words.

A word is the sum of two rows of a hashed table and one row of a table of word beginnings, so that
two words are confused only where both their hashes meet. Filters of several widths slide over the
words of a whole text, each keeps its largest value, and a logistic unit weighs these maxima.

The network learns from every labelled document that is not held out, whole. These documents are
dealt to learners, tasks of some thousands each. Rows of words start from the signed root of their
likelihood ratio between the classes, counted over all learners; then in every epoch each learner
goes on from the common weights by gradient descent over its own documents, and what the learners
moved is averaged block by block by Spark. Unseen words stay at zero. A fixed share of the documents
is not fitted but sets the point that becomes score 0.5, and a threshold for every language with
enough labels. Only words enter a score; the language selects the threshold of the column ``flagged``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import drop_stage, fresh, release, stage
from tidemark.llm.wordhash import ALNUM, mix, texts, words

#: Documents that one learner takes on average; small tables have one learner.
LEARNER = 7500
#: Up to so many labels are broadcast to the documents; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Logits are counted in bins of one part in so many, up to LOGITS on both sides, to find a threshold.
BINS, LOGITS = 1024, 64
#: Rows of the weights that travel together.
ROWS = 4096
#: Every fifth row by doc_id is held out from everything that is learned.
FOLDS = 5
#: Of the fitted rows, one in this many only calibrates.
CALIBRATE = 4
TABLE, BEGINNINGS = 1 << 18, 1 << 15
WIDTHS, FILTERS, DIM = (1, 2, 3), 12, 8
EPOCHS, BATCH, RATE = 6, 32, 0.05
#: Labels of each class that a language needs in the calibrating rows for a threshold of its own.
OWN_THRESHOLD = 20
#: Positions whose filters are computed at once.
BLOCK = 1 << 16

PAD = max(WIDTHS) - 1
COLUMNS = sum(WIDTHS) * FILTERS


def word_rows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, rows): per word of a text its two rows of the table and that of its beginning."""
    lo, hi, h = words(data, ALNUM)
    start = np.zeros(len(lo), np.uint64)
    for i in range(4):
        at = np.minimum(lo + i, len(data) - 1)
        byte = data[at].astype(np.uint64)
        byte = np.where((byte >= 0x41) & (byte <= 0x5A), byte + np.uint64(0x20), byte)
        start |= np.where(lo + i < hi, byte, np.uint64(0)) << np.uint64(8 * i)
    rows = np.empty((len(lo), 3), np.int32)
    rows[:, 0] = h % np.uint64(TABLE)
    rows[:, 1] = mix(h + np.uint64(1)) % np.uint64(TABLE)
    rows[:, 2] = mix(start) % np.uint64(BEGINNINGS)
    return lo, rows


def documents(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, sizes) of some consecutive texts at a time: their words' rows, one after another."""
    for first, last, data, starts in texts(column):
        lo, rows = word_rows(data)
        yield rows, np.diff(np.append(np.searchsorted(lo, starts[:-1]), len(lo)))


class Network:
    """The weights, and what they make of words."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = np.zeros((TABLE + 1, DIM), np.float32)  # the last row is padding
        self.begin = np.zeros((BEGINNINGS + 1, DIM), np.float32)
        self.conv = (rng.standard_normal((DIM, COLUMNS)) * 0.1).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.1).astype(np.float32)
        self.base = np.full(1, -1, np.float32)  # a network that knows nothing calls nothing toxic
        # The first filter of each width starts by reading the likelihood ratio of its first word.
        at = 0
        for k, w in enumerate(WIDTHS):
            self.conv[:, at] = np.eye(DIM, dtype=np.float32)[0]
            self.out[k * FILTERS] = 1
            at += w * FILTERS

    def names(self):
        return ("table", "begin", "conv", "bias", "out", "base")

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.begin[rows[:, 2]]

    def filters(self, x: np.ndarray) -> np.ndarray:
        """Filter values at all positions but the last PAD ones."""
        z, n = x @ self.conv, len(x) - PAD
        out, at = np.empty((n, len(WIDTHS) * FILTERS), np.float32), 0
        for k, w in enumerate(WIDTHS):
            part = out[:, k * FILTERS:(k + 1) * FILTERS]
            part[:] = self.bias[k * FILTERS:(k + 1) * FILTERS]
            for j in range(w):
                part += z[j:n + j, at:at + FILTERS]
                at += FILTERS
        return out

    def maxima(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Largest value of each filter per text; memory depends on BLOCK, not on their length."""
        padded, begins = padded_rows(rows, sizes)
        ends = begins + np.maximum(sizes, 1)
        best = np.full((len(sizes), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, BLOCK):
            hi = min(lo + BLOCK, int(ends[-1]))
            values = self.filters(self.embed(padded[lo:hi + PAD]))
            first = int(np.searchsorted(ends, lo, "right"))
            last = int(np.searchsorted(begins, hi, "left"))
            if first == last:
                continue
            edges = np.stack([np.maximum(begins[first:last], lo), np.minimum(ends[first:last], hi)], 1) - lo
            edges = edges.ravel()[:-1] if edges[-1, 1] == hi - lo else edges.ravel()
            found = np.maximum.reduceat(values, edges)[::2]
            best[first:last] = np.maximum(best[first:last], found)
        return best

    def peaks(self, padded: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, positions in ``padded``) of those maxima, the first of equal ones; in the same blocks."""
        ends = begins + np.maximum(sizes, 1)
        best = np.full((len(sizes), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        at = np.zeros(best.shape, np.int64)
        for lo in range(0, int(ends[-1]), BLOCK):
            hi = min(lo + BLOCK, int(ends[-1]))
            values = self.filters(self.embed(padded[lo:hi + PAD]))
            for i in range(int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(begins, hi, "left"))):
                first = max(int(begins[i]) - lo, 0)
                part = values[first:min(int(ends[i]), hi) - lo]
                where = part.argmax(0)
                found = np.take_along_axis(part, where[None], 0)[0]
                at[i] = np.where(found > best[i], where + first + lo, at[i])
                best[i] = np.maximum(best[i], found)
        return best, at

    def logits(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.maximum(self.maxima(rows, sizes), 0) @ self.out + self.base[0]

    def save(self) -> bytes:
        held = io.BytesIO()
        used = {n: np.flatnonzero(np.any(getattr(self, n) != 0, axis=1)) for n in ("table", "begin")}
        np.savez_compressed(held, **{f"{n}_at": u for n, u in used.items()}, **{
            n: getattr(self, n)[used[n]] if n in used else getattr(self, n) for n in self.names()})
        return held.getvalue()

    @staticmethod
    def load(data: bytes) -> Network:
        net, held = Network(), np.load(io.BytesIO(data))
        for n in net.names():
            if n in ("table", "begin"):
                getattr(net, n)[held[f"{n}_at"]] = held[n]
            else:
                setattr(net, n, held[n])
        return net


def padded_rows(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with PAD rows of padding after each text, and one more for an empty text; its starts."""
    lengths = np.maximum(sizes, 1) + PAD
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    padded = np.full((int(lengths.sum()), 3), (TABLE, TABLE, BEGINNINGS), np.int32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded[begins[owner] + within] = rows
    return padded, begins


def ratios(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signed root of each table row's likelihood ratio between documents of the two classes;
    ``seen`` and ``n`` count the documents with the row and all documents, other and toxic ones."""
    (b, a), (n0, n1) = seen.astype(float), np.maximum(1, n)
    both = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x, n: np.where(x > 0, x * np.log(x / (both * n / (n0 + n1))), 0)
        root = np.sqrt(2 * np.maximum(part(a, n1) + part(b, n0), 0))
    return np.where(both > 1, np.where(a / n1 > b / n0, root, -root), 0).astype(np.float32)


#: The tables of weights and the column of word rows that each count below belongs to.
COUNTED = (("table", TABLE), ("table", TABLE), ("begin", BEGINNINGS))


def started(seen: list[np.ndarray], n: np.ndarray, seed: int = 7) -> Network:
    """The network before its first epoch, from the counts of all learners."""
    net, rng = Network(seed), np.random.default_rng(seed)
    for (name, size), counts in zip(COUNTED, seen):
        getattr(net, name)[:size, 0] += np.clip(ratios(counts, n) / 10, -1, 1) / 3
    for name in ("table", "begin"):
        held = getattr(net, name)
        known = np.flatnonzero(held[:, 0])
        held[known, 1:] = rng.standard_normal((len(known), DIM - 1)).astype(np.float32) * 0.02
    if n.sum():
        net.base[0] = np.log(max(1, n[1]) / max(1, n[0]))
    return net


class Learner:
    """A network and the sums of its squared gradients: steps are those of Adagrad on the logistic loss."""

    def __init__(self, net: Network):
        self.net = net
        self.sums = {n: np.full_like(getattr(net, n), 1e-2) for n in net.names()}

    def save(self) -> bytes:
        held = io.BytesIO()
        moved = {n: np.flatnonzero(np.any(self.sums[n] != np.float32(1e-2), axis=1)) for n in ("table", "begin")}
        np.savez_compressed(held, net=np.frombuffer(self.net.save(), np.uint8), **{f"{n}_at": u for n, u in moved.items()},
                            **{n: self.sums[n][moved[n]] if n in moved else self.sums[n] for n in self.net.names()})
        return held.getvalue()

    @staticmethod
    def load(data: bytes) -> Learner:
        held = np.load(io.BytesIO(data))
        one = Learner(Network.load(held["net"].tobytes()))
        for n in one.net.names():
            if n in ("table", "begin"):
                one.sums[n][held[f"{n}_at"]] = held[n]
            else:
                one.sums[n] = held[n]
        return one

    def matrix(self, name: str) -> np.ndarray:
        """Weights and sums side by side, one row per row of the weights."""
        held = [x.reshape(-1, DIM) if name in ("table", "begin") else x.reshape(1, -1)
                for x in (getattr(self.net, name), self.sums[name])]
        return np.concatenate(held, 1)

    def move(self, name: str, at: np.ndarray, delta: np.ndarray) -> None:
        """Add ``delta`` to rows of :meth:`matrix`."""
        half = delta.shape[1] // 2
        for held, part in ((getattr(self.net, name), delta[:, :half]), (self.sums[name], delta[:, half:])):
            if name in ("table", "begin"):
                held[at] += part.astype(np.float32)
            else:
                held += part.astype(np.float32).reshape(held.shape)

    def _step(self, name: str, grad: np.ndarray, at=slice(None)) -> None:
        self.sums[name][at] += grad * grad
        getattr(self.net, name)[at] -= RATE * grad / np.sqrt(self.sums[name][at])

    def learn(self, rows: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> None:
        """One step over a batch of documents."""
        net = self.net
        padded, begins = padded_rows(rows, sizes)
        best, at = net.peaks(padded, begins, sizes)
        active = np.maximum(best, 0)
        p = 1 / (1 + np.exp(-(active @ net.out + net.base[0])))
        error = ((p - toxic) / len(sizes)).astype(np.float32)
        inner = error[:, None] * net.out * (best > 0)
        conv, places, pulls, column = np.zeros_like(net.conv), [], [], 0
        for k, w in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            for j in range(w):
                cols = slice(column, column + FILTERS)
                where = at[:, mine] + j
                conv[:, cols] = np.einsum("bfd,bf->df", net.embed(padded[where.ravel()]).reshape(*where.shape, DIM),
                                          inner[:, mine])
                places.append(where.ravel())
                pulls.append((inner[:, mine, None] * net.conv[:, cols].T).reshape(-1, DIM))
                column += FILTERS
        touched, pulls = padded[np.concatenate(places)], np.concatenate(pulls)
        self._step("out", error @ active)
        self._step("base", error.sum(keepdims=True))
        self._step("bias", inner.sum(0))
        self._step("conv", conv)
        for name, size, columns in (("table", TABLE, (0, 1)), ("begin", BEGINNINGS, (2,))):
            for c in columns:
                ids, back = np.unique(touched[:, c], return_inverse=True)
                grad = np.zeros((len(ids), DIM), np.float32)
                np.add.at(grad, back, pulls)
                real = ids < size
                self._step(name, grad[real], ids[real])


def threshold(bins: np.ndarray, n: np.ndarray) -> float:
    """The cut with the largest F1; the middle of the widest stretch of equally good cuts.

    ``bins`` ascend; ``n`` counts the other and the toxic documents of each."""
    y, called = n[:, 1], n.sum(1)
    hits = y.sum() - np.concatenate([[0], np.cumsum(y)])
    called = called.sum() - np.concatenate([[0], np.cumsum(called)])
    f1 = 2 * hits / np.maximum(1, called + y.sum())
    lows = np.concatenate([bins, [bins[-1] + 1 + BINS]])
    highs = np.concatenate([[bins[0] - BINS], bins + 1])
    gaps = np.where(f1 == f1.max(), lows - highs, -1)
    i = int(gaps.argmax())
    return float((lows[i] + highs[i]) / 2 / BINS)


PIECES = "name string, block int, learner int, at binary, part binary, kind string"
#: Weights and counts of many rows; the others are one row.
LONG = ("table", "begin", "0", "1", "2")


def _pieces(name: str, learner: int, at: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Rows ``at`` of a matrix, cut into blocks that are merged apart from each other."""
    cuts = np.flatnonzero(np.diff(at // ROWS)) + 1
    ats, parts = np.split(at, cuts), np.split(part, cuts)
    return pa.RecordBatch.from_arrays([
        pa.array([name] * len(ats)), pa.array([int(x[0]) // ROWS for x in ats], pa.int32()),
        pa.array([learner] * len(ats), pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in ats], pa.binary()),
        pa.array([x.tobytes() for x in parts], pa.binary()), pa.array([part.dtype.str] * len(ats))],
        ["name", "block", "learner", "at", "part", "kind"])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(learner, rows, sizes, toxic) of BATCH documents at a time, of fewer at a learner's end."""
    held, of = [], None
    for batch in batches:
        marks = iter(zip(batch.column("learner").to_pylist(), batch.column("toxic").to_pylist()))
        for rows, sizes in documents(batch.column("text")):
            for one in np.split(rows, np.cumsum(sizes)[:-1]):
                learner, toxic = next(marks)
                if held and (learner != of or len(held) == BATCH):
                    yield _batch(of, held)
                    held = []
                of = learner
                held.append((one, toxic))
    if held:
        yield _batch(of, held)


def _batch(learner: int, held: list[tuple[np.ndarray, int]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    rows, toxic = zip(*held)
    return learner, np.concatenate(rows), np.array([len(r) for r in rows]), np.array(toxic)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each class have each row of each table."""
    seen, n = [np.zeros((size, 2)) for _, size in COUNTED], np.zeros((1, 2))
    for _, rows, sizes, toxic in _batches(batches):
        for one, t in zip(np.split(rows, np.cumsum(sizes)[:-1]), toxic):
            n[0, t] += 1
            for c in range(len(COUNTED)):
                seen[c][np.unique(one[:, c]), t] += 1
    if n.any():
        for name, counts in (*((str(c), x) for c, x in enumerate(seen)), ("n", n)):
            at = np.flatnonzero(counts.any(1))
            if len(at):
                yield _pieces(name, 0, at, counts[at])


def _learn(sent):
    """One epoch of a learner over its documents: what it moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for learner, lessons in groupby(_batches(batches), lambda x: x[0]):
            one, before = Learner.load(sent.value), Learner.load(sent.value)
            for _, rows, sizes, toxic in lessons:
                one.learn(rows, sizes, toxic)
            for name in one.net.names():
                delta = one.matrix(name) - before.matrix(name)
                at = np.flatnonzero(delta.any(1))
                if len(at):
                    yield _pieces(name, learner, at, delta[at])

    return run


def _merge(mean: bool):
    """Sums, or means over the learners that moved a row, of the pieces of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, times = None, None, None

        def done():
            at = np.flatnonzero(times)
            part = total[at] / times[at, None] if mean else total[at]
            return _pieces(key[0], 0, at + key[1] * ROWS, part)

        for batch in batches:
            for r in batch.to_pylist():
                at = np.frombuffer(r["at"], np.int32) - r["block"] * ROWS
                part = np.frombuffer(r["part"], r["kind"]).reshape(len(at), -1)
                if key != (r["name"], r["block"]):
                    if key:
                        yield done()
                    key = r["name"], r["block"]
                    total = np.zeros((ROWS if key[0] in LONG else 1, part.shape[1]))
                    times = np.zeros(len(total))
                total[at] += part
                times[at] += 1
        if key:
            yield done()

    return run


def _merged(pieces: DataFrame, mean: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(name, rows, values): at most one piece per block of the weights, so bounded, whatever the tables' size."""
    rows = pieces.repartition("name", "block").sortWithinPartitions("name", "block", "learner", "part").mapInArrow(
        _merge(mean), PIECES).collect()
    for r in sorted(rows, key=lambda r: (r.name, r.block)):
        at = np.frombuffer(r.at, np.int32)
        yield r.name, at, np.frombuffer(r.part, r.kind).reshape(len(at), -1)


def _counted_logits(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(sent.value)
        for batch in batches:
            logits = [net.logits(rows, sizes) for rows, sizes in documents(batch.column("text"))]
            logits = np.concatenate(logits).astype(float) if logits else np.zeros(0)
            bins = np.floor(np.clip(logits, -LOGITS, LOGITS) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("toxic"), pa.array(bins)], ["lang", "toxic", "bin"])

    return run


def _thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cut of each language with enough labels, and of all documents, from their sorted bins."""
    key, bins, n = None, [], []

    def done():
        counts = np.array(n)
        least = 1 if key[0] else OWN_THRESHOLD
        if counts.sum(0).min() >= least:
            yield pa.RecordBatch.from_arrays([
                pa.array([key[0]]), pa.array([key[1]], pa.string()),
                pa.array([threshold(np.array(bins), counts)])], ["whole", "lang", "cut"])

    for batch in batches:
        for r in batch.to_pylist():
            if key != (r["whole"], r["lang"]):
                if key:
                    yield from done()
                key, bins, n = (r["whole"], r["lang"]), [], []
            bins.append(r["bin"])
            n.append((r["others"], r["toxic"]))
    if key:
        yield from done()


def held_out(doc_id: str) -> str:
    """SQL text: whether a row is kept from learning; false without doc_id."""
    return f"coalesce(crc32(cast(cast({doc_id} as string) as binary)) % {FOLDS} = 0, false)"


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, lang, toxic, fits, learner): every labelled document that is not held out, whole.

    One row per doc_id, the smallest where texts differ; labels that disagree count as toxic. Rows lie
    by learner, in the order of a hash.
    """
    marked = stage(labels.filter(f"toxic in (0, 1) and doc_id is not null and not {held_out('doc_id')}").groupBy(
        "doc_id").agg(F.expr("cast(max(toxic) as int) as toxic")))
    side = F.broadcast(marked) if marked.count() <= BROADCAST_LABELS else marked
    fits = f"pmod(xxhash64(doc_id, 'calibrate'), {CALIBRATE}) <> 0"
    found = docs.select("doc_id").join(side, "doc_id").groupBy("doc_id").count().agg(
        F.expr(f"count_if({fits}) as fitted"), F.expr("coalesce(max(count), 0) as times")).first()
    rows = docs.select("doc_id", "text", "lang").join(side, "doc_id")
    if found.times > 1:
        rows = rows.groupBy("doc_id", "toxic").agg(F.expr("min(struct(text, lang)) as d")).selectExpr(
            "doc_id", "d.text", "d.lang", "toxic")
    learners = max(1, round(found.fitted / LEARNER))
    return rows.selectExpr(
        "doc_id", "text", "lang", "toxic", f"{fits} as fits",
        f"cast(pmod(xxhash64(doc_id, 'learner'), {learners}) as int) as learner",
    ).repartitionById(learners, F.col("learner")).sortWithinPartitions("learner", F.expr("xxhash64(doc_id)"), "doc_id")


def train(docs: DataFrame, labels: DataFrame) -> tuple[bytes, dict[str, float]]:
    """A saved network and the score thresholds of languages, learned from all of :func:`labelled`.

    What meets in the driver are the weights, whose number is fixed, and one threshold per language.
    """
    sc = docs.sparkSession.sparkContext
    known = stage(labelled(docs, labels))
    fitted = known.filter("fits").select("text", "toxic", "learner")
    seen, n = [np.zeros((2, size)) for _, size in COUNTED], np.zeros(2)
    for name, at, part in _merged(fitted.mapInArrow(_count, PIECES), mean=False):
        if name == "n":
            n += part[0]
        else:
            seen[int(name)][:, at] = part.T
    one = Learner(started(seen, n))
    for _ in range(EPOCHS if n.sum() else 0):
        sent = sc.broadcast(one.save())
        for name, at, part in _merged(fitted.mapInArrow(_learn(sent), PIECES), mean=True):
            one.move(name, at, part)
        sent.destroy()
        release(docs.sparkSession)
    sent = sc.broadcast(one.net.save())
    counts = known.filter("not fits").select("text", "lang", "toxic").mapInArrow(
        _counted_logits(sent), "lang string, toxic int, bin int").groupBy("lang", "bin").agg(
        F.expr("count_if(toxic = 0) as others"), F.expr("count_if(toxic = 1) as toxic"))
    both = counts.selectExpr("false as whole", "*").filter("lang is not null").unionByName(
        counts.groupBy("bin").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).selectExpr(
            "true as whole", "cast(null as string) as lang", "*"))
    cuts = both.repartition("whole", "lang").sortWithinPartitions("whole", "lang", "bin").mapInArrow(
        _thresholds, "whole boolean, lang string, cut double").collect()
    whole = next((r.cut for r in cuts if r.whole), None)
    drop_stage(known)
    if whole is None:
        return one.net.save(), {}
    one.net.base[0] -= whole
    return one.net.save(), {r.lang: float(1 / (1 + np.exp(whole - r.cut))) for r in sorted(
        (r for r in cuts if not r.whole), key=lambda r: r.lang)}


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(sent.value)
        for batch in batches:
            logits = [net.logits(rows, sizes) for rows, sizes in documents(batch.column("_text"))]
            logits = np.concatenate(logits).astype(float) if logits else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(score)],
                [*batch.schema.names[:-1], "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without text, with held_out, score (0 to 1), predicted (score of at least 0.5),
    threshold and flagged (score of at least the threshold of its language, else 0.5).

    Null and empty texts get the score of a text without words. Repeated rows get equal scores.
    Columns of the added names are replaced. Without labelled documents all
    scores are equal and below 0.5. No documents: no rows.
    """
    net, cuts = train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rest = fresh(docs, "text", "score", "held_out", "predicted", "threshold", "flagged")
    passed = [f"`{c}`" for c in rest.columns]
    rows = docs.selectExpr(*passed, "coalesce(text, '') as _text")
    schema = rest.withColumn("score", F.lit(0.0)).schema
    own = " ".join("when lang = '{}' then {!r}D".format(k.replace("\\", "\\\\").replace("'", "\\'"), float(v))
                   for k, v in cuts.items())
    return rows.mapInArrow(_scorer(sent), schema).selectExpr(
        *passed, f"{held_out('doc_id')} as held_out", "score", "if(score >= 0.5, 1, 0) as predicted",
        f"{f'case {own} else 0.5D end' if own else '0.5D'} as threshold",
    ).selectExpr("*", "score >= threshold as flagged")
