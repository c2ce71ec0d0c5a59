"""Each operator on the awkward table against plain Python, and on an empty table."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from conftest_llm import alnum, awkward_rows, sha, spaced
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, licenses, mixing, quality, repeats, sharding, tokens

ROWS = [(r[0], r[1]) for r in awkward_rows()]


def multiset(rows) -> Counter:
    return Counter(map(tuple, rows))


def test_license_scan(awkward, empty):
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"],
               "gpl": ["general", "public", "license"]}
    expected = Counter()
    for doc, text in ROWS:
        words = alnum(text)
        found = [(i, label) for label, p in phrases.items() for i in range(len(words))
                 if words[i:i + len(p)] == p]
        labels, score = {label for _, label in found}, 1.0 if found else 0.0
        for n in licenses.NOTICES:
            if n.phrase:
                continue
            for at in range(0, max(1, len(words)), 32):
                share = len(set(words[at:at + 64]) & set(n.words))
                if share >= n.needed:
                    labels.add(n.label)
                    score = max(score, share / len(set(n.words)))
        starts = [i for i, _ in found]
        expected[(doc, len(words), len(found), min(starts, default=None),
                  max(starts, default=None), ",".join(sorted({label for _, label in found})),
                  ",".join(sorted(labels)), score)] += 1
    got = licenses.license_scan(awkward)
    assert multiset(got.collect()) == expected
    assert any("mit" in k[6] and not k[5] for k in expected), "a notice alone is found too"
    assert licenses.license_scan(empty).count() == 0


def test_near_matches_meet_the_threshold_exactly(spark):
    notice = licenses.Notice("x", " ".join(f"w{i}" for i in range(10)), 0.8)
    docs = spark.createDataFrame(
        [(k, " ".join([f"w{i}" for i in range(k)] + ["other"] * 5)) for k in range(11)],
        "doc_id bigint, text string")
    found = licenses.license_blocks(docs, (notice,)).collect()
    assert sorted((r.doc_id, r.overlap) for r in found) == [(8, 8), (9, 9), (10, 10)]


def test_sharding_keeps_rows_and_is_stable(awkward, empty):
    placed = sharding.shard_documents(awkward)
    assert placed.count() == len(ROWS)
    same = placed.groupBy("doc_id").agg(F.countDistinct("shard").alias("n"))
    assert same.filter("doc_id is not null and n > 1").isEmpty()
    assert placed.filter("shard is null or slot is null").isEmpty()
    assert sharding.shard_documents(empty).count() == 0


def test_slot_table_is_even_and_barely_moves():
    names = [f"n{i}" for i in range(10)]
    table = sharding.slot_table(names, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    # Turn by turn, by hand.
    at = [sharding._number(f"offset:{s}") % 1009 for s in names]
    skip = [sharding._number(f"skip:{s}") % 1008 + 1 for s in names]
    orders = [[(a + k * s) % 1009 for k in range(1009)] for a, s in zip(at, skip)]
    owner, turn = {}, 0
    while len(owner) < 1009:
        shard = turn % 10
        owner[next(x for x in orders[shard] if x not in owner)] = shard
        turn += 1
    assert table == [owner[i] for i in range(1009)]
    fewer = sharding.slot_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.2 * 1009


def test_token_counts(awkward, empty):
    scores = {"▁": -2.0, "▁a": -1.5, "a": -1.0, "b": -1.2, "ab": -1.7, "abab": -3.0, "on": -0.5,
              "▁one": -4.0, "e": -1.0, "al": -1.0, "pha": -1.0, "alpha": -2.5, "wo": -1.0}

    def best(word):
        state = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(state[s][0] + scores[word[s:end]], -s, state[s][1] + 1)
                       for s in range(max(0, end - tokens.LONGEST), end)
                       if word[s:end] in scores]
            if word[end - 1] not in scores:
                size = len(word[end - 1].encode())
                options.append((state[end - 1][0] + size * tokens.BYTE_SCORE, -end,
                                state[end - 1][1] + size))
            top = max(options)
            state.append((top[0], top[2]))
        return state[-1][1]

    import re
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in ROWS]
    expected = Counter((d, len(w), sum(best("▁" + x) for x in w)) for (d, _), w in zip(ROWS, words))
    got = tokens.token_counts(awkward, tokens.Unigram(scores), batch_chars=500)
    assert multiset(got.collect()) == expected
    assert tokens.token_counts(empty, tokens.Unigram(scores)).count() == 0


def test_token_counts_with_a_vocabulary_file(awkward):
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(awkward).collect()}
    assert got[1] == 0 and got[3] == got[4] > 0 and got[13] >= 12000


def brute_repeats(depth):
    data = [(d, (t or "").encode()) for d, t in ROWS]
    seen = Counter(b[i:i + depth] for _, b in data for i in range(len(b) - depth + 1))
    out = Counter()
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if seen[b[i:i + depth]] > 1:
                gone[i:i + depth] = b"\x01" * depth
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[(d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))] += 1
    return out


def test_repeated_spans(awkward, empty):
    for group in (repeats.GROUP, 1):
        got = repeats.repeated_spans(awkward, group=group).selectExpr(
            "doc_id", "n_bytes", "n_removed", "size(spans)", "kept_sha256")
        assert multiset(got.collect()) == brute_repeats(200)
    assert repeats.repeated_spans(empty).count() == 0


def jaccard_components():
    sets = []
    for _, text in ROWS:
        w = spaced(text)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4
                    else {tuple(w)} if w else set())
    parent = list(range(len(ROWS)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(ROWS)):
        groups[root(i)].append(i)
    out = {}
    for group in groups.values():
        ids = [ROWS[i][0] for i in group if ROWS[i][0] is not None]
        for i in group:
            out[i] = (ROWS[i][0], len(sets[i]), min(ids, default=None))
    return out, groups, sets


def test_frequency_order_reaches_the_driver_in_short_rows(spark, monkeypatch):
    """Logarithms are taken by Spark: the driver gets six bytes per counter, not two long numbers."""
    docs = spark.range(300).selectExpr("concat_ws(' ', transform(sequence(0, 40), i -> cast(i * id as string))) as text")
    sent, fetch = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: sent.append(fetch(df)) or sent[-1])
    order = jaccard.frequency_order(docs)
    assert [str(kind) for kind in sent[0].schema.types] == ["int32", "int16"]
    rows = docs.toPandas().text.to_list()
    counts = np.zeros(len(order), np.int64)
    for _, grams in jaccard.shingle_sets(pa.array(rows)):
        np.add.at(counts, grams >> np.uint64(64 - jaccard.SKETCH_BITS), 1)
    assert (order == (8 * np.log2(counts + 1)).astype(np.uint8)).all() and order.any()


def test_jaccard_components(awkward, empty):
    expected, groups, sets = jaccard_components()
    got = jaccard.linked_components(awkward).select("doc_id", "n_shingles", "component_id")
    assert multiset(got.collect()) == Counter(expected.values())
    assert jaccard.linked_components(empty).count() == 0


def test_one_document_of_each_group(awkward, empty):
    _, groups, sets = jaccard_components()
    kept = jaccard.one_of_each(awkward)
    assert kept.columns == awkward.columns
    blanks = sum(1 for s in sets if not s)
    assert kept.count() == sum(1 for g in groups.values() if sets[g[0]]) + blanks
    assert jaccard.one_of_each(empty).count() == 0


def test_chains_of_links_form_one_component(spark):
    words = [f"w{i}" for i in range(220)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(30)] + [(99, "far away " * 9)]
    found = jaccard.linked_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {
        **{i: 0 for i in range(30)}, 99: 99}


def test_decontamination(spark, awkward, empty):
    items = [(1, "COMMON0 " + " ".join(f"common{i}" for i in range(1, 14))), (2, "one"),
             (2, "mit license"), (3, None), (4, "!!"), (None, "again and again and again and"),
             (10, " ".join(f"common{i}" for i in range(30, 60)))]
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i:i + size])].add(item)
    expected = Counter()
    for doc, text in ROWS:
        w, hit, ids = alnum(text), set(), set()
        for win, owners in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    ids |= owners - {None}
        expected[(doc, len(w), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))),
                  bool(hit) and 20 * len(hit) >= len(w))] += 1
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (8 << 20, 40):
        got = decontaminate.verdicts(decontaminate.find_items(awkward, bench, item_bytes=size))
        assert multiset(got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                   "contaminated").collect()) == expected
    kept = decontaminate.decontaminate(awkward, bench)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(n for k, n in expected.items() if not k[5])
    assert decontaminate.find_items(empty, bench).count() == 0
    none = decontaminate.verdicts(decontaminate.find_items(awkward, bench.limit(0)))
    assert none.filter("n_hit > 0").isEmpty() and none.count() == len(ROWS)


def test_mixing(awkward, empty):
    rows = mixing.copies(awkward).collect()
    assert len(rows) == len(ROWS)
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len(spaced(r.text)) and 0 <= r.taken <= 3 * r["size"]
        assert r.taken == r["size"] * r.copies
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(x for x in size if x is not None) + [None]
    left = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, wanted = sum(size.values()), {}
    while left:
        share = total / sum(left.values())
        full = [s for s in left if 3 * size[s] <= left[s] * share]
        if not full:
            wanted.update((s, w * share) for s, w in left.items())
            break
        for s in full:
            wanted[s] = 3 * size[s]
            total -= 3 * size[s]
            del left[s]
    for s in order:
        assert abs(target[s] - wanted[s]) < 1e-6 * max(1, wanted[s])
    again = multiset((r.doc_id, r.text, r.taken) for r in mixing.copies(awkward).collect())
    assert again == multiset((r.doc_id, r.text, r.taken) for r in rows)
    mix = mixing.mixed(awkward)
    assert mix.columns == awkward.columns and mix.count() == sum(r.copies for r in rows)
    assert mixing.copies(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_newton_meets_the_targets(spark):
    rows = spark.createDataFrame([("a", 1000, 250.0), ("b", 1000, 1000.0), ("c", 1000, 2999.0),
                                  ("d", 1000, 3000.0), ("e", 0, 0.0), ("f", 10**9, 1.0)],
                                 "_key string, source_size bigint, target double")
    for r in mixing.balanced(rows).collect():
        assert abs(r.rate * r.source_size - r.target) <= 1e-6 * max(1.0, r.target), r


def quality_counts(text):
    text = text or ""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {p for i, g in enumerate(grams) if count[g] > 1 for p in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_quality(awkward, empty):
    got = quality.quality_report(awkward)
    expected = Counter()
    for doc, text in ROWS:
        n = quality_counts(text)
        expected[(doc, *n, n[0] < 10 or 100 * n[4] > 20 * n[0])] += 1
    assert multiset(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                               "n_repeat_words", "base_failed").collect()) == expected
    assert got.filter("base_failed and kept").isEmpty()
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns and kept.count() == got.filter("kept").count()
    assert quality.quality_report(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_fences_follow_the_group(spark):
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" for k in range(30)) + " " + "#" * symbols
    rows = [(i, text(i, i % 7), "en", "plain") for i in range(100)]
    rows += [(100 + i, text(i, 40 + i % 100), "en", "tables") for i in range(100)]
    rows += [(200, text(200, 120), "en", "plain"), (201, text(201, 120), "en", "tables")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    failed = {r.doc_id for r in quality.quality_report(docs).filter("failed = 'symbols'").collect()}
    assert 200 in failed and 201 not in failed


def test_sketch_buckets_are_narrow_and_mergeable(spark):
    values = spark.range(0, 5000).selectExpr("id * id * 3 as v")
    rows = values.selectExpr("v", f"{quality.bucket('v')} as b").selectExpr(
        "v", "b", f"{quality.bucket_floor('b')} as low").collect()
    assert all(r.low <= r.v <= r.low * 17 / 16 + 1 for r in rows)
    assert all((x.b < y.b) == (x.low < y.low) for x, y in zip(rows, rows[1:]))
