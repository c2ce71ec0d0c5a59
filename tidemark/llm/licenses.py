"""License scans: an exact set-similarity join of text blocks with license notices.

Every text is cut into overlapping blocks of words. A notice is found in a block when the share of
the notice's distinct words that the block owns reaches the notice's threshold. The join orders
words by their frequency in the whole corpus, rarest first, and compares only what can match:

* prefix filter: of a notice with n words of which t are needed, one of the n - t + 1 rarest must
  be in the block;
* length filter: a block with fewer than t words known to any notice cannot match;
* positional filter: when the first shared word stands at place i of the notice and j of the
  block, at most 1 + min(n - i - 1, m - j - 1) words can be shared.

The filters lose nothing, and what remains is verified, so the result is exact. Only DataFrame
operations are used. Texts are never shuffled: blocks are made, filtered and verified where the
text is read, and only matches are grouped.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ALNUM, keyed, lower_ascii, words_of


@dataclass(frozen=True)
class Notice:
    """``phrase``: all words are needed, and places where they stand consecutively are counted."""

    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", self.text.lower())

    @property
    def needed(self) -> int:
        distinct = len(set(self.words))
        return distinct if self.phrase else math.ceil(round(self.threshold * distinct, 9))


# The phrases whose places are counted, and opening words of public license notices.
NOTICES = (
    Notice("mit", "mit license", phrase=True),
    Notice("apache", "apache license", phrase=True),
    Notice("gpl", "general public license", phrase=True),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
           "this software and associated documentation files"),
    Notice("apache", "Licensed under the Apache License, Version 2.0; you may not use this file "
           "except in compliance with the License"),
    Notice("gpl", "This program is free software: you can redistribute it and/or modify it under "
           "the terms of the GNU General Public License"),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without "
           "modification, are permitted provided that the following conditions are met"),
    Notice("isc", "Permission to use, copy, modify, and/or distribute this software for any "
           "purpose with or without fee is hereby granted"),
    Notice("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, "
           "v. 2.0"),
    Notice("cc", "This work is licensed under a Creative Commons Attribution International "
           "License"),
)
#: Notices travel to every task; more words than this are refused rather than broadcast.
MAX_NOTICE_WORDS = 20_000


def _array(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def word_order(docs: DataFrame, notices=NOTICES) -> list[str]:
    """The notices' words by frequency in all documents, rarest first; ties by the word.

    The one action of the scan; its result has a row for each word of the notices.
    """
    known = sorted({w for n in notices for w in n.words})
    words = docs.selectExpr(f"explode({words_of('lower(text)', ALNUM)}) as word")
    wanted = docs.sparkSession.sql(f"select explode({_array(known)}) as word")
    counts = words.join(F.broadcast(wanted), "word").groupBy("word").agg(F.count("*").alias("n"))
    seen = {r.word: r.n for r in counts.collect()}
    return sorted(known, key=lambda w: (seen.get(w, 0), w))


def license_blocks(
    docs: DataFrame, notices=NOTICES, block: int = 64, stride: int = 32,
    order: list[str] | None = None,
) -> DataFrame:
    """Every (document, block, notice) that meets the notice's threshold.

    Columns: doc_id, _id, _th (key of the document), block, notice (its number), label, phrase,
    overlap, containment, places (starts of a phrase's consecutive words, counted once over all
    blocks; empty for notices). A phrase found as a set but nowhere consecutively has no places.
    Null and empty texts have no blocks. ``block - stride`` words at least are shared by
    neighbouring blocks, so a notice of up to that many consecutive words lies whole in one.
    """
    longest = max((len(n.words) for n in notices), default=0)
    if not 0 < stride <= block - longest:
        raise ValueError(f"stride must leave {longest} words of overlap between blocks")
    if sum(len(n.words) for n in notices) > MAX_NOTICE_WORDS:
        raise ValueError("too many notices to send to every task")
    order = order or word_order(docs, notices)
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, notice in enumerate(notices):
        words = sorted(set(notice.words), key=rank.__getitem__)
        for place, word in enumerate(words[: len(words) - notice.needed + 1]):
            index.append(
                f"named_struct('word', '{word}', 'notice', {number}, 'label', '{notice.label}', "
                f"'phrase', {str(notice.phrase).lower()}, 'place', {place}, "
                f"'size', {len(words)}, 'needed', {notice.needed}, 'words', {_array(words)}, "
                f"'sequence', {_array(notice.words)})"
            )
    spark = docs.sparkSession
    prefix = spark.sql(f"select inline(array({', '.join(index)}))").withColumnRenamed("word", "hit")
    rare = _array(sorted({w for n in notices for w in sorted(set(n.words), key=rank.__getitem__)
                          [: len(set(n.words)) - n.needed + 1]}))
    # lower() may only add matches; the words compared below are lower-cased for A-Z alone.
    candidates = keyed(docs).filter(f"arrays_overlap({words_of('lower(text)', ALNUM)}, {rare})")
    blocks = (
        candidates.selectExpr("doc_id", "_id", "_th",
                              f"{words_of(lower_ascii('text'), ALNUM)} as words")
        .selectExpr("*", f"explode(sequence(0, greatest(0, (size(words) - 1) div {stride}))) "
                         "as block")
        .selectExpr("doc_id", "_id", "_th", "block",
                    f"slice(words, cast(block * {stride} + 1 as int), {block}) as part")
        .filter(f"arrays_overlap(part, {rare})")
        # Kept in frequency order: the intersection follows its first argument.
        .selectExpr("*", f"array_intersect({_array(order)}, part) as known")
    )
    found = (
        blocks.selectExpr("*", "posexplode(known) as (at, hit)")
        .join(F.broadcast(prefix), "hit")
        .filter("size(known) >= needed and "
                "1 + least(size - place - 1, size(known) - at - 1) >= needed")
        .selectExpr("*", "size(array_intersect(words, known)) as overlap")
        .filter("overlap >= needed")
        # The first shared word alone reports the pair.
        .filter("hit = array_intersect(words, known)[0]")
    )
    return found.selectExpr(
        "doc_id", "_id", "_th", "block", "notice", "label", "phrase", "overlap",
        "overlap / size as containment",
        f"if(phrase, transform(filter(sequence(0, {stride - 1}), "
        "p -> slice(part, p + 1, size(sequence)) = sequence), "
        f"p -> cast(block * {stride} + p as bigint)), cast(array() as array<bigint>)) as places",
    )


def license_scan(docs: DataFrame, notices=NOTICES, block: int = 64, stride: int = 32) -> DataFrame:
    """Per document row: words, places of the phrases, labels and the best containment.

    A phrase counts as found where its words stand consecutively; a notice where its threshold is
    met. ``labels`` joins both, ``base_labels`` the phrases' only. ``score`` is the largest share
    of a notice's words found in a block, 1 for a phrase, 0 without a find. Null text: no words.
    Repeated rows each get their result; a null doc_id is kept. No rows in, no rows out.
    """
    found = license_blocks(docs, notices, block, stride).filter("not phrase or size(places) > 0")
    # Rows of one key find the same; each of its places counts once.
    found = found.drop("doc_id").distinct()
    per_doc = found.groupBy("_id", "_th").agg(
        F.expr("sum(size(places)) as n_base"),
        F.expr("min(array_min(places)) as first_word"),
        F.expr("max(array_max(places)) as last_word"),
        F.expr("array_join(sort_array(collect_set(if(phrase, label, null))), ',') as base_labels"),
        F.expr("array_join(sort_array(collect_set(label)), ',') as labels"),
        F.expr("max(containment) as score"),
    )
    counted = keyed(docs).selectExpr(
        "doc_id", "_id", "_th", f"cast(size({words_of('text', _EITHER)}) as bigint) as n_words"
    )
    return counted.join(per_doc, ["_id", "_th"], "left").selectExpr(
        "doc_id", "n_words", "coalesce(n_base, 0) as n_base", "first_word", "last_word",
        "coalesce(base_labels, '') as base_labels", "coalesce(labels, '') as labels",
        "coalesce(score, 0d) as score",
    )


#: The same words as ALNUM finds after lower-casing, found without lower-casing.
_EITHER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
