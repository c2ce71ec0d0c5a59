"""A small table with everything that is awkward, and plain-Python versions of the contracts."""

from __future__ import annotations

import hashlib
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

PASSAGE = " ".join(f"common{i}" for i in range(60))
LONG = " ".join(f"word{i * 7919 % 4001} é{i % 13}" for i in range(6000))
NOTICE = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
          "software and associated documentation files")


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, size, slot): the last two are clashing extras."""
    base = " ".join(f"alpha{i} beta{i}" for i in range(40))
    near = base.replace("alpha20", "gamma20")
    texts = [
        None, "", "   \t\n", "one", "one", "Ünïcode \U0001F600 wörter", base, base, near,
        base + " tail words here", PASSAGE, "x " + PASSAGE, PASSAGE + " y", LONG,
        "a line\na line\na line\nanother line with a few more words to make ten",
        "see the MIT License and the mit  license. Apache-License! general public\nlicense " + NOTICE,
        "general public licence mit licensed apache", NOTICE + " " + base,
        "ab" * 400, "ab" * 400, "=" * 900, "# * $ % " * 30, "again and again and again " * 12,
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "a", "B", "b")[i % 4], len(t or ""), 7, "s")
            for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, base, "en", "a", 1, 7, "s"),
                   (None, None, None, None, None, None, None)]


SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size int, "
          "slot string")


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
