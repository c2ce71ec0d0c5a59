"""Chat formatting, the template language and the WARC archive."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import sha

from tidemark.llm import chat, warc
from tidemark.llm.template import TemplateError, compile_template, fold, parse

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello <s> \\ [INST]\\[/INST] </s>"),
    (1, 2, "user", None), (2, 0, None, "no role"), (2, 0, None, "no role"),
    (2, 1, "assistant", ""), (None, 3, "assistant", "lost"), (3, None, "assistant", "é😀\n"),
    (3, 1, "<s>", "role in disguise"), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, part int"


def expected(turns):
    groups = defaultdict(list)
    for conv, turn, role, text in turns:
        groups[conv].append(((turn is not None, turn or 0), (role is not None, role or ""),
                             (text is not None, text or "")))
    out = {}
    for conv, rows in groups.items():
        rows = [(r[1], t[1]) for _, r, t in sorted(rows)]
        loss = "".join(t for r, t in rows if r == "assistant")
        out[conv] = (len(rows), sha("".join(f"{r}\n{t}\n" for r, t in rows)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("part_chars", [1, 10**6])
def test_conversations_round_trip(spark, part_chars):
    turns = spark.createDataFrame([(*t, "x", 5) for t in TURNS], SCHEMA).repartition(4)
    formatted = chat.format_conversations(turns, part_chars=part_chars)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == expected(TURNS)
    texts = defaultdict(str)
    for r in sorted(formatted.collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.part)):
        texts[r.conv_id] += r.text
    for conv, text in texts.items():
        turns_in = expected(TURNS)[conv][0]
        assert all(text.count(c) == turns_in for c in chat.CONTROLS)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_escaping_is_reversible_and_leaves_no_control():
    for text in ("", "\\", "\\\\", "<s>", "<\\s>", "[INST]</s>\\<s>", "<<s>s>", "[/INST\\]"):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)


def render(template, messages=(), **names):
    return "".join(t for t, _ in compile_template(template)(messages, **names))


def test_template_language():
    says = [{"role": "user", "text": " a "}, {"role": "bot", "text": "b"}]
    assert render("{% for m in messages %}{{ loop.index }}{{ m['role'] + ':' }}{{ m.text | trim }}"
                  "{% if not loop.last %};{% endif %}{% endfor %}", says) == "1user:a;2bot:b"
    assert render("{% if x == 'b' or false %}1{% elif x in 'cd' %}2{% else %}3{% endif %}{# no #}",
                  x="c") == "2"
    assert render("{{ 1 + 2 }}{{ 'a\\n' | upper }}{{ none }}") == "3A\n"
    pieces = list(compile_template("x{% generation %}{{ y }}{% endgeneration %}z")([], y="1"))
    assert pieces == [("x", False), ("1", True), ("z", False)]


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}e"), {})
    assert tree == ("block", [("text", "abcde")])


@pytest.mark.parametrize("template", [
    "{{ x.__class__ }}", "{{ ''.__class__ }}", "{% import os %}", "{{ f() }}", "{{ y }}",
    "{% if a %}", "{% endfor %}", "{{ x | evil }}", "{{ 'a }}", "{{ 1 2 }}",
])
def test_templates_reach_nothing_else(template):
    with pytest.raises(TemplateError):
        render(template, x="text", a=1)


PAGES = [(5, "http://a", "p" * 100), (3, "http://b\r\nX: y", "p" * 100), (9, None, "p" * 100),
         (4, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""),
         (None, "u", "p" * 100), (1, "u", "é" * 50), (2, "u", "é" * 50), (2, "u", "é" * 50),
         (10, "u", "q" * 5000 + "\r\n\r\nWARC/1.1\r\n"), (11, "u", "z" * 99), (12, "u", "z" * 99)]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES],
                                  "page_id bigint, url string, html string, digest string")
    path = warc.write_archive(pages.repartition(3), str(tmp_path / "a"))
    archive = warc.read_archive(spark, path)
    first = {}
    for page, _, html in PAGES:
        body = html or ""
        if len(body.encode()) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    want = Counter()
    for page, url, html in PAGES:
        body = html or ""
        full = body not in first or first[body] == page
        want[(page, len(body.encode()), sha(body), "response" if full else "revisit",
              None if full else first[body])] += 1
    assert Counter(map(tuple, warc.read_back(archive).drop("url").collect())) == want
    stored = spark.read.parquet(path + "/payloads")
    assert stored.count() == len({h or "" for _, _, h in PAGES})
    assert warc.read_back(warc.read_archive(spark, warc.write_archive(
        pages.limit(0), str(tmp_path / "b")))).count() == 0

    warc.export_warc(archive, str(tmp_path / "c"))
    text = "".join(f.read_bytes().decode() for f in (tmp_path / "c").glob("part-*"))
    at = seen = 0
    while at < len(text):
        end = text.index("\r\n\r\n", at) + 4
        size = int(re.search(r"Content-Length: (\d+)", text[at:end])[1])
        body = text[end:].encode()[:size].decode()
        assert text[at:].startswith("WARC/1.1\r\nWARC-Type: re") and text[end + len(body):][:4] == "\r\n\r\n"
        at, seen = end + len(body) + 4, seen + 1
    assert seen == len(PAGES)


def test_a_damaged_payload_stops_the_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    path = warc.write_archive(pages, str(tmp_path / "a"))
    spark.read.parquet(path + "/payloads").selectExpr("sha2('other', 256) as digest", "packed") \
        .write.parquet(path + "/damaged")
    with pytest.raises(Exception, match="missing"):
        spark.read.parquet(path + "/headers").join(
            spark.read.parquet(path + "/damaged"), "digest", "left").selectExpr(
            "coalesce(packed, raise_error('payload is missing'))").collect()
    swapped = spark.read.parquet(path + "/headers").crossJoin(
        spark.read.parquet(path + "/payloads").select("packed")).selectExpr(
        "header", "sha2('other', 256) as digest", "packed")
    with pytest.raises(Exception, match="does not match"):
        swapped.mapInArrow(warc._unpacked, "header string, digest string, payload string").collect()
