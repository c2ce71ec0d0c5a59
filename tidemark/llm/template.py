"""A small sandboxed template language, compiled to Python closures.

    text                           as it is
    {{ expression }}               its value
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for m in messages %} {% endfor %}      inside: loop.first, loop.last, loop.index
    {% generation %} {% endgeneration %}      marks text the model is to learn
    {# comment #}

Expressions: strings, whole numbers, true, false, none, names, ``m.role`` and ``m['role']``, the
operators + == != < > in not and or, parentheses, and ``value | filter``. A name is looked up in
what the caller passes, a field in a mapping; there are no calls, no attributes of Python objects,
no imports and no assignments, so a template cannot reach anything it was not given.

A template is parsed into a syntax tree, constant parts are folded, and each node becomes a
closure. Rendering yields (text, learned) pieces in order and reads the messages one ahead, so a
conversation of any length needs the memory of two turns.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator

Piece = tuple[str, bool]


class TemplateError(ValueError):
    pass


_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|(\w+)|(==|!=|[+<>().\[\]|]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt}
_KEYWORDS = {"and", "or", "not", "in", "true", "false", "none"}


class _Expression:
    """Recursive descent over one expression; nodes are tuples (kind, ...)."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:at + 20]!r} in {text!r}")
            kind = ("string", "number", "word", "sign")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str):
        kind, text = self.peek()
        if wanted and (kind == "string" or text not in wanted):
            raise TemplateError(f"expected {' or '.join(wanted)}, found {text or 'the end'!r}")
        self.at += 1
        return kind, text

    def has(self, *texts: str) -> bool:
        kind, text = self.peek()
        return kind in ("word", "sign") and text in texts

    def whole(self):
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.has("or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.has("and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self):
        if self.has("not"):
            self.take()
            return ("not", self.negated())
        return self.compared()

    def compared(self):
        node = self.summed()
        if self.has(*_COMPARE, "in"):
            sign = self.take()[1]
            node = ("compare", sign, node, self.summed())
        elif self.has("not"):
            self.take()
            self.take("in")
            node = ("not", ("compare", "in", node, self.summed()))
        return node

    def summed(self):
        node = self.filtered()
        while self.has("+"):
            self.take()
            node = ("add", node, self.filtered())
        return node

    def filtered(self):
        node = self.field()
        while self.has("|"):
            self.take()
            node = ("filter", self.take()[1], node)
        return node

    def field(self):
        node = self.atom()
        while self.has(".", "["):
            if self.take()[1] == ".":
                kind, name = self.take()
                if kind != "word":
                    raise TemplateError(f"expected a field name, found {name!r}")
                node = ("field", node, ("const", name))
            else:
                node = ("field", node, self.either())
                self.take("]")
        return node

    def atom(self):
        kind, text = self.take()
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1],
                                    flags=re.S))
        if kind == "number":
            return ("const", int(text))
        if text in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[text])
        if kind == "word" and text not in _KEYWORDS:
            return ("name", text)
        if text == "(":
            node = self.either()
            self.take(")")
            return node
        raise TemplateError(f"unexpected {text or 'end'!r}")


def parse(source: str):
    """The syntax tree of a template: ("block", nodes)."""
    parts, at = [], 0
    for m in _TAGS.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at:m.start()]))
        if m[1] is not None:
            parts.append(("show", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    parts.reverse()

    def block(*ends: str):
        nodes = []
        while parts:
            kind, body = parts.pop()
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "show":
                nodes.append(("show", _Expression(body).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return ("block", nodes), word, rest
                if word == "if":
                    nodes.append(branch(rest))
                elif word == "for":
                    m = re.fullmatch(r"(\w+)\s+in\s+(\w+)", rest.strip())
                    if not m:
                        raise TemplateError(f"cannot read: for {rest}")
                    nodes.append(("for", m[1], m[2], block("endfor")[0]))
                elif word == "generation":
                    nodes.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown or misplaced tag: {body!r}")
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return ("block", nodes), "", ""

    def branch(test: str):
        then, word, rest = block("elif", "else", "endif")
        if word == "elif":
            other = ("block", [branch(rest)])
        elif word == "else":
            other = block("endif")[0]
        else:
            other = ("block", [])
        return ("if", _Expression(test).whole(), then, other)

    return block()[0]


def fold(node, filters: dict[str, Callable[[str], str]]):
    """The same tree with everything known beforehand computed and neighbouring texts joined."""
    kind = node[0]
    if kind == "block":
        out = []
        for child in (fold(n, filters) for n in node[1]):
            for part in child[1] if child[0] == "block" else [child]:
                if part[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + part[1])
                elif part != ("text", ""):
                    out.append(part)
        return ("block", out)
    if kind == "show":
        inner = fold(node[1], filters)
        return ("text", _shown(inner[1])) if inner[0] == "const" else ("show", inner)
    if kind == "if":
        test = fold(node[1], filters)
        if test[0] == "const":
            return fold(node[2] if test[1] else node[3], filters)
        return ("if", test, fold(node[2], filters), fold(node[3], filters))
    if kind == "for":
        return ("for", node[1], node[2], fold(node[3], filters))
    if kind == "generation":
        return ("generation", fold(node[1], filters))
    if kind in ("text", "const", "name"):
        return node
    if kind == "filter" and node[1] not in filters:
        raise TemplateError(f"unknown filter: {node[1]}")
    folded = tuple(fold(x, filters) if isinstance(x, tuple) else x for x in node)
    children = [x for x in folded if isinstance(x, tuple)]
    if all(c[0] == "const" for c in children) and kind != "field":
        return ("const", _closure(folded, filters)({}))
    return folded


def _shown(value) -> str:
    return "" if value is None else str(value)


def _closure(node, filters) -> Callable[[dict], object]:
    """A function of the names in scope that computes an expression."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]

        def look(scope):
            if name not in scope:
                raise TemplateError(f"unknown name: {name}")
            return scope[name]

        return look
    if kind == "field":
        of, key = _closure(node[1], filters), _closure(node[2], filters)

        def get(scope):
            owner = of(scope)
            if not isinstance(owner, dict):
                raise TemplateError("fields exist on messages and loop only")
            return owner.get(key(scope))

        return get
    if kind == "filter":
        apply, inner = filters[node[1]], _closure(node[2], filters)
        return lambda scope: apply(_shown(inner(scope)))
    if kind == "not":
        inner = _closure(node[1], filters)
        return lambda scope: not inner(scope)
    if kind == "compare":
        left, right = _closure(node[2], filters), _closure(node[3], filters)
        if node[1] == "in":
            return lambda scope: _shown(left(scope)) in _shown(right(scope))
        test = _COMPARE[node[1]]
        return lambda scope: test(left(scope), right(scope))
    left, right = _closure(node[1], filters), _closure(node[2], filters)
    if kind == "add":
        def add(scope):
            a, b = left(scope), right(scope)
            return a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b)

        return add
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    return lambda scope: left(scope) or right(scope)


def _renderer(node, filters) -> Callable[[dict, bool], Iterator[Piece]]:
    """A function of (scope, learned) that yields a node's pieces."""
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda scope, learned: iter([(text, learned)])
    if kind == "show":
        value = _closure(node[1], filters)
        return lambda scope, learned: iter([(_shown(value(scope)), learned)])
    if kind == "block":
        parts = [_renderer(n, filters) for n in node[1]]

        def block(scope, learned):
            for part in parts:
                yield from part(scope, learned)

        return block
    if kind == "if":
        test = _closure(node[1], filters)
        then, other = _renderer(node[2], filters), _renderer(node[3], filters)
        return lambda scope, learned: (then if test(scope) else other)(scope, learned)
    if kind == "generation":
        inner = _renderer(node[1], filters)
        return lambda scope, learned: inner(scope, True)
    name, over, body = node[1], node[2], _renderer(node[3], filters)

    def loop(scope, learned):
        items = iter(scope.get(over, ()))
        item, index = next(items, None), 1
        while item is not None:
            following = next(items, None)
            state = {"first": index == 1, "last": following is None, "index": index}
            yield from body({**scope, name: item, "loop": state}, learned)
            item, index = following, index + 1

    return loop


def compile_template(
    source: str, filters: dict[str, Callable[[str], str]] | None = None,
) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (mappings, in order) to pieces of (text, learned)."""
    known = {"trim": str.strip, "upper": str.upper, "lower": str.lower, **(filters or {})}
    render = _renderer(fold(parse(source), known), known)
    return lambda messages, **names: render({**names, "messages": messages}, False)
