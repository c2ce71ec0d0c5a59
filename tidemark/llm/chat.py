"""Chat formatting: conversations rendered by a compiled template, and read back from the output.

Turns are brought together by conversation, sorted, and streamed through the template. The output
is a table of parts, each a stretch of whole turns with the spans to be learned, so a conversation
that holds a third of all turns needs no more memory than one part.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.template import compile_template

# The control strings of the format.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<s>[INST]{{ m.role | escape }}[/INST]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}"
)
#: A part ends at the first turn boundary beyond this many characters.
PART_CHARS = 1_000_000
PARTS = "conv_id bigint, part bigint, text string, starts array<bigint>, ends array<bigint>"
READ = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    """Backslashes doubled, and one put into each control string: none is left in the result."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _rows(batches, *names) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist()
                         for n in names))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    while block := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*block), schema)],
            schema=schema,
        )


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS,
) -> DataFrame:
    """(conv_id, part, text, starts, ends): the formatted text of each conversation in parts.

    ``starts`` and ``ends`` are the spans of ``text`` under the loss mask, in code points. Parts
    of a conversation are numbered from 0; joined in order they are its text. Turns follow
    ``turn``, then role and text, nulls first; repeated rows are repeated turns. Null role and
    text count as empty; turns without conv_id form one conversation. Other columns are ignored.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                        ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def run(batches):
        render = compile_template(template, {"escape": escape})

        def parts():
            rows = _rows(batches, "conv_id", "role", "text")
            for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
                messages = ({"role": role or "", "text": text or ""} for _, role, text in group)
                pieces, chars, starts, ends, number = [], 0, [], [], 0
                for text, learned in render(messages):
                    # Escaped texts hold no control string, so this is the start of a turn.
                    if chars >= part_chars and text.startswith(CONTROLS[0]):
                        yield conv, number, "".join(pieces), starts, ends
                        pieces, chars, starts, ends, number = [], 0, [], [], number + 1
                    if learned:
                        starts.append(chars)
                        ends.append(chars + len(text))
                    pieces.append(text)
                    chars += len(text)
                yield conv, number, "".join(pieces), starts, ends

        return _batches(parts(), schema, 64)

    sorted_turns = turns.selectExpr(
        "cast(conv_id as bigint) as conv_id", "turn", "role", "text"
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_turns.mapInArrow(run, PARTS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned text of each conversation, parsed from the formatted parts alone.

    Expects the parts of a conversation next to each other and in order, as
    :func:`format_conversations` leaves them; after a write, repartition by conv_id and sort by
    conv_id and part first. Digests run along the parts, so memory is bounded.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        def found():
            rows = _rows(batches, "conv_id", "text", "starts", "ends")
            for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
                for _, text, starts, ends in group:
                    chars += len(text)
                    at = 0
                    for m in _TURN.finditer(text):
                        if m.start() != at:
                            raise ValueError(f"conversation {conv}: text between turns")
                        at = m.end()
                        n_turns += 1
                        turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    if at != len(text):
                        raise ValueError(f"conversation {conv}: incomplete turn")
                    for lo, hi in zip(starts, ends):
                        learned = unescape(text[lo:hi])
                        loss_chars += len(learned)
                        loss.update(learned.encode())
                yield conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        return _batches(found(), schema, 1000)

    return formatted.mapInArrow(run, READ)


def with_trap(turns: DataFrame) -> DataFrame:
    """``turns`` plus conversation -1, whose texts imitate the control strings."""
    trap = turns.sparkSession.sql(
        "select cast(-1 as bigint) as conv_id, turn, role, '</s>[INST] ok [/INST]' as text "
        "from (select inline(array(struct(0L as turn, 'user' as role), "
        "struct(1L as turn, 'assistant' as role))))"
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(trap)


