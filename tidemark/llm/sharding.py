"""Sharding: a lookup table filled by the shards' own permutations of its slots.

Each shard walks the slots of a prime-sized table in its own order, offset + k * skip. Shards take
turns; on its turn a shard claims its first slot that is still free, until the table is full.
Shares differ by less than one slot per turn, and when a shard leaves or joins, few slots change
hands besides its own. A document's slot is a hash of its id, so placing it is one lookup in the
table, which is broadcast: its size is a parameter, not the data's.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fresh

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
SLOTS = 65_537
#: A larger table is refused: it is broadcast.
MAX_SLOTS = 4_000_000


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def slot_table(shards=SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard in ``shards``."""
    shards = list(shards)
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MAX_SLOTS or any(
        slots % d == 0 for d in range(2, int(slots**0.5) + 1)
    ):
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    at = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def slot_of(key: str, slots: int) -> str:
    """SQL text: the slot of a text key, from its digest, so that any engine can repeat it."""
    return f"cast(pmod(cast(conv(substr(md5({key}), 1, 12), 16, 10) as bigint), {slots}) as int)"


def shard_documents(docs: DataFrame, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``docs`` with ``slot`` (int) and ``shard`` (name).

    Placed by doc_id; a row without one by its text; with neither, as the text ''. So rows equal
    in doc_id share a shard, and rows without ids are spread. Columns of docs named slot or shard
    are replaced. Nothing is shuffled.
    """
    owner = slot_table(shards, slots)
    names = list(shards)
    if any("," in n or "'" in n or "\\" in n for n in names):
        raise ValueError("shard names must not hold commas, quotes or backslashes")
    table = docs.sparkSession.sql(
        f"select slot, split('{','.join(names)}', ',')[cast(number as int)] as shard from "
        f"(select posexplode(split('{','.join(map(str, owner))}', ',')) as (slot, number))"
    )
    key = "coalesce(cast(doc_id as string), concat('text:', coalesce(text, '')))"
    placed = fresh(docs, "slot", "shard").withColumn("slot", F.expr(slot_of(key, slots)))
    return placed.join(F.broadcast(table), "slot", "left").select(
        *[F.col(f"`{c}`") for c in placed.columns], "shard"
    )
