"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime well above a hundred times the shards of the query. It bounds what is broadcast.
TABLE_SIZE = 65_537
SHARDS = 64


def _number(text: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{text}".encode()).digest()[:8], "big")


def fill(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard (its place in ``shards``) of every slot.

    Each shard prefers the slots in the order ``start + i * step`` modulo the prime ``size``, which
    visits all of them. The shards take turns; in a turn a shard claims its first preferred slot that
    is still free. Shares differ by at most one slot, and leaving a shard out moves few other slots.
    The loop is over the slots of the table, never over rows.
    """
    if not shards or len(set(shards)) != len(shards) or size < max(2, len(shards)) or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("distinct shards and a prime table size of at least their number are needed")
    place = [_number(s, "start") % size for s in shards]
    step = [_number(s, "step") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % size
            table[place[k]] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 15 hexadecimal digits of its md5, modulo ``size``. Null counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % size


def place(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the slot of every row and the shard that owns it.

    The table (``size`` rows, two columns) is broadcast; no row of ``df`` moves, so a hot key costs
    nothing. Equal keys go to the same shard; a null key counts as empty text. ``slot`` and
    ``shard`` name the new columns and must not be in ``df`` yet.
    """
    if {slot.lower(), shard.lower()} & {c.lower() for c in df.columns}:
        raise ValueError(f"{slot} or {shard} is already a column")
    spark = df.sparkSession
    owned = [(i, shards[k]) for i, k in enumerate(fill(shards, size))]
    lookup = spark.createDataFrame(owned, f"`{slot}` bigint, `{shard}` string")
    return df.withColumn(slot, slot_of(df[key], size)).join(F.broadcast(lookup), slot).select(*[df[c] for c in df.columns], slot, shard)


def query_shards() -> list[str]:
    return [f"shard-{k:03d}" for k in range(SHARDS)]
