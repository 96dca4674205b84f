"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table, (offset + i * skip)
mod size. Shards take turns; at its turn a shard claims the first slot of its permutation that
is still free. The filled table is a constant of the shard list: every shard owns size/n slots
give or take one, and adding or removing a shard moves few slots between the others. A row is
placed by hashing its key to a slot and looking the slot up.

The table has ``size`` rows of two integers whatever the data: that is the proven bound of what
is broadcast. No shuffle happens at all.

Null keys are placed like the empty key. Equal keys always go to the same shard. Extra columns
are kept; ``slot`` and ``shard`` replace columns of those names. An empty input gives no rows. A shard whose turn
meets a claimed slot goes on to the next of its own order. Texts are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:04d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str] | tuple[str, ...], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the owning shard."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size or not _is_prime(size):
        raise ValueError("distinct shards, at least one and no more than a prime table size, are needed")
    cursors, skips = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        cursors.append(int.from_bytes(digest[:8], "big") % size)
        skips.append(int.from_bytes(digest[8:16], "big") % (size - 1) + 1)
    table, free = [-1] * size, size
    while True:
        for i, skip in enumerate(skips):
            at = cursors[i]
            while table[at] >= 0:
                at = (at + skip) % size
            table[at] = i
            cursors[i] = (at + skip) % size
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """By 48 bits of an MD5, which any reader of the shards can compute."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(size)).cast("int")


def assign_shards(df: DataFrame, key: str, shards=SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    lookup = df.sparkSession.createDataFrame(
        [(slot, shards[owner]) for slot, owner in enumerate(fill_table(shards, size))], "slot int, shard string"
    )
    placed = df.drop("shard").withColumn("slot", slot_of(F.col(key), size))
    return placed.join(F.broadcast(lookup), "slot", "left")


def write_shards(df: DataFrame, key: str, path: str, shards=SHARDS, size: int = TABLE_SIZE) -> None:
    """Writes one folder per shard; rows of a shard are spread over the tasks that hold them.

    All columns are kept but ``shard`` and ``slot``, which are those of ``assign_shards``; keys that are null or repeated are placed as it says, and an empty table writes no folder.
    """
    assign_shards(df, key, shards, size).drop("slot").write.partitionBy("shard").parquet(path)
