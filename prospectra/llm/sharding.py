"""Placement of rows on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the production table: prime, and about a thousand for each of 64 shards.
SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot.

    Every shard prefers the slots in an order of its own, offset + k * skip modulo the number of slots, both
    drawn from its name. The shards take turns in the order of their names; a turn claims the first free slot
    of the shard's order. Shares differ by one slot at most, and a shard that comes or goes moves few slots
    besides its own. Repeated names are refused, and so is a number of slots that is not prime or too small.
    """
    if not _is_prime(slots) or not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("slots must be a prime number, not below the number of different shards")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    start, skip = {}, {}
    for i in order:
        digest = hashlib.blake2b(shards[i].encode(), digest_size=16).digest()
        start[i] = int.from_bytes(digest[:8], "big") % slots
        skip[i] = int.from_bytes(digest[8:], "big") % (slots - 1) + 1
    owner, free = [-1] * slots, slots
    while free:
        for i in order:
            while owner[start[i]] >= 0:
                start[i] = (start[i] + skip[i]) % slots
            owner[start[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key by its hash; null keys share a slot."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """`slot`, `shard`, `shard_name`: one row per slot."""
    rows = [(slot, i, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    return spark.createDataFrame(rows, "slot int, shard int, shard_name string")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """`key`, `row` (all columns of the input as one struct), `slot`, `shard`, `shard_name` for every row.

    The lookup table is broadcast: it has as many rows as slots, whatever the data. No row moves. Equal keys
    share a shard; to spread a hot key, place by a column that varies within it. A null key has its own fixed
    slot, repeated rows stay repeated, and column names of the input cannot clash, as they are kept in `row`.
    """
    table = F.broadcast(table_frame(rows.sparkSession, shards, slots))
    keyed = rows.select(F.col(key).alias("key"), F.struct("*").alias("row"))
    return keyed.withColumn("slot", slot_of(F.col("key"), slots)).join(table, "slot").select(
        "key", "row", "slot", "shard", "shard_name"
    )
