"""Sharding by a permutation-filled lookup table (native DataFrame functions only).

Every shard orders the slots of a prime-sized table by a permutation of its own
(offset and stride from a hash of the shard's name). The shards take turns, and
each turn claims the shard's next slot that is still free, so slots are shared
out evenly and most of them keep their shard when the set of shards changes.
The table depends on the parameters alone (``TABLE_SIZE`` small integers); it
is broadcast, and a row is placed by one hash and one look-up.

Edge cases: a null key is replaced by the hash of the whole row's text, so that
rows without a key spread out too; equal keys share a shard; an empty table
gives an empty result; columns called like the new ones are replaced. The length of a
text makes no difference, only its key is hashed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.llm.common import fresh

TABLE_SIZE = 65_537     # prime; the broadcast is this many pairs of integers
SHARDS = 64


def _number(name: str, salt: str, below: int) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big") % below


def fill_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard. ``size`` must be a prime over ``len(names)``."""
    if not 0 < len(names) < size or any(size % p == 0 for p in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime larger than the number of shards")
    at = [_number(n, "offset", size) for n in names]
    stride = [_number(n, "stride", size - 1) + 1 for n in names]
    slots, free = [-1] * size, size
    while True:
        for shard in range(len(names)):
            while slots[at[shard]] >= 0:
                at[shard] = (at[shard] + stride[shard]) % size
            slots[at[shard]] = shard
            free -= 1
            if not free:
                return slots


def shard_names(shards: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(shards)]


def lookup_table(spark: SparkSession, slots: list[int], slot: str, shard: str) -> DataFrame:
    """The table as rows (slot, shard), made by Spark from one literal."""
    text = ",".join(map(str, slots))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias(slot, "s")).select(
        slot, F.col("s").cast("int").alias(shard))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of its md5, modulo the table size."""
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")
            % F.lit(size)).cast("int")


def assign_shards(df: DataFrame, key: str = "doc_id", fallback: str = "text", out: str = "shard",
                  names: list[str] | None = None, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with its shard's index in ``out``; no shuffle of ``df``."""
    slots = fill_table(names or shard_names(), size)
    df = df.drop(out)
    slot = fresh(df, "slot")
    known = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(fallback), F.lit("")).cast("binary")))
    placed = df.withColumn(slot, slot_of(known, size))
    return placed.join(F.broadcast(lookup_table(df.sparkSession, slots, slot, out)), slot).select(*df.columns, out)
