"""Sharding by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table whose size is prime. The shards
take turns; whose turn it is claims the first free slot of its permutation, until all
slots are taken. So shards get equal shares (to one slot), and when a shard comes or
goes few slots change hands. A row's slot is a hash of its key, and its shard is what
the broadcast table says: a join without a shuffle, whatever the keys look like.

The table is configuration: it has ``table_size`` rows, whatever the data.

Defined cases: a null key is placed as an empty one; equal keys share a shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.llm.tables import disclose, enclose, inner

TABLE_SIZE = 4099
LARGEST_TABLE = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], table_size: int = TABLE_SIZE) -> list[int]:
    """The number of the shard that each slot belongs to."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not _is_prime(table_size) or not 2 < table_size <= LARGEST_TABLE:
        raise ValueError(f"the table size must be a prime from 3 to {LARGEST_TABLE}")
    place = [_number(f"{s}/offset") % table_size for s in shards]
    skip = [_number(f"{s}/skip") % (table_size - 1) + 1 for s in shards]
    slots = [-1] * table_size
    for turn in range(table_size):
        shard = turn % len(shards)
        while slots[place[shard]] >= 0:
            place[shard] = (place[shard] + skip[shard]) % table_size
        slots[place[shard]] = shard
    return slots


def lookup_table(spark: SparkSession, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """The filled table as rows (slot, shard)."""
    listed = ",".join(map(str, fill(shards, table_size)))
    numbers = F.split(F.lit(listed), ",")
    names = F.array(*(F.lit(s) for s in shards))
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "n")).select(
        F.col("slot").cast("long").alias("slot"),
        F.element_at(names, F.col("n").cast("int") + 1).alias("shard"),
    )


def slot_of(key: Column, table_size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(table_size).cast("long"))


def place(df: DataFrame, key: str, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with slot and shard, by its column ``key``."""
    rows, names = enclose(df)
    rows = rows.withColumn("slot", slot_of(F.col(inner(names, key)), table_size))
    table = lookup_table(df.sparkSession, shards, table_size)
    return disclose(rows.join(F.broadcast(table), "slot"), names, "slot", "shard")
