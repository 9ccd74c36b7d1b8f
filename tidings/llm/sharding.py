"""Sharding: a lookup table filled by permutations places any key in constant time.

The table has a prime number of slots. Each shard has its own preference order of all slots, given by
an offset and a skip, and the shards take turns in claiming their first free slot until none is
left. Each shard so owns nearly the same number of slots, and when a shard goes, few other slots
change hands. A key's slot is its hash modulo the size; the owner of the slot is its shard.

The size of the table is a parameter and not a matter of the data, so it is always broadcast.

Placement looks at a row alone: no row is moved to decide, and a hot key needs no special care until
the shards are written. ``write_shards`` deals each shard over ``pieces`` tasks by a second hash of
the whole row, so that a key with a third of the rows is no single task.

Defined results: equal keys have equal shards; a row whose keys are all null is placed by slot 0's
owner; repeated rows each get a row; the columns ``slot`` and ``shard`` replace any of these names.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import free_name

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The place in ``shards`` of the owner of each slot."""
    if not _is_prime(size):
        raise ValueError("the number of slots must be prime, so that each skip visits all of them")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("between one and as many different shards as slots are needed")
    names = sorted(shards)
    place = {name: k for k, name in enumerate(shards)}
    turns = [
        [place[n], xxhash.xxh64_intdigest(n, 1) % size, xxhash.xxh64_intdigest(n, 2) % (size - 1) + 1]
        for n in names
    ]
    owner, free = [-1] * size, size
    while True:
        for turn in turns:
            shard, slot, skip = turn
            while owner[slot] >= 0:
                slot = (slot + skip) % size
            owner[slot] = shard
            turn[1] = slot
            free -= 1
            if not free:
                return owner


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """``(slot, shard)`` of every slot."""
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(s, shards[k]) for s, k in enumerate(owner)], "slot int, shard string")


def place(
    rows: DataFrame,
    keys: Sequence[str],
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``."""
    kept = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    at = free_name(rows, "_slot")
    known = F.coalesce(*[F.col(k).isNotNull() for k in keys])
    for k in keys:
        known = known | F.col(k).isNotNull()
    hashed = F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")
    slotted = rows.withColumn(at, F.when(known, hashed).otherwise(0))
    owners = table_frame(rows.sparkSession, shards, size).withColumnRenamed("slot", at)
    owners = owners.withColumnRenamed("shard", f"{at}_shard")
    placed = slotted.drop("shard").join(F.broadcast(owners), at)
    return placed.select(*kept, F.col(at).alias("slot"), F.col(f"{at}_shard").alias("shard"))


def write_shards(placed: DataFrame, path: str, pieces: int = 8) -> None:
    """Write each shard as a folder of at most ``pieces`` files, hot keys included."""
    piece = F.pmod(F.xxhash64(*placed.columns), F.lit(pieces))
    named = placed.withColumn(free_name(placed, "_piece"), piece)
    dealt = named.repartition("shard", named.columns[-1]).drop(named.columns[-1])
    dealt.write.partitionBy("shard").mode("error").parquet(path)
