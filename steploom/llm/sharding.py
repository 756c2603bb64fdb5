"""Documents dealt to shards by a lookup table that the shards fill in turns, each by its own permutation."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spare_name


@dataclass(frozen=True)
class ShardConfig:
    """``shards``: names of the shards, in any order.  ``slots``: size of the table, a prime.

    The table has a row of 16 bytes per slot and is broadcast, so ``slots`` is at most ``MAX_SLOTS``.
    It should be about a hundred times the number of shards or more: fewer rows move when shards come and go.
    """

    shards: Sequence[str] = tuple(f"shard-{i:05d}" for i in range(64))
    slots: int = 65_537
    seed: int = 17


#: Largest table: 16 MB where it is broadcast.
MAX_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, config: ShardConfig) -> tuple[int, int]:
    """First slot and step of a shard's permutation of all slots: a step of 1 to ``slots - 1`` visits each, as their number is prime."""
    found = hashlib.blake2b(shard.encode(), digest_size=16, key=str(config.seed).encode()).digest()
    return int.from_bytes(found[:8]) % config.slots, int.from_bytes(found[8:]) % (config.slots - 1) + 1


def lookup_table(config: ShardConfig) -> list[int]:
    """The index of each slot's shard in the sorted names.

    In turns each shard takes the first slot of its permutation that is still free, so no shard has
    over one slot more than another, and a shard that leaves or joins moves few slots of the others.
    """
    names = sorted(config.shards)
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need different names, and at least one")
    if not _is_prime(config.slots) or not len(names) < config.slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime above the number of shards and at most {MAX_SLOTS}")
    at, steps = (list(x) for x in zip(*(preference(n, config) for n in names), strict=True))
    table, size = [-1] * config.slots, config.slots
    for taken in range(size):
        shard = taken % len(names)
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + steps[shard]) % size
        table[at[shard]] = shard
    return table


def slot_of(key: Column, config: ShardConfig) -> Column:
    """A row's slot, by its key written as text; rows without a key share one slot."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(config.slots))


def slot_table(spark: SparkSession, config: ShardConfig) -> DataFrame:
    """``slot, shard``: a row per slot."""
    names, table = sorted(config.shards), lookup_table(config)
    index = pa.DictionaryArray.from_arrays(pa.array(table, pa.int32()), pa.array(names, pa.string()))
    return spark.createDataFrame(pa.table({"slot": pa.array(range(config.slots), pa.int64()), "shard": index.cast(pa.string())}))


def shard_documents(docs: DataFrame, config: ShardConfig = ShardConfig(), key: str = "doc_id", name: str = "shard") -> DataFrame:  # noqa: B008
    """All rows and columns of ``docs`` with the name of each row's shard.

    The shard follows from the key alone: the same in every run, file and order of rows, and equal for
    repeated keys.  Rows without a key go to one shard.  No row is shuffled.
    """
    slot = spare_name(docs, "_slot")
    table = slot_table(docs.sparkSession, config).select(F.col("slot").alias(slot), F.col("shard").alias(name))
    dealt = docs.withColumn(slot, slot_of(F.col(key), config))
    return dealt.join(F.broadcast(table), slot).drop(slot)
