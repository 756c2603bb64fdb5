import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from steploom.llm.common import read
from steploom.llm.queries import QUERIES
from steploom.llm.sharding import ShardConfig, lookup_table, shard_documents, slot_of

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def turn(x, n):
    return ((x << n) | (x >> (64 - n))) & MASK


def xxhash64(data, seed=42):
    """XXH64 of up to 31 bytes, as a signed number."""
    h = (seed + P5 + len(data)) & MASK
    while len(data) >= 8:
        h ^= turn(int.from_bytes(data[:8], "little") * P2 & MASK, 31) * P1 & MASK
        h, data = (turn(h, 27) * P1 + P4) & MASK, data[8:]
    if len(data) >= 4:
        h ^= int.from_bytes(data[:4], "little") * P1 & MASK
        h, data = (turn(h, 23) * P2 + P3) & MASK, data[4:]
    for b in data:
        h = turn(h ^ (b * P5 & MASK), 11) * P1 & MASK
    h = (h ^ (h >> 33)) * P2 & MASK
    h = (h ^ (h >> 29)) * P3 & MASK
    h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def brute(config):
    """The shards' whole permutations, written out, taken from in turns."""
    size, orders = config.slots, []
    for name in sorted(config.shards):
        d = hashlib.blake2b(name.encode(), digest_size=16, key=str(config.seed).encode()).digest()
        offset, skip = int.from_bytes(d[:8]) % size, int.from_bytes(d[8:]) % (size - 1) + 1
        orders.append([(offset + j * skip) % size for j in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for name, order in zip(sorted(config.shards), orders, strict=True):
            free = next((s for s in order if s not in owner), None)
            if free is not None:
                owner[free] = name
    return owner


def config(n, slots=251, seed=17):
    return ShardConfig(tuple(f"s{i}" for i in range(n)), slots, seed)


@pytest.mark.parametrize("n, slots, seed", [(1, 7, 1), (3, 7, 2), (5, 251, 17), (13, 251, 3), (250, 251, 4)])
def test_table(n, slots, seed):
    c = config(n, slots, seed)
    names, table = sorted(c.shards), lookup_table(c)
    assert {s: names[i] for s, i in enumerate(table)} == brute(c)
    counts = Counter(table)
    assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1
    assert lookup_table(ShardConfig(c.shards[::-1], slots, seed)) == table


def test_few_slots_move():
    whole, fewer = config(10, 9973), ShardConfig(tuple(f"s{i}" for i in range(10) if i != 4), 9973)
    before, after = ([sorted(c.shards)[i] for i in lookup_table(c)] for c in (whole, fewer))
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != "s4")
    assert "s4" not in after and moved < 0.05 * 9973


@pytest.mark.parametrize("c", [config(0), config(3, 250), config(7, 7), config(3, 1_048_583), ShardConfig(("a", "a"), 7)])
def test_refused(c):
    with pytest.raises(ValueError):
        lookup_table(c)


def test_rows(spark):
    c = config(5)
    keys = [*range(-50, 300), 2**62, None, None, 7, 7]
    docs = spark.createDataFrame([(k, f"t{i}", i) for i, k in enumerate(keys)], "doc_id long, text string, _slot int")
    owner = brute(c)
    want = sorted((str(k), f"t{i}", i, owner[(42 if k is None else xxhash64(str(k).encode())) % 251]) for i, k in enumerate(keys))
    out = shard_documents(docs, c)
    assert out.columns == [*docs.columns, "shard"]
    assert sorted((str(r.doc_id), r.text, r[2], r.shard) for r in out.collect()) == want
    assert shard_documents(docs.limit(0), c).collect() == []
    narrow = docs.where("doc_id = 7").select(slot_of(F.col("doc_id").cast("int"), c))
    assert {r[0] for r in narrow.collect()} == {xxhash64(b"7") % 251}


def test_query(spark):
    docs, c = read(spark, SF, "documents"), ShardConfig()
    names, table = sorted(c.shards), lookup_table(c)
    got = QUERIES["op6_sharding"](spark, SF)
    want = sorted((r.doc_id, xxhash64(str(r.doc_id).encode()) % c.slots) for r in docs.select("doc_id").collect())
    assert sorted((r.doc_id, r.shard) for r in got.collect()) == [(k, names[table[s]]) for k, s in want]
