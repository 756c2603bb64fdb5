import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from steploom.llm.common import read
from steploom.llm.mixing import MixConfig, alias_rows, mix_sources, mixed_documents, permuted, settled_draws, shard_draws, target_sizes, with_base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = MixConfig(block=4, shard_slots=16, run_rows=8)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i % 37)) + "\n", "en", f"s{i % 5}", 1) for i in range(600)]
    rows += [(i, "x y z " * 40, "en", "s0", 1) for i in range(1000, 1200)]
    rows += [(2000, "tail words here", None, None, None), (None, "no id at all", None, "s1", None), (2001, None, "en", "s2", 0), (2002, "", "en", "s2", 0)]
    rows += [(3000, "same row twice over", "en", "s3", 1)] * 2 + [(3000, "same id other text", "en", "s3", 1)]
    return spark.createDataFrame([(*r, 9, "t") for r in rows], SCHEMA + ", size int, turn string")


def test_targets():
    config = MixConfig()
    assert target_sizes([("a", 80), ("b", 80), ("c", 80)], config) == [150, 60, 30]
    # a stops at 3 times its size; the rest is shared 2 to 1.
    assert target_sizes([("a", 10), ("b", 95), ("c", 95)], config) == pytest.approx([30, 170 * 2 / 3, 170 / 3])
    assert target_sizes([("a", 0), ("b", 0)], config) == [0, 0] and target_sizes([], config) == []
    assert sum(target_sizes([(str(i), i) for i in range(50)], config)) == pytest.approx(sum(range(50)))


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations(spark, n):
    df = spark.range(n)
    a, b = ([r[0] for r in df.select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(k))).collect()] for k in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 10 or (a != b and a != list(range(n)))


def test_documents(spark):
    docs = corpus(spark)
    got = mix_sources(docs, SMALL).documents.collect()
    assert len(got) == docs.count()
    sizes, taken, total = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        total[r.source] = (r.source_size, r.target)
    want = target_sizes(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")), SMALL)
    for (source, size), target in zip(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")), want, strict=True):
        assert total[source] == (size, pytest.approx(target))
        assert abs(taken[source] - target) <= 3 * SMALL.block


def test_reruns_and_layout_agree(spark):
    docs = corpus(spark)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mix_sources(docs, SMALL).documents) == key(mix_sources(docs.repartition(7), SMALL).documents)


def test_slots(spark):
    mix = mix_sources(corpus(spark), SMALL)
    slots = mix.slots.collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots)
    # No block twice in a turn, and no turn before the one before it is used up.
    assert max(Counter((r.source, r.block, r.turn) for r in slots).values()) == 1
    turns = Counter((r.source, r.turn) for r in slots)
    blocks = {s: max(r.block for r in slots if r.source == s) + 1 for s in {r.source for r in slots}}
    for (source, turn), n in turns.items():
        assert turn == 0 or turns[source, turn - 1] >= max(n, blocks[source])
    # Shards draw like the whole: each has its share of every large source within five deviations.
    whole = Counter(r.source for r in slots)
    for shard in {r.shard for r in slots}:
        own = Counter(r.source for r in slots if r.shard == shard)
        n = sum(own.values())
        for s, c in whole.items():
            p = c / len(slots)
            assert abs(own[s] - n * p) <= 5 * (n * p * (1 - p)) ** 0.5 + 1


@pytest.mark.parametrize("slots", [[5], [1, 0, 7], [3, 3, 3], [100, 1, 1, 50, 0, 9], [0, 0, 4]])
def test_alias_shares_are_exact(slots):
    total, share = sum(slots), Counter()
    for cell, below, other in alias_rows(slots):
        share[cell] += below
        share[other] += total - below
    assert [share[i] for i in range(len(slots))] == [w * len(slots) for w in slots]


def test_shards_draw_and_sums_settle(spark):
    slots, config = [6000, 2500, 1000, 0, 3], MixConfig(shard_slots=64)
    draws = shard_draws(spark.range(1), slots, config)
    drawn = {(r.shard, r.no): r.n for r in draws.collect()}
    sizes = Counter()
    for (shard, _), n in drawn.items():
        sizes[shard] += n
    total, shards = sum(slots), -(-sum(slots) // 64)
    assert [sizes[s] for s in range(shards)] == [64] * (shards - 1) + [total - 64 * (shards - 1)]
    # Counts of a source spread over the shards as those of a multinomial draw do.
    for no, w in enumerate(slots[:3]):
        p, own = w / total, [drawn.get((s, no), 0) for s in range(shards - 1)]
        mean = sum(own) / len(own)
        assert abs(mean - 64 * p) < 5 * (64 * p * (1 - p) / len(own)) ** 0.5
        assert 0.6 < sum((n - mean) ** 2 for n in own) / (len(own) - 1) / (64 * p * (1 - p)) < 1.5
    settled = {(r.shard, r.no): r.n for r in settled_draws(draws, slots, config).collect()}
    after, of_source, changed = Counter(), Counter(), 0
    for (shard, no), n in settled.items():
        after[shard] += n
        of_source[no] += n
    assert after == sizes and [of_source[i] for i in range(5)] == slots
    wrong = sum(abs(sum(n for (_, i), n in drawn.items() if i == no) - w) for no, w in enumerate(slots))
    changed = sum(abs(settled.get(k, 0) - drawn.get(k, 0)) for k in settled.keys() | drawn.keys())
    assert changed <= wrong


def test_running_sums(spark):
    rows = [(k, at, (at * 7 + len(k or "")) % 5) for k in ("a", "b", None) for at in [*range(0, 9000, 3), 40_000]]
    got = with_base(spark.createDataFrame(rows, "k string, at long, n long"), ["k"], "at", "n").collect()
    assert len(got) == len(rows)
    sums = Counter()
    for r in sorted(got, key=lambda r: r.at):
        assert r.base == sums[r.k]
        sums[r.k] += r.n


def test_documents_against_a_walk_over_words(spark):
    """Words in order of their source's documents, cut into blocks, taken as often as slots name their block."""
    config = MixConfig(block=4, shard_slots=16)
    rows = [(i, " ".join(["w"] * (i * i % 23)), "en", [None, "s1", "s2", "s3"][i % 4], 1) for i in range(300)]
    mix = mix_sources(spark.createDataFrame(rows, SCHEMA), config)
    uses = Counter((r.source, r.block) for r in mix.slots.collect())
    places, taken = Counter(), Counter()
    for doc_id, text, _, source, _ in rows:
        for _ in WORD.findall(text):
            taken[doc_id] += uses[source, places[source] // config.block]
            places[source] += 1
    assert {r.doc_id: r.taken for r in mix.documents.collect()} == {r[0]: taken[r[0]] for r in rows}


def test_mixed_rows_hold_the_words_taken(spark):
    docs = corpus(spark)
    taken, have = Counter(), Counter()
    for r in mix_sources(docs, SMALL).documents.collect():
        taken[r.doc_id] += r.taken
    mixed = mixed_documents(docs, SMALL)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for r in mixed.collect():
        own = WORD.findall(r.text)
        have[r.doc_id] += len(own)
        assert own and r.n_chars == len(r.text) and r["size"] == 9
        assert any(set(own) <= set(WORD.findall(t)) for t in texts[r.doc_id])
    assert +taken == +have


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix_sources(docs).documents.collect() == [] and mixed_documents(docs).collect() == []


def test_no_python_in_the_plan(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    for df in (mix_sources(docs).documents, mixed_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("CartesianProduct", "NestedLoop", "Python", "Arrow"))
