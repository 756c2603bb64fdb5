import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from steploom.llm.components import connected_components, contracted
from steploom.llm.near_dup import NearDupConfig, _stars, common_counts, drop_near_duplicates, near_duplicate_components, shingle_sets
from steploom.llm.setsketch import SketchConfig, likely_similarity, sketches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent):
    """Smallest id reachable over links of at least ``percent``, and set sizes."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def corpus(seed, groups, size, words=60, changes=6):
    """Groups of documents that each differ from a base in up to ``changes`` words, so links form chains."""
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(10_000)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randrange(changes)):
                own[r.randrange(words)] = f"n{r.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    r.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("percent", [80, 85])
def test_chains_match_brute_force(spark, percent):
    rows = corpus(3, groups=6, size=40)
    sketch = SketchConfig(bands=60, rows=6) if percent == 80 else SketchConfig(bands=40, rows=6)
    got = near_duplicate_components(spark.createDataFrame(rows, SCHEMA), NearDupConfig(percent=percent, sketch=sketch))
    assert result(got) == brute(rows, percent)


@pytest.mark.parametrize("mixing_blocks", [1, 100])
def test_groups_larger_than_a_block_match_brute_force(spark, mixing_blocks):
    rows = corpus(4, groups=1, size=150, changes=9) + [(i + 1000, t) for i, t in corpus(5, groups=2, size=30)]
    config = NearDupConfig(block_docs=16, mixing_blocks=mixing_blocks)
    assert result(near_duplicate_components(spark.createDataFrame(rows, SCHEMA), config)) == brute(rows, 85)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 7919}x{i % 101}" for i in range(30_000))
    rows = [
        (9, "A b C"), (3, "a B\tc"), (4, "a b"), (5, None), (6, ""), (7, " \n"), (8, long), (2, long + " end"), (1, long.upper()),
        (10, "É b c d e"), (11, "é b c d e"), (12, "one two three four five"), (13, "one two three four five"),
    ]
    docs = spark.createDataFrame([(*r, "c", 1, "x") for r in rows], SCHEMA + ", component_id string, kept int, bands string")
    got = near_duplicate_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_null_and_repeated_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(map(str, r)) for r in near_duplicate_components(docs).collect())
    assert got == [
        ("1", "2", "1", "True"), ("1", "2", "1", "True"), ("2", "2", "1", "False"), ("None", "0", "None", "True"), ("None", "2", "None", "True"),
    ]
    assert sorted(str(r.doc_id) for r in drop_near_duplicates(docs).collect()) == ["1", "None", "None"]


def test_empty(spark):
    assert near_duplicate_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 520)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {x.node: x.component for x in got.collect()} == {x: find(x) for x in list(root)}


def test_components_of_loops_nulls_and_nothing(spark):
    made = lambda rows: sorted(tuple(x) for x in connected_components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert made([]) == []
    assert made([(4, 4), (4, 4)]) == [(4, 4)]
    assert made([(4, 4), (5, 4), (4, 5), (6, 6), (None, 7), (8, None)]) == [(4, 4), (5, 4), (6, 6)]


def test_edges_of_a_hot_group_shrink_every_round(spark):
    r = random.Random(6)
    edges = {tuple(sorted((i, r.randrange(i)))) for i in range(1, 1500) for _ in range(10)} | {(i, i + 1) for i in range(2000, 2400)}
    left, sizes = spark.createDataFrame(sorted(edges), "a long, b long"), [len(edges)]
    while sizes[-1]:
        left = contracted(left, len(sizes))[1]
        sizes.append(left.count())
    assert all(b < a for a, b in zip(sizes, sizes[1:], strict=False)) and len(sizes) < 12, sizes


def test_stars_and_what_joins_them_take_few_rounds(spark):
    r = random.Random(7)
    hubs = list(range(10_000, 10_020))
    edges = {(i, r.choice(hubs)) for i in range(3000)} | {(hubs[0], h) for h in hubs[1:]} | {(20_000 + 3 * i, 20_001 + 3 * i) for i in range(300)}
    left, rounds = spark.createDataFrame(sorted(edges), "a long, b long"), 0
    while left.count():
        left, rounds = contracted(left, rounds)[1], rounds + 1
    assert rounds <= 2


def test_members_of_a_hot_group_name_one_first(spark):
    rows = spark.createDataFrame([(d, f) for d in range(10, 200) for f in (1, 3, d % 3 + 5)], "doc_id long, first long")
    edges = {tuple(e) for e in _stars(rows).collect()}
    assert len(edges) == 190 + 4 and {e for e in edges if e[1] < 10} == {(1, 3), (1, 5), (1, 6), (1, 7)}


def test_the_smallest_text_of_an_id_stays_in_any_layout(spark):
    rows = [(1, "b c", "x"), (1, "a z", "y"), (1, None, "z"), (2, None, "q"), (2, None, "q"), (3, "t", "m"), (3, "t", "n")]
    found = []
    for turn in range(4):
        docs = spark.createDataFrame(rows[turn:] + rows[:turn], SCHEMA + ", row string").repartition(1 + turn)
        found.append(sorted(tuple(map(str, r)) for r in drop_near_duplicates(docs).collect()))
    assert found == [found[0]] * 4 and [r[1] for r in found[0]] == ["a z", "None", "t"]


def test_sketches_merge_and_estimate():
    config = SketchConfig(bands=64, rows=8)
    r = np.random.default_rng(2)
    for similarity in (0.2, 0.5, 0.85, 0.95):
        union = np.unique(r.integers(0, 2**63, 4000, dtype=np.uint64))
        both = int(similarity * len(union))
        half = (len(union) - both) // 2
        a, b = union[: both + half], np.concatenate([union[:both], union[both + half :]])
        x, y, u = sketches([a, b, union], config)
        assert (np.maximum(x, y) == u).all()
        above, below = np.array([(x > y).sum()]), np.array([(x < y).sum()])
        likely = likely_similarity(above, below, np.array([len(a)]), np.array([len(b)]), config)[0]
        assert abs(likely - similarity) < 5 * np.sqrt(similarity * (1 - similarity) / config.registers) + 0.01


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30), min_size=2, max_size=20))
def test_intersections_both_ways(lists):
    sets = [np.unique(np.array(x, dtype=np.uint64)) for x in lists]
    a, b = np.triu_indices(len(sets), 1)
    want = [len(set(lists[i]) & set(lists[j])) for i, j in zip(a, b, strict=True)]
    assert common_counts(sets, a, b).tolist() == want
    many = np.tile(a, 50), np.tile(b, 50)
    assert common_counts(sets, *many).tolist() == want * 50


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="aB é\t\n ", max_size=40))
def test_set_sizes(text):
    assert len(shingle_sets([text], 5)[0]) == len(shingles(text))
