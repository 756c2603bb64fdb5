import random
import re
from collections import Counter
from itertools import permutations

import pytest

from steploom.llm.filter_audit import audit_orders, failure_counts, potential

DOCS = "part string, doc_id long, text string, digest string, mask int"
LABELS = "doc_id long, quality int, toxic int, n int"


def brute(docs, labels):
    """All orders walked document by document."""
    first, good, toxic = {}, set(), set()
    for _, i, t in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        good |= {i} if q == 1 and i is not None else set()
        toxic |= {i} if x == 1 and i is not None else set()
    failing = []
    for part, i, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t],
        }
        failing.append((part or "", {c for c in bad if bad[c]}, i in good, i in toxic))
    rows, total = [], Counter()
    for part in {f[0] for f in failing}:
        own = [f[1:] for f in failing if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            here = list(own)
            for step, c in enumerate(order, 1):
                gone = [f for f in here if c in f[0]]
                here = [f for f in here if c not in f[0]]
                total[part, c] += len(gone)
                redundant = sum(c in f[0] for f in own) - len(gone)
                alone = sum(f[0] == {c} for f in own)
                rows.append([part, order, step, len(here), len(gone), redundant, alone, sum(f[1] for f in gone), sum(f[2] for f in gone)])
    return sorted((*r, total[r[0], r[1][r[2] - 1]]) for r in rows)


def audited(spark, docs, labels):
    rows = [(p, i, t, "x", 7) for p, i, t in docs]
    counts = failure_counts(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(*r, 1) for r in labels], LABELS), part="part")
    return sorted(tuple(r) for r in audit_orders(counts).collect())


def test_matches_walking_all_orders(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "bb", "C", "d#", "Ee", f"w{r.random()}"][k:]) for _ in range(n)) for n in (0, 3, 49, 50, 51, 90) for k in range(6)]
    texts += [None, "", " \t\n", "A" * 60 + " b", "ÄÖ " * 60, "a\u00a0b " * 50]
    docs = [(r.choice(["s", "t", None, ""]), r.choice([i, i, 3, None]), r.choice(texts)) for i in range(400)]
    docs += docs[:9] + [("s", 1000 + i, "same text " * 40) for i in range(50)]
    labels = [(r.randrange(400), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_equal_ids_and_rows_without_ids_are_no_copies(spark):
    docs = [("s", 5, "t"), ("s", 5, "t"), ("s", None, "t"), ("s", 6, "t"), ("s", 7, None), ("s", 8, "")]
    got = [r for r in audited(spark, docs, []) if r[1] == "EABCD"]
    assert [(r[3], r[4]) for r in got] == [(4, 2), (0, 4), (0, 0), (0, 0), (0, 0)]


def test_empty_tables_and_a_very_long_text(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    docs = [("s", 1, "word " * 400_000), ("s", 2, "x " * 10)]
    assert audited(spark, docs, []) == brute(docs, [])


def test_potentials_differ_by_members_up_to_the_game(spark):
    game = [0, 3, 4, 9, 2, 5, 5, 11]
    df = spark.createDataFrame([(game,)], "v array<long>")
    p = df.select(potential(df.v, 3).alias("p")).first().p
    for s in range(8):
        assert sum(p[s] - p[s ^ (1 << i)] for i in range(3) if s >> i & 1) == 6 * game[s]


def test_number_of_filters_is_bounded(spark):
    with pytest.raises(ValueError):
        audit_orders(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "ABCDEFGH")


def test_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame([("s", 1, "t", "x", 7)], DOCS)
    plan = audit_orders(failure_counts(docs, spark.createDataFrame([], LABELS), part="part"))._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan and "Python" not in plan
