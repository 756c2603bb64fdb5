import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from steploom.llm.divergence import DivergenceConfig, source_divergence
from steploom.llm.termruns import TermCounter, radix_order, term_strings

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, value long, term string"


def terms(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def brute(docs, min_docs, top=10):
    docs = [(t or "", lang or "", s or "") for t, lang, s in docs]
    df = Counter((lang, w) for t, lang, _ in docs for w in set(terms(t)))
    counts = Counter((lang, s, w) for t, lang, s in docs for w in terms(t))
    total = Counter((lang, w) for t, lang, _ in docs for w in terms(t))
    rows = []
    for lang in {d[1] for d in docs}:
        kept = sorted(w for (x, w), n in df.items() if x == lang and n >= min_docs)
        sources = sorted({s for _, x, s in docs if x == lang})

        def share(count, kept=kept):
            n = sum(count(w) for w in kept)
            return {w: 1 + 10**9 * (count(w) + 2) // (n + 2 * len(kept)) for w in kept}

        p = {s: share(lambda w, s=s, lang=lang: counts[lang, s, w]) for s in sources}
        q = share(lambda w, lang=lang: total[lang, w])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            own = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if counts[lang, s, w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                rows += [(lang, s, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)]
    return sorted(rows)


def corpus(r, n=300):
    vocabulary = [r.choice(["ab", "Wort", "élan", "日本", "x"]) * k for k in (1, 2, 3, 5, 9, 40, 90) for _ in range(3)] + list("abcdefgh")
    docs = []
    for _ in range(n):
        source = r.choice(["s1", "s1", "s1", "s2", "s3", "", None, "only", "Ä", *(f"t{i}" for i in range(9))])
        mine = vocabulary[hash(source or "") % 5 :]
        text = " ".join(r.choice(mine) for _ in range(r.choice([0, 1, 5, 30])))
        docs.append((r.choice([text, text, text + "?!", None]) if source != "only" else "12 3", r.choice(["en", "en", None, "rare"]), source))
    return docs + docs[:7]


@pytest.mark.parametrize("config", [DivergenceConfig(), DivergenceConfig(min_docs=2, top=3, cell=2, cell_terms=3)])
def test_matches_brute_force(spark, config):
    docs = corpus(random.Random(8))
    df = spark.createDataFrame([(i, *d, 1, "clash") for i, d in enumerate(docs)], SCHEMA)
    got = source_divergence(df, config).collect()
    assert got and got[0].asDict().keys() == {"lang", "source", "part", "item", "value", "rank"}
    assert sorted(tuple(r) for r in got) == brute(docs, config.min_docs, config.top)


@pytest.mark.parametrize("rows", ["1", "7"])
def test_terms_whose_sources_lie_in_several_batches(spark, rows):
    docs = corpus(random.Random(9))
    df = spark.createDataFrame([(i, *d, 1, "clash") for i, d in enumerate(docs)], SCHEMA)
    known = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = source_divergence(df, DivergenceConfig(min_docs=2, cell_terms=1)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", known)
    assert sorted(tuple(r) for r in got) == brute(docs, 2)


def test_ties_empty_tables_and_languages_without_terms(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = [("a b", "en", s) for s in "zyx"] + [(None, "en", "n")]
    df = spark.createDataFrame([(i, *d, 1, "clash") for i, d in enumerate(docs)], SCHEMA)
    got = sorted(tuple(r) for r in source_divergence(df).collect())
    assert got == brute(docs, 10)
    assert [r[3:] for r in got if r[1] == "z"] == [("n", 0, 1), ("x", 0, 2), ("y", 0, 3)]


def counted(texts, groups, cuts, **limits):
    counter, out = TermCounter(**limits), []
    for lo, hi in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        out += counter.add(pa.array(texts[lo:hi], pa.string()), np.array(groups[lo:hi], dtype=np.int64))
    found = {}
    for bucket, runs in out + counter.rest():
        strings = term_strings(bucket, runs.keys).to_pylist()
        for w, g, n, d in zip(strings, runs.group.tolist(), runs.n.tolist(), runs.docs.tolist(), strict=True):
            known = found.setdefault((w, g), [0, 0])
            known[0] += n
            known[1] += d
    return found


def plain(texts, groups):
    found = {}
    for t, g in zip(texts, groups, strict=True):
        for w, n in Counter(terms(t)).items():
            known = found.setdefault((w, g), [0, 0])
            known[0] += n
            known[1] += 1
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abZ éñ日\x00\x7f[~`@", max_size=60), st.integers(0, 3)), min_size=1, max_size=30))
def test_packed_counts(rows):
    texts, groups = [t for t, _ in rows], [g for _, g in rows]
    want = plain(texts, groups)
    assert counted(texts, groups, []) == want
    assert counted(texts, groups, [len(texts) // 2], slice_bytes=16, hold=5) == want


def test_terms_of_every_length_and_a_very_long_text():
    lengths = [1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 128, 129, 255, 256, 257, 5000]
    texts = [" ".join(("aB" * n)[:n] + " " + "é" * n for n in lengths) for _ in range(3)] + ["long word " * 30_000, "x" * 100_000]
    want = plain(texts, [0, 1, 1, 0, 0])
    assert counted(texts, [0, 1, 1, 0, 0], []) == want
    assert counted(texts, [0, 1, 1, 0, 0], [1, 4], slice_bytes=1000, hold=50) == want


def test_radix_order_is_stable():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 4, 1000, dtype=np.uint64), r.integers(0, 1 << 63, 1000, dtype=np.uint64) >> np.uint64(40)
    assert radix_order([(a, 1), (b, 2)]).tolist() == np.lexsort([b, a]).tolist()
    assert radix_order([(a, 1)]).tolist() == np.argsort(a, kind="stable").tolist()
