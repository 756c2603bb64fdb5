import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from steploom.llm.packing import PackConfig, WordTokenizer, choose_cuts, pack_documents
from steploom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string"


@lru_cache
def plain():
    return Tokenizer.from_file(tokenizer_path())


@lru_cache
def fast():
    return WordTokenizer(tokenizer_path(), 50)


ODD = "aB'sT é́ß\n\t\x1c\x85  İΣς1²½.,!?<|endoftext|>😀字‍_-#"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=40) | st.text(max_size=30))
def test_ids_are_the_tokenizers(text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(fast().ids(text), "<u4").tolist() == plain().encode(text, add_special_tokens=False).ids


def test_special_words():
    for text in ("<|endoftext|> a", "a<|startoftext|>b", "don't DON'T we'll", "", "\x00", "x" * 5000):
        assert np.frombuffer(fast().ids(text), "<u4").tolist() == plain().encode(text, add_special_tokens=False).ids


def cost(places, penalties, cuts, length):
    total = 0
    for i, j in zip(cuts, cuts[1:]):
        n = places[j] - places[i]
        assert 0 < n <= length
        total += penalties[j] + (0 if n & (n - 1) == 0 else length - n)
    return total


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 1, 4])), min_size=1, max_size=30))
def test_cuts_are_the_cheapest(steps):
    places = np.cumsum([0] + [s for s, _ in steps])
    penalties = np.array([0] + [p for _, p in steps], dtype=float)
    best = [0.0] + [np.inf] * len(steps)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= 16:
                best[j] = min(best[j], best[i] + penalties[j] + (0 if n & (n - 1) == 0 else 16 - n))
    cuts = choose_cuts(places, penalties, 16)
    assert cuts[0] == 0 and cuts[-1] == len(steps)
    assert cost(places, penalties, cuts, 16) == pytest.approx(best[-1])


def checked(spark, rows, config):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", start int, ids string")
    pieces = pack_documents(docs, config).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == p.length > 0
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) <= config.length
    return by_doc, by_sequence


@pytest.mark.parametrize("run_tokens", [1 << 19, 700])
def test_round_trip_and_padding(spark, run_tokens):
    texts = [None, "", "One two. Three!", "a " * 9000, ". " * 50, "x" * 4000, *["Some words here. And others, too. " * (k % 40) for k in range(200)]]
    rows = list(enumerate(texts))
    config = PackConfig(tokenizer=tokenizer_path(), run_tokens=run_tokens)
    by_doc, by_sequence = checked(spark, rows, config)
    for i, t in rows:
        want = plain().encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == want
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(want)}


def test_null_and_repeated_ids_and_no_rows(spark):
    config = PackConfig(tokenizer=tokenizer_path())
    by_doc, _ = checked(spark, [(None, "a b"), (2**53 + 1, "c"), (2**53 + 1, "c"), (None, None)], config)
    assert {k: len(v) for k, v in by_doc.items()} == {None: 2, 2**53 + 1: 2}
    assert pack_documents(spark.createDataFrame([], SCHEMA), config).collect() == []


def test_little_padding(spark):
    r = np.random.default_rng(1)
    rows = [(i, " ".join(["word"] * int(n)) + ".") for i, n in enumerate(r.integers(1, 900, 800))]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    lengths = pack_documents(docs, PackConfig(tokenizer=tokenizer_path())).groupBy("sequence_id").sum("length").collect()
    sums = [x[1] for x in lengths]
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in sums) < 0.02 * sum(sums)
