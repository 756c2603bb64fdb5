from collections import Counter

import corpus_pipeline as pipeline
import pytest
from test_near_dup import brute, corpus
from test_quality_rules import brute as brute_counts
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from steploom.llm.common import read
from steploom.llm.mil_quality import train_quality
from steploom.llm.mixing import mix_sources
from steploom.llm.queries import tokenizer_path
from steploom.session import materialize

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(pipeline.STAGES)


def keyed(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def documents(spark):
    return read(spark, SF, "documents")


def test_registered():
    assert set(oracle_sql()) <= set(queries())
    assert {"pipeline", *(f"op{n}_" for n in range(1, 14))} <= {
        q if q == "pipeline" else q.split("_")[0] + "_" for q in queries()
    }
    assert [name for name, _ in pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "mixing", "packing"]


def test_classifier_stage(spark, documents):
    model = train_quality(documents, read(spark, SF, "labels"))
    kept = STAGES["quality_classifier"](spark, documents, SF)
    rows = documents.collect()
    scores = model.scores([r.text for r in rows])
    assert kept.columns == documents.columns
    assert keyed(kept) == sorted((r.doc_id, r.text) for r, s in zip(rows, scores, strict=True) if s >= 0.5)


def test_rules_stage(spark, documents):
    kept = STAGES["quality_rules"](spark, documents, SF)

    def passes(text):
        n, _, _, _, repeated, _ = brute_counts(text)
        return n >= 50 and 100 * repeated <= 50 * n

    assert kept.columns == documents.columns
    # No host of these documents fails often enough to be refused.
    assert keyed(kept) == sorted((r.doc_id, r.text) for r in documents.collect() if passes(r.text))


def test_near_duplicate_stage(spark):
    rows = corpus(8, groups=5, size=30)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = STAGES["near_duplicates"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(rows, 80).values()})


def test_mixing_and_packing_stages(spark, documents):
    taken = Counter({r.doc_id: r.taken for r in mix_sources(documents).documents.collect()})
    mixed = materialize(STAGES["mixing"](spark, documents, SF))
    assert mixed.columns == documents.columns and mixed.dtypes == documents.dtypes
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == +taken
    plain = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, tuple(plain.encode(r.text, add_special_tokens=False).ids) + (1,)] += 1
    pieces = STAGES["packing"](spark, mixed, SF).collect()
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    whole = Counter((p.doc_id, tuple(p.ids)) for p in pieces if p.length == p.doc_tokens)
    assert whole and not whole - want


def test_empty_and_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (2, "a b", "en", None, 3), (2, "a b", "en", None, 3)]
    for given in ([], rows):
        docs = spark.createDataFrame([(*r, "x") for r in given], SCHEMA + ", _score string")
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= 3 * len(given)
        assert (STAGES["packing"](spark, docs, SF).count() > 0) == bool(given)


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(out.columns)
    assert out.where("length <= 0 OR length > 2048").count() == 0 and out.count() > 0
