import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from steploom.llm.quality_rules import COUNTS, HostRules, host_verdicts, judge_documents, text_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    places = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places), len(lines))


def counts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [tuple(r) for r in df.select("i", text_counts(F.col("text")).alias("c")).orderBy("i").select("c.*").collect()]


def test_counts(spark):
    texts = [
        None, "", " \n\t ", "a", "a b c", "a b c d a b c", "x x x x", "a a a", "é ü\u00a0z ## |\nq\n\nq\nq ", "a\x0bb\x0cc\rd\x1ce",
        "😀 😀 😀 😀 1", "same line\nsame line\nsame  line", " ".join(f"w{i % 977}" for i in range(20_000)), "A a A a A a",
    ]
    assert counts(spark, texts) == [brute(t) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab #|\n\té", max_size=60), min_size=1, max_size=12))
def test_counts_of_any_text(spark, texts):
    assert counts(spark, texts) == [brute(t) for t in texts]


def test_verdicts_keep_columns_and_rows(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean, "good", 7), (1, clean, "good", 7), (2, "short", "good", 8), (3, clean, None, 9), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _judged int")
    got, name = judge_documents(docs)
    assert name != "_judged" and got.columns == [*docs.columns, name]
    kept = sorted((str(r.doc_id), r[name]["base_failed"], r[name]["kept"], r._judged) for r in got.collect() if r.doc_id)
    assert kept == [("1", False, True, 7), ("1", False, True, 7), ("2", True, False, 8), ("3", False, True, 9)]
    assert got.where(F.col("doc_id").isNull()).select(f"{name}.base_failed").collect()[0][0] is True


def test_a_bad_host_takes_its_documents_along(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(i, clean if i % 50 == 0 else "x", "bad") for i in range(500)]
    rows += [(1000 + i, clean if i % 50 else "x", f"host{i % 5}") for i in range(1000)] + [(5000, "x", "tiny"), (5001, clean, "tiny")]
    got, name = judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    refused = {r.source for r in got.where(f"{name}.host_refused").collect()}
    assert refused == {"bad"}
    assert got.where(f"source = 'bad' AND {name}.kept").count() == 0


def test_small_hosts_are_shrunk_to_the_pooled_rate(spark):
    rows = [(f"h{i}", {"short": False}) for i in range(40) for _ in range(25)] + [("one", {"short": True})]
    counted = spark.createDataFrame(rows, "host string, failed struct<short: boolean>")
    assert host_verdicts(counted, HostRules()).where("refused").count() == 0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    got, name = judge_documents(docs)
    assert got.collect() == [] and got.schema[name].dataType.names == [*COUNTS, "base_failed", "host_refused", "kept"]


def test_only_the_columns_asked_for_are_stored(spark):
    docs = spark.createDataFrame([(1, "a b", "h", 7), (2, None, None, 8)], "doc_id long, text string, source string, extra int")
    got, name = judge_documents(docs, columns=["doc_id"])
    assert got.columns == ["doc_id", name] and got.count() == 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "extra" not in plan
