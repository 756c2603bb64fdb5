"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steploom.llm.common import read, spare_name
from steploom.llm.mil_quality import quality_score, train_quality
from steploom.llm.mixing import mixed_documents
from steploom.llm.near_dup import NearDupConfig, drop_near_duplicates
from steploom.llm.packing import PackConfig, pack_documents
from steploom.llm.quality_rules import judge_documents
from steploom.llm.queries import tokenizer_path
from steploom.llm.setsketch import SketchConfig
from steploom.session import materialize

#: Word shingles of five words and a similarity of 0.8; 60 bands find a pair at 0.8 but for one in 10**8.
NEAR_DUPLICATES = NearDupConfig(percent=80, sketch=SketchConfig(bands=60, rows=6))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    model = train_quality(docs, read(spark, sf_dir, "labels"))
    score = spare_name(docs, "_score")
    return docs.withColumn(score, quality_score(model)("text")).where(F.col(score) >= 0.5).drop(score)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the text rules and whose host is not refused."""
    judged, name = judge_documents(docs)
    return judged.where(F.col(name)["kept"]).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return drop_near_duplicates(docs, NEAR_DUPLICATES)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words, taken so that sources have their target weights; a row for each turn of a document."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 tokens: a row for each piece, with its token ids."""
    return pack_documents(docs, PackConfig(tokenizer=tokenizer_path()))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Classifier, sketches and tokenizer have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
