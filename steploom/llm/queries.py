"""One query per operator over whole tables, with comparison SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_digests, format_chats, row_events
from .common import read
from .divergence import source_divergence
from .filter_audit import audit_orders, failure_counts
from .html_text import extract_pages
from .language import LangConfig, identify, train_languages
from .language import held_out as lang_held_out
from .mil_quality import MilConfig, quality_score, train_quality
from .mil_quality import held_out as mil_held_out
from .mixing import mix_sources
from .near_dup import near_duplicate_components
from .oracles import ORACLES
from .packing import PackConfig, pack_documents
from .quality_rules import judge_documents
from .sharding import shard_documents
from .topk import quantized, search_top_k
from .url_filter import HostPath, Pattern, judge_urls

#: Rules in force: the contract's host rules, and patterns for hosts and paths of spam and advertising.
URL_RULES = (
    HostPath("allow", "org", "/"),
    HostPath("block", "example.org", "/es/"),
    HostPath("block", "example.org", "/en/1"),
    HostPath("allow", "com", "/fr/"),
    HostPath("block", "com", "/de/"),
    Pattern("block", "spam-farm."),
    Pattern("block", "cheap-pills."),
    Pattern("block", "/casino/"),
    Pattern("block", "adserver."),
    Pattern("block", "/banner/"),
    Pattern("block", "*tracker.*/click?"),
    Pattern("allow", "/security/spam-farm.report/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents; see ``judge_documents`` for NULLs, repeats and empty tables."""
    judged, name = judge_documents(read(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", f"{name}.*")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; see ``train_languages`` and ``identify`` for NULLs, ties and long texts."""
    docs, config = read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), LangConfig()
    predict = identify(train_languages(docs, config))
    found = docs.select("doc_id", lang_held_out(F.col("doc_id"), config).alias("held_out"), predict("text").alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(read(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read(spark, sf_dir, "documents"), PackConfig(tokenizer=tokenizer_path()))
    return pieces.drop("ids")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents")).select("doc_id", "shard")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, config = read(spark, sf_dir, "documents").select("doc_id", "text"), MilConfig()
    score = quality_score(train_quality(docs, read(spark, sf_dir, "labels"), config))
    found = docs.select("doc_id", mil_held_out(F.col("doc_id"), config).alias("held_out"), score("text").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).documents.drop("source")


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding")).alias("vector"))
    return search_top_k(vectors, vectors.where("vec_id % 100 = 0"))


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters for each source; see ``failure_counts`` for NULLs and repeats."""
    return audit_orders(failure_counts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources of each language against each other and their language; see ``source_divergence`` for NULLs and ties."""
    return source_divergence(read(spark, sf_dir, "documents"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all rendered conversations and of one that is made of control strings; see ``final_messages`` for NULLs and ties."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hostile = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text")
    )
    return chat_digests(format_chats(row_events(rows.unionByName(hostile))))


QUERIES = {
    "op1_url_filter": url_filter,
    "op2_quality_rules": quality_rules,
    "op3_language_id": language_id,
    "op4_near_duplicates": near_duplicates,
    "op5_packing": packing,
    "op6_sharding": sharding,
    "op7_quality_classifier": quality_classifier,
    "op8_html_text": html_text,
    "op9_mixing": mixing,
    "op10_top_k": top_k,
    "op11_filter_audit": filter_audit,
    "op12_source_divergence": divergence,
    "op13_chat_format": chat_format,
}

__all__ = ["ORACLES", "QUERIES"]
