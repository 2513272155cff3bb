"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventspark.llm import chat
from eventspark.llm.conversation_repair import REPAIR_SQL, damaged, repair_conversations, repair_digest
from eventspark.llm.cover_tree import near_vectors
from eventspark.llm.line_dedup import LINES_SQL, LineIndex
from eventspark.llm.maxent_lm import score_texts
from eventspark.llm.minmax_dedup import near_duplicates
from eventspark.llm.mixing import Target, mix_sources, mixing_sql
from eventspark.llm.packing import pack
from eventspark.llm.personal_data import personal_data
from eventspark.llm.quality_knn import held_out, quality_scores, train
from eventspark.llm.topk import top_k, top_k_sql
from eventspark.llm.url_filter import Rule, judge_urls
from eventspark.llm.whitening import whiten
from eventspark.sources.tables import read_table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
KEEP_QUALITY = 0.7
#: Sources flattened, languages and topics by given weights.
MIX_TARGETS = {
    "source": Target(temper=0.7),
    "lang": Target({"en": 5, "de": 2, "fr": 2, "es": 1}, other=0.5),
    "topic": Target({"article": 4, "book": 3, "note": 1, "table": 0.5, "license": 0.5, "contact": 1}),
}
#: A conversation whose texts hold every control string of the template.
CONTROL_TEXT = "\\### Assistant: </turn> ok"
URL_RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
             Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and conversation -7, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    turns = chat.canonical_turns(chat.conversation_records(rows.union(extra)))
    return chat.chat_digest(chat.format_chat(turns))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of equal label."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, probability and decision of every document."""
    out = mix_sources(read_table(spark, sf_dir, "documents"), MIX_TARGETS)
    return out.select("doc_id", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                      F.round("mix_p", 6).alias("probability"), F.round("mix_weight", 6).alias("weight"),
                      F.col("mix_sampled").alias("sampled"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every embedding whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' token pieces in windows of 2048."""
    return pack(read_table(spark, sf_dir, "documents"), VOCABULARY, RANKS, public_tokenizers.PATTERN)


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the language model and its unigram base."""
    return score_texts(read_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents, base finds and those behind disguises."""
    return personal_data(read_table(spark, sf_dir, "documents"))


def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return quality_scores(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= KEEP_QUALITY, 1).otherwise(0).alias("predicted"))


def op10_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls."""
    return judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings on their eight leading whitened components."""
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their shared lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    index = LineIndex(spark)
    index.insert(docs)
    return index.deduplicated(docs).select("doc_id", "n_lines", "n_dropped",
                                           F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of all conversations after damage."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_digest(rows, repair_conversations(damaged(rows)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_cover_tree": op2_cover_tree,
    "op3_mix_sources": op3_mix_sources,
    "op4_top_k": op4_top_k,
    "op5_minmax_dedup": op5_minmax_dedup,
    "op6_pack_nnls": op6_pack_nnls,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_personal_data": op8_personal_data,
    "op9_quality_knn": op9_quality_knn,
    "op10_url_words": op10_url_words,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

#: DuckDB SQL of the same rows, where SQL can express them on whole tables.
ORACLE: dict[str, str] = {
    "op1_chat": chat.chat_sql(f"SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'"),
    "op4_top_k": top_k_sql(50),
    "op3_mix_sources": mixing_sql(MIX_TARGETS),
    "op12_line_dedup": LINES_SQL,
    "op13_conversation_repair": REPAIR_SQL,
}
