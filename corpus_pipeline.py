"""Training-data pipeline over ``documents``: quality, near-duplicates, personal data, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which the runner writes as Parquet and hands on as
the next stage's ``docs``.  All but the last return the columns of ``documents``; the last returns packed pieces.
Empty tables, null texts and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventspark.llm.minmax_dedup import deduplicated
from eventspark.llm.mixing import mix_sources
from eventspark.llm.packing import pack
from eventspark.llm.personal_data import redact
from eventspark.llm.quality_knn import quality_scores, train
from eventspark.llm.queries import KEEP_QUALITY, MIX_TARGETS, RANKS, VOCABULARY
from eventspark.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of the tokens that the mixing stage samples.
MIX_KEEP = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all of them, if it has learnt no label.

    A text without words has the learnt sample's share of label 1 for its score and is judged by it like any other."""
    docs = docs.select(*COLUMNS)
    model = train(docs, read_table(spark, sf_dir, "labels"))
    if not len(model.labels):
        return docs
    return quality_scores(docs, model).filter(F.col("score") >= KEEP_QUALITY).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (similarity 0.8 or more): the one with the smallest doc_id, a null one last.

    Rows are compared by their own text, also where ids repeat or are missing; rows without words stay."""
    return deduplicated(docs, percent=80, bands=38).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, ``n_chars`` made to fit."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target shares of source, language and topic."""
    return mix_sources(docs, MIX_TARGETS, keep=MIX_KEEP).filter("mix_sampled").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the token pieces in windows of 2048."""
    return pack(docs, VOCABULARY, RANKS, public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mixing", mixing),
          ("packing", packing)]
#: The classifier, the near-duplicates and the packing have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
