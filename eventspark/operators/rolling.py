"""Keyed running aggregates: one output row per input row (``keyBy(k).sum(...)`` / ``keyBy(k).reduce(max)``).

Both go through :func:`~eventspark.operators.scan.prefix_scan`, so a hot key (a frequent word, a chatty sensor) is
split across many tasks instead of landing in one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import prefix_scan
from .text import tokens


def running_word_count(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Every token with the count of its word so far, in arrival order ``(doc_id, pos)``."""
    toks = tokens(docs, id_col=id_col, text_col=text_col)
    return prefix_scan(toks, key="word", order=[id_col, "pos"],
                       values=[("running_cnt", F.lit(1).cast("bigint"), "sum")])


def running_max(df: DataFrame, *, key="id", value="temperature", order=("ts", "event_id"),
                out="running_max") -> DataFrame:
    """Every reading with the maximum value of its key so far (ties: only the value is output)."""
    return prefix_scan(df, key=key, order=list(order), values=[(out, F.col(value), "max")])
