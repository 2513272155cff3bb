"""Tokenising text and counting words.

Splitting follows the reference's tokenizer, a Java ``split("\\s")``: one whitespace character per separator, inner
empty tokens kept, trailing empty tokens dropped, a whitespace-only text gives no token and the empty text gives one
empty token.  Spark's ``split`` keeps trailing empties, so trailing whitespace is stripped first.

Whole texts are always tokenised (no prefixes); ``posexplode`` keeps the position so running counts can be ordered by
arrival ``(doc, position)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters Java's \s matches (space, \t, \n, \x0B, \f, \r), as a regex class and as a set.
JAVA_WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"
JAVA_WS_CHARS = " \t\n\x0b\x0c\r"


def java_whitespace_split(text: Column) -> Column:
    stripped = F.rtrim(text, F.lit(JAVA_WS_CHARS))  # trailing whitespace off (a character set, no regex)
    return (F.when(text == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, JAVA_WS_CLASS)))


def tokens(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per token: ``doc_id, pos, word``."""
    return docs.select(id_col, F.posexplode(java_whitespace_split(F.col(text_col))).alias("pos", "word"))


def word_count(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Final count per word (``keyBy(word).sum(1)`` once the bounded input has ended).

    Partial counts are combined map-side before the shuffle, so a very frequent word costs one row per map task.
    Positions are not needed here, so the words are exploded without them.
    """
    words = docs.select(F.explode(java_whitespace_split(F.col(text_col))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
