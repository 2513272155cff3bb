"""Line and delimited-text sources.

* ``parse_key_seconds`` — lines ``"key seconds"`` → ``(key, ts)`` with the seconds turned into an event time.
* ``read_behavior_csv`` — the user-behaviour CSV (``user,item,category,behavior,epoch seconds``, no header) with an
  explicit schema and ``FAILFAST`` (a malformed row is an error, as in the reference), batch or streaming.
* ``read_lines_stream`` — a directory of text files as a stream of lines (replaces the socket line source, which is a
  single-machine debugging device).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEHAVIOR_CSV_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("epoch_s", T.LongType()),
])


def parse_key_seconds(lines: DataFrame, *, line_col="line", sep=" ") -> DataFrame:
    """``"key seconds"`` → ``key`` and ``ts`` (timestamp without zone, seconds × 1000 ms in the reference)."""
    parts = F.split(F.col(line_col), sep)
    keep = [c for c in lines.columns if c != line_col]
    return lines.select(*keep, parts.getItem(0).alias("key"),
                        F.timestamp_seconds(parts.getItem(1).cast("bigint")).cast("timestamp_ntz").alias("ts"))


def _behavior_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return raw.select(*keep, "user_id", "item_id", "category_id", "behavior",
                      F.timestamp_seconds("epoch_s").cast("timestamp_ntz").alias("ts"))


def parse_behavior_lines(lines: DataFrame, *, line_col="line") -> DataFrame:
    """CSV lines already in a column, by the same schema and rules as :func:`read_behavior_csv`."""
    row = F.from_csv(F.col(line_col), BEHAVIOR_CSV_SCHEMA.toDDL(), {"mode": "FAILFAST"})
    keep = [c for c in lines.columns if c != line_col]
    return _behavior_rows(lines.select(*keep, row.alias("_row")).select(*keep, "_row.*"), keep)


def read_behavior_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(BEHAVIOR_CSV_SCHEMA).option("mode", "FAILFAST").csv(path)
    return _behavior_rows(raw)


def read_behavior_csv_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BEHAVIOR_CSV_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _behavior_rows(reader.csv(path))


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "line")
