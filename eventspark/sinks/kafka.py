"""Kafka source/sink as Spark's own ``kafka`` format (needs the spark-sql-kafka package on the cluster).

The record decode/encode steps are plain column expressions, so they are testable on a static frame with Kafka's
column layout (``key, value binary, topic, partition, offset, timestamp``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def decode_strings(records: DataFrame) -> DataFrame:
    """Record value (and key) as UTF-8 text."""
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          "topic", "partition", "offset", "timestamp")


def encode_strings(df: DataFrame, value_col: str, key_col: str | None = None) -> DataFrame:
    cols = [F.col(value_col).cast("string").cast("binary").alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").cast("binary").alias("key"))
    return df.select(*cols)


def read_kafka(spark: SparkSession, *, servers: str, topic: str, starting_offsets: str = "latest",
               options: dict | None = None) -> DataFrame:
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return decode_strings(reader.load())


def write_kafka(df: DataFrame, *, servers: str, topic: str, checkpoint: str, source_topic: str | None = None,
                value_col: str = "value", key_col: str | None = None):
    """Start a streaming write of strings to ``topic``.  Writing back to the topic being read is refused (it would
    feed the job its own output)."""
    if source_topic is not None and source_topic == topic:
        raise ValueError("output topic must differ from the input topic")
    return (encode_strings(df, value_col, key_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
