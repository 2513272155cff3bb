"""Typed views of the reference's record kinds over the synthetic ``events`` and ``documents`` tables.

Each function is a pure projection/filter of its input, so Catalyst pushes the filters (``event_type = ...``) into the
Parquet scan and prunes unused columns.  Every view keeps ``event_id`` as a unique tie-breaker for orderings.
The SQL oracle in ``__spark_entry__`` spells the same definitions in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Arrival jitter used to build out-of-order replays: arrival = ts + ((event_id * 7919) % 7200) seconds.
JITTER_PRIME = 7919
JITTER_RANGE_S = 7200


def prop_k(props: str | Column = "props") -> Column:
    """The integer ``k`` inside the ``props`` JSON text."""
    return F.get_json_object(F.col(props) if isinstance(props, str) else props, "$.k").cast("bigint")


def readings(events: DataFrame) -> DataFrame:
    """SensorReading: ``id, ts, temperature`` (+ ``event_id``)."""
    return events.select(F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
                         "ts", F.col("value").alias("temperature"), "event_id")


def behaviors(events: DataFrame, only: str | None = None) -> DataFrame:
    """UserBehavior: ``user_id, item_id, category_id, behavior, ts`` (+ ``event_id``); views are ``pv``.

    ``only`` keeps one behaviour; the predicate is stated on ``event_type`` so that it reaches the Parquet scan
    (a filter on the derived ``behavior`` column could not be pushed).
    """
    if only is not None:
        sources = ["view", "pv"] if only == "pv" else ([] if only == "view" else [only])
        events = events.where(F.col("event_type").isin(*sources)) if sources else events.where(F.lit(False))
    return events.select("user_id", prop_k().alias("item_id"), F.col("event_type").alias("category_id"),
                         F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type"))
                         .alias("behavior"),
                         "ts", "event_id")


def logins(events: DataFrame) -> DataFrame:
    """LoginEvent: errors are ``fail``, everything else ``success``."""
    return events.select(F.col("user_id").alias("user_id"),
                         F.concat(F.lit("10.0.0."), prop_k().cast("string")).alias("ip_address"),
                         F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success"))
                         .alias("event_type"),
                         "ts", "event_id")


def order_id_col() -> Column:
    return F.concat(F.lit("order_"), F.col("user_id").cast("string"))


def order_events(events: DataFrame) -> DataFrame:
    """OrderEvent: signups are ``create``, purchases are ``pay``; other event types are dropped."""
    return (events.where(F.col("event_type").isin("signup", "purchase"))
            .select(order_id_col().alias("order_id"),
                    F.when(F.col("event_type") == "signup", F.lit("create")).otherwise(F.lit("pay"))
                    .alias("order_type"),
                    "ts", "event_id"))


def pay_events(events: DataFrame) -> DataFrame:
    """PayEvent: purchases with a channel derived from ``k``."""
    return (events.where(F.col("event_type") == "purchase")
            .select(order_id_col().alias("order_id"),
                    F.when(prop_k() % 2 == 0, F.lit("weixin")).otherwise(F.lit("alipay")).alias("channel"),
                    "ts", "event_id"))


def smoke_levels(events: DataFrame) -> DataFrame:
    """Control feed: every error event sets the level (``HIGH`` when value > 20)."""
    return (events.where(F.col("event_type") == "error")
            .select("ts", F.when(F.col("value") > 20, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("level"),
                    "event_id"))


def switches(events: DataFrame) -> DataFrame:
    """Gate switches: every signup opens its sensor's gate at ``ts``."""
    return (events.where(F.col("event_type") == "signup")
            .select(F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"), "ts", "event_id"))


def arrivals(events: DataFrame) -> DataFrame:
    """Keyed lines in arrival order: deterministic jitter makes ``arrival`` differ from event time ``ts``."""
    jitter = (F.col("event_id") * JITTER_PRIME) % JITTER_RANGE_S
    return events.select(F.col("event_type").alias("key"), "ts",
                         (F.col("ts") + F.make_dt_interval(secs=jitter.cast("int"))).alias("arrival"),
                         "event_id")


def keyed_lines(events: DataFrame) -> DataFrame:
    """Text lines ``"key seconds"`` as the line source delivers them (input of ``parse_keyed_lines``)."""
    return events.select("event_id", F.concat_ws(" ", F.col("event_type"),
                                                  F.unix_timestamp(F.col("ts").cast("timestamp"))
                                                  .cast("string")).alias("line"))


def behavior_lines(events: DataFrame) -> DataFrame:
    """The behaviour CSV's lines ``user,item,category,behavior,epoch seconds`` (input of ``parse_behavior_lines``)."""
    b = behaviors(events)
    return b.select("event_id", F.concat_ws(",", "user_id", "item_id", "category_id", "behavior",
                                            F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("line"))


def kafka_records(events: DataFrame) -> DataFrame:
    """Keyed lines in Kafka's record layout, dealt to four partitions."""
    line = F.concat_ws(" ", F.col("event_type"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string"))
    return events.select(F.col("event_type").cast("binary").alias("key"), line.cast("binary").alias("value"),
                         F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                         F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
