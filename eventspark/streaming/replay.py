"""Late-data side outputs on streams, by replaying each micro-batch in arrival order.

Spark drops rows older than the watermark before any stateful operator and only counts them, and it filters with
the previous batch's watermark; a late-row *side output* therefore cannot come from ``withWatermark``.  Instead the
stream carries no watermark on this path and ``foreachBatch`` applies the batch replay operators
(:mod:`eventspark.operators.replay`) to every micro-batch: rows of a batch arrive after all rows of earlier batches,
in ``(arrival, event_id)`` order within the batch, and the running max event time of all earlier batches is carried
in.  The carry is one row, versioned by batch id under the checkpoint folder and written after the batch's outputs; a
replayed batch id reads the version before its own, so a re-run after a failure gives the same split (outputs must be
written idempotently per batch id, e.g. overwrite of a ``batch_id`` partition).  Only the last two versions are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import replay
from ..operators.chains import _join_ns
from .versions import version_before, write_version

CARRY_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("max_us", T.LongType())])


def _carried(spark, carry_path: str, batch_id: int):
    """The row that the batch before left, or None."""
    got = version_before(spark, carry_path, batch_id)
    return None if got is None else got.first()


def _carry(spark, row: tuple, schema: T.StructType, carry_path: str, batch_id: int) -> None:
    write_version(spark.createDataFrame([row], schema).coalesce(1), carry_path, batch_id)


def _carry_before(spark, carry_path: str, batch_id: int) -> int | None:
    got = _carried(spark, carry_path, batch_id)
    return None if got is None else got["max_us"]


def replay_batches(transform: Callable[[DataFrame, int | None], DataFrame],
                   write: Callable[[DataFrame, int], None], carry_path: str, ts: str = "ts"
                   ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: ``write(transform(batch, carried_max_us), batch_id)``, then store the new carry."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = _carry_before(spark, carry_path, batch_id)
        write(transform(batch, carry), batch_id)
        batch_max = batch.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("m")).first()["m"]
        known = [x for x in (carry, batch_max) if x is not None]
        _carry(spark, (int(batch_id), max(known) if known else None), CARRY_SCHEMA, carry_path, batch_id)

    return handle


def late_row_split_handler(write: Callable[[DataFrame, int], None], carry_path: str, *, bound: str = "0 seconds"):
    return replay_batches(lambda b, c: replay.late_row_split(b, bound=bound, initial_max_us=c), write, carry_path)


def window_lateness_handler(write: Callable[[DataFrame, int], None], carry_path: str, *, key: str = "key",
                            size: str = "5 seconds", bound: str = "0 seconds"):
    return replay_batches(lambda b, c: replay.window_lateness(b, key=key, size=size, bound=bound, initial_max_us=c),
                          write, carry_path)


def watermark_trace_handler(write: Callable[[DataFrame, int], None], carry_path: str, *, bound: str = "10 seconds"):
    return replay_batches(lambda b, c: replay.watermark_trace(b, bound=bound, initial_max_us=c), write, carry_path)


LEVEL_CARRY_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("ts_us", T.LongType()),
                                   T.StructField("event_id", T.LongType()), T.StructField("level", T.StringType())])


def smoke_alerts_handler(write: Callable[[DataFrame, int], None], carry_path: str,
                         split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], *, threshold: float = -100.0):
    """``foreachBatch`` handler for the global control gate: each batch is gated with the level carried from the
    latest control row of earlier batches (one row).  Batches must arrive in time order, as the
    ascending-timestamp sources of this operator do."""
    from ..operators import control

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        readings, levels = split(batch)
        prev = _carried(spark, carry_path, batch_id)
        write(control.smoke_alerts(readings, levels, threshold=threshold, initial_level=prev["level"] if prev else None), batch_id)
        last = (levels.where(F.col("level").isNotNull())
                .select(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "level")
                .orderBy(F.desc("ts_us"), F.desc("event_id")).limit(1).collect())
        known = [tuple(r) for r in last] + ([tuple(prev)[1:]] if prev and prev["level"] is not None else [])
        row = max(known, key=lambda r: r[:2]) if known else (None, None, None)
        _carry(spark, (int(batch_id), *row), LEVEL_CARRY_SCHEMA, carry_path, batch_id)

    return handle


def allowed_lateness_handler(write: Callable[[DataFrame, int], None], carry_path: str, state_path: str, *,
                             key: str = "key", size: str = "5 seconds", bound: str = "5 seconds",
                             lateness: str = "5 seconds"):
    """``foreachBatch`` handler of allowed lateness: the firings of
    :func:`eventspark.operators.replay.allowed_lateness`, emitted as they happen.

    Per window the handler keeps ``n0`` (rows on time), ``nu`` (late updates so far) and ``fired``, versioned by batch
    id under ``state_path`` (a re-run batch reads the version before it).  A window's first firing is emitted in the
    batch where the running max passes its end; each late update row re-fires it with the count so far.  Windows past
    ``end + lateness`` are dropped from the state (every later row for them is dropped)."""
    from ..functions.durations import to_micros
    from ..operators.scan import prefix_scan

    kw = [key, "window_start", "window_end"]
    b_us, l_us = to_micros(bound), to_micros(lateness)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = _carry_before(spark, carry_path, batch_id)
        c = replay._classify(batch, key=key, size=size, bound=bound, lateness=lateness, initial_max_us=carry).cache()
        try:
            batch_max = batch.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("m")).first()["m"]
            known = [x for x in (carry, batch_max) if x is not None]
            new_max = max(known) if known else None
            prev = version_before(spark, state_path, batch_id)
            on_b = c.where(F.col("class") == "on_time").groupBy(*kw).agg(F.count(F.lit(1)).alias("_n0b"))
            upd = c.where(F.col("class") == "update").withColumn("_kw", F.struct(*kw))
            upd = prefix_scan(upd, key="_kw", order=replay.ORDER, values=[("_u", F.lit(1).cast("bigint"), "sum")])
            nub = upd.groupBy(*kw).agg(F.count(F.lit(1)).alias("_nub"))
            if prev is None:
                prev = on_b.select(*kw).limit(0).select(*kw, F.lit(0).cast("bigint").alias("n0"),
                                                     F.lit(0).cast("bigint").alias("nu"), F.lit(False).alias("fired"))
            # summed, not joined, so that NULL keys meet
            zero, no = F.lit(0).cast("bigint"), F.lit(False)
            parts = (prev.select(*kw, "n0", F.col("nu").alias("_nu_prev"), zero.alias("_nub"), F.col("fired").alias("_fired"))
                     .unionByName(on_b.select(*kw, F.col("_n0b").alias("n0"), zero.alias("_nu_prev"), zero.alias("_nub"),
                                              no.alias("_fired")))
                     .unionByName(nub.select(*kw, zero.alias("n0"), zero.alias("_nu_prev"), "_nub", no.alias("_fired"))))
            merged = parts.groupBy(*kw).agg(F.sum("n0").alias("n0"), F.sum("_nu_prev").alias("_nu_prev"),
                                            F.sum("_nub").alias("_nub"), F.max("_fired").alias("_fired_prev"))
            ends_us = F.unix_micros(F.col("window_end").cast("timestamp"))
            passed = ends_us <= F.lit(new_max - b_us) if new_max is not None else F.lit(False)
            firsts = merged.where(~F.col("_fired_prev") & passed & (F.col("n0") > 0)).select(
                *kw, F.lit(1).cast("bigint").alias("firing"), F.lit("first").alias("kind"), F.col("n0").alias("cnt"))
            n = _join_ns(upd, merged.select(*kw, "n0", "_nu_prev"), kw)
            fire_no = (F.when(F.col("n0") > 0, 1).otherwise(0) + F.col("_nu_prev") + F.col("_u")).cast("bigint")
            updates = n.select(*kw, fire_no.alias("firing"),
                               F.when(fire_no == 1, F.lit("first")).otherwise(F.lit("update")).alias("kind"),
                               (F.col("n0") + F.col("_nu_prev") + F.col("_u")).alias("cnt"))
            write(firsts.unionByName(updates), batch_id)
            keep = (ends_us + F.lit(l_us) > F.lit(new_max - b_us)) if new_max is not None else F.lit(True)
            write_version(merged.where(keep).select(
                *kw, "n0", (F.col("_nu_prev") + F.col("_nub")).alias("nu"), (F.col("_fired_prev") | passed).alias("fired")),
                state_path, batch_id)
            _carry(spark, (int(batch_id), new_max), CARRY_SCHEMA, carry_path, batch_id)
        finally:
            c.unpersist()

    return handle


PAIR_CARRY_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("max_a", T.LongType()),
                                  T.StructField("max_b", T.LongType())])


def union_watermark_handler(write: Callable[[DataFrame, int], None], carry_path: str,
                            split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], *, bound: str = "0 seconds"):
    """``foreachBatch`` handler of the union watermark trace: both inputs' running maxima are carried per batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = _carried(spark, carry_path, batch_id)
        ca, cb = (prev["max_a"], prev["max_b"]) if prev else (None, None)
        a, b = split(batch)
        write(replay.union_watermark_trace(a, b, bound=bound, initial_max_a_us=ca, initial_max_b_us=cb), batch_id)
        mx = lambda d: d.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("m")).first()["m"]
        na = [x for x in (ca, mx(a)) if x is not None]
        nb = [x for x in (cb, mx(b)) if x is not None]
        _carry(spark, (int(batch_id), max(na) if na else None, max(nb) if nb else None), PAIR_CARRY_SCHEMA, carry_path, batch_id)

    return handle
