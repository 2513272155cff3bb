"""Control streams gating data streams: as-of lookups by time.

* ``smoke_alerts`` — a global control feed (smoke level) applies to every reading from its time on; the reading is
  alerted when the latest level at its time is HIGH (LOW before any control row) and its temperature > threshold.
* ``gate_by_switch`` — a keyed control: a switch opens its sensor's gate for a duration; readings pass only while the
  gate is open.  A later switch does not extend an open gate: the earlier switch's close still closes it.

Both are "last non-null control value at or before each data row", computed by merging control and data rows in
time order and running :func:`~eventspark.operators.scan.prefix_scan` with ``last``.  That works for control feeds of
any size (no broadcast of the control side, no range join), and the global form does not funnel all rows into one
task.  At equal times control rows are ordered before data rows (a control row is visible to a reading at the same
time) and gate closes after them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import interval
from .scan import prefix_scan


def smoke_alerts(readings: DataFrame, levels: DataFrame, *, threshold: float = -100.0, default_level: str = "LOW",
                 alert_level: str = "HIGH", initial_level: str | None = None) -> DataFrame:
    """``initial_level`` is the level in force before the first row of ``levels`` (the last level of earlier
    micro-batches on a stream); ``default_level`` applies when there is none."""
    ctrl = levels.select(F.lit(None).cast("string").alias("id"), "ts", F.lit(None).cast("double").alias("temperature"),
                         "event_id", F.col("level"), F.lit(0).alias("_rank"))
    data = readings.select("id", "ts", "temperature", "event_id", F.lit(None).cast("string").alias("level"),
                           F.lit(1).alias("_rank"))
    merged = ctrl.unionByName(data)
    scanned = prefix_scan(merged, order=["ts", "_rank", "event_id"],
                          values=[("_level_now", F.col("level"), "last")])
    return (scanned.where((F.col("_rank") == 1)
                          & (F.coalesce(F.col("_level_now"), F.lit(initial_level), F.lit(default_level)) == alert_level)
                          & (F.col("temperature") > threshold))
            .select("id", "ts", "temperature", "event_id"))


def gate_by_switch(readings: DataFrame, switches: DataFrame, *, duration: str = "10 seconds",
                   key: str = "id") -> DataFrame:
    opens = switches.select(key, "ts", F.lit(None).cast("double").alias("temperature"), "event_id",
                            F.lit(True).alias("_open"), F.lit(0).alias("_rank"))
    closes = switches.select(key, (F.col("ts") + interval(duration)).alias("ts"),
                             F.lit(None).cast("double").alias("temperature"), "event_id",
                             F.lit(False).alias("_open"), F.lit(2).alias("_rank"))
    data = readings.select(key, "ts", "temperature", "event_id", F.lit(None).cast("boolean").alias("_open"),
                           F.lit(1).alias("_rank"))
    merged = opens.unionByName(closes).unionByName(data)
    scanned = prefix_scan(merged, key=key, order=["ts", "_rank", "event_id"],
                          values=[("_gate", F.col("_open"), "last")])
    return scanned.where((F.col("_rank") == 1) & F.coalesce(F.col("_gate"), F.lit(False))).select(
        key, "ts", "temperature", "event_id")
