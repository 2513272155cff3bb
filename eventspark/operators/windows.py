"""Event-time window aggregations (tumbling, sliding, un-keyed).

All windows are epoch-aligned, like ``F.window``.  Results are flat: ``window_start`` / ``window_end`` columns instead
of a struct, so they compare directly with SQL.

Plans: every aggregate here is a partial (map-side) + final hash aggregate over ``(window, key)``; no window contents
are ever buffered.  Un-keyed windows (page views per hour) therefore do not funnel into one task: each map task
pre-counts its rows per window and only one small row per (task, window) is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_seconds


def _keys(key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def tumbling_agg(df: DataFrame, ts: str, size: str, key: str | Sequence[str] | None,
                 aggs: Sequence[Column]) -> DataFrame:
    """``GROUP BY key, tumbling window(ts, size)`` with the given aggregate columns."""
    w = F.window(F.col(ts), size)
    out = df.groupBy(*_keys(key), w.alias("w")).agg(*aggs)
    return out.select(*_keys(key), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[c for c in out.columns if c not in (*_keys(key), "w")])


def min_per_window(df: DataFrame, *, key="id", ts="ts", value="temperature", size="5 seconds") -> DataFrame:
    """Per key and tumbling window, the minimum value (keyed reduce)."""
    return tumbling_agg(df, ts, size, key, [F.min(value).alias("min_temp")])


def avg_per_window(df: DataFrame, *, key="id", ts="ts", value="temperature", size="5 seconds",
                   digits: int | None = 6) -> DataFrame:
    """Per key and tumbling window, the average (incremental sum/count accumulator, merged partial→final)."""
    avg = F.avg(value)
    return tumbling_agg(df, ts, size, key, [(F.round(avg, digits) if digits is not None else avg).alias("avg_temp")])


def minmax_per_window(df: DataFrame, *, key="id", ts="ts", value="temperature", size="5 seconds") -> DataFrame:
    """Per key and window: min, max and the window end (true max, also for all-negative windows)."""
    return tumbling_agg(df, ts, size, key, [F.min(value).alias("min_temp"), F.max(value).alias("max_temp")])


def count_per_window(df: DataFrame, *, key="key", ts="ts", size="5 seconds") -> DataFrame:
    """Per key and tumbling window, the row count with window start and end."""
    return tumbling_agg(df, ts, size, key, [F.count(F.lit(1)).alias("cnt")])


def pv_per_window(df: DataFrame, *, ts="ts", size="1 hour", behavior_col="behavior", pv="pv") -> DataFrame:
    """Un-keyed page-view count per tumbling window."""
    return tumbling_agg(df.where(F.col(behavior_col) == pv), ts, size, None, [F.count(F.lit(1)).alias("pv")])


def sliding_count(df: DataFrame, *, key: str, ts="ts", size="1 hour", slide="5 minutes",
                  also: Column | None = None) -> DataFrame:
    """Sliding-window row count per key with pane pre-aggregation.

    Each row belongs to ``size/slide`` windows.  Instead of expanding every row ``size/slide`` times (what
    ``F.window(ts, size, slide)`` does through ``Expand``), rows are first counted per ``(key, pane)`` where a pane is
    one slide long — a map-side-combined aggregate — and only the pane counts are expanded to the windows they belong
    to and summed.  The expansion thus grows with the number of non-empty panes, not with the number of rows.
    Requires ``size`` to be a multiple of ``slide``.  Windows are identified by their end (and start) like
    ``F.window``.  ``also`` adds ``cnt_also``, the count of the rows that meet this condition.
    """
    size_s, slide_s = to_seconds(size), to_seconds(slide)
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    counts = {"cnt": F.count(F.lit(1))} | ({} if also is None else {"cnt_also": F.count_if(also)})
    panes = (df.groupBy(key, F.window(F.col(ts), slide).alias("p"))
             .agg(*[c.alias(name) for name, c in counts.items()]))
    expanded = panes.select(
        key, *counts,
        F.explode(F.sequence(F.col("p.end"), F.col("p.start") + F.make_dt_interval(secs=F.lit(size_s)),
                             F.make_dt_interval(secs=F.lit(slide_s)))).alias("window_end"))
    out = expanded.groupBy(key, "window_end").agg(*[F.sum(name).alias(name) for name in counts])
    return out.select(key, (F.col("window_end") - F.make_dt_interval(secs=F.lit(size_s))).alias("window_start"),
                      "window_end", *counts)


def sliding_count_direct(df: DataFrame, *, key: str, ts="ts", size="1 hour", slide="5 minutes") -> DataFrame:
    """Reference form of :func:`sliding_count` through ``F.window`` (used by the pane-equivalence test)."""
    out = df.groupBy(key, F.window(F.col(ts), size, slide).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return out.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt")
