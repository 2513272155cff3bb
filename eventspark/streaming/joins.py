"""Stream-stream interval join.

Both sides carry a watermark; the range condition is stated on the two event-time columns so Spark can evict each
side's state once the other side's watermark has passed the interval.  As in the batch form, the equi key includes a
time bucket one interval wide (each right row is sent to the at most two left buckets it can match), so a hot key's
rows and state are spread over partitions by time instead of sitting in one.  Window joins need no twin:
:func:`eventspark.operators.joins.window_join` runs on streams as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import interval, to_micros


def interval_join_stream(left: DataFrame, right: DataFrame, *, key: str, ts: str = "ts", lower: str = "-10 minutes",
                         upper: str = "0 seconds", left_cols=("event_id",), right_cols=("event_id",)) -> DataFrame:
    lo, hi = to_micros(lower), to_micros(upper)
    if hi < lo:
        raise ValueError("upper must be >= lower")
    width = max(hi - lo, 1)
    l_us = F.unix_micros(F.col(ts))
    ls = left.select(F.col(key).alias("_lk"), F.col(ts).alias("left_ts"),
                     *[F.col(c).alias(f"left_{c}") for c in left_cols], F.floor(l_us / width).alias("_lb"))
    rs = right.select(F.col(key).alias("_rk"), F.col(ts).alias("right_ts"),
                      *[F.col(c).alias(f"right_{c}") for c in right_cols],
                      F.explode(F.sequence(F.floor((l_us - hi) / width), F.floor((l_us - lo) / width))).alias("_rb"))
    cond = ((F.col("_lk") == F.col("_rk")) & (F.col("_lb") == F.col("_rb"))
            & (F.col("right_ts") >= F.col("left_ts") + interval(lower))
            & (F.col("right_ts") <= F.col("left_ts") + interval(upper)))
    j = ls.join(rs, cond)
    return j.select(F.col("_lk").alias(key), "left_ts", *[f"left_{c}" for c in left_cols],
                    "right_ts", *[f"right_{c}" for c in right_cols])
