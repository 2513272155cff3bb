"""Distinct visitors per window: exact, Bloom bitmap, HLL sketch.

* exact — ``count(DISTINCT user)`` per window: Spark plans it as two aggregates over ``(window, user)`` with partial
  aggregation, so a window with many users is spread over tasks by user, never collected as a set in one task.
* Bloom — the reference sizes a Bloom filter for 1,000,000 ids at 1 % false positives.  Here the filter is a set of bit
  positions: each user sets k positions ``pmod(xxhash64(user, i), m) + 1``; positions are stored in Spark's mergeable
  bitmaps (``bitmap_construct_agg`` per 32 768-bit bucket), the set-bit count X gives the order-independent estimate
  ``-m/k * ln(1 - X/m)``.  Memory per window is bounded by m bits whatever the number of users.
* HLL — ``hll_sketch_agg``/``hll_sketch_estimate`` (mergeable, fixed size).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_seconds

# Fixed sizing of the reference's Bloom filter: 1,000,000 expected ids at 1 % false positives.
BLOOM_EXPECTED = 1_000_000
BLOOM_FPP = 0.01


def bloom_size(expected: int = BLOOM_EXPECTED, fpp: float = BLOOM_FPP) -> tuple[int, int]:
    """Optimal (m bits, k hashes) for the given capacity and false-positive rate."""
    m = int(-expected * math.log(fpp) / (math.log(2) ** 2))
    k = max(1, round(m / expected * math.log(2)))
    return m, k


def _window(df: DataFrame, ts: str, size: str):
    return F.window(F.col(ts), size)


def uv_exact(df: DataFrame, *, user="user_id", ts="ts", size="1 hour") -> DataFrame:
    out = df.groupBy(_window(df, ts, size).alias("w")).agg(F.count_distinct(user).alias("uv"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")


def bloom_bits(df: DataFrame, *, user: str, expected: int, fpp: float) -> DataFrame:
    """``df`` once per bit that its user sets: with ``bucket`` and ``bit``, the place in that bucket's bitmap."""
    m, k = bloom_size(expected, fpp)
    pos = F.explode(F.array(*[F.pmod(F.xxhash64(F.col(user).cast("string"), F.lit(i)), F.lit(m)) + 1 for i in range(k)]))
    bits = df.where(F.col(user).isNotNull()).select("*", pos.alias("_pos"))
    return bits.select("*", F.bitmap_bucket_number("_pos").alias("bucket"), F.bitmap_bit_position("_pos").alias("bit")).drop("_pos")


def bloom_estimate(set_bits: Column, *, expected: int, fpp: float) -> Column:
    """Distinct users by the number of set bits, rounded; a full bitmap counts as one bit short of it."""
    m, k = bloom_size(expected, fpp)
    set_bits = F.least(F.coalesce(set_bits, F.lit(0)), F.lit(m - 1))
    return F.round(-F.lit(m / k) * F.log(F.lit(1.0) - set_bits / F.lit(float(m)))).cast("bigint")


def uv_bloom(df: DataFrame, *, user="user_id", ts="ts", size="1 hour", expected: int = BLOOM_EXPECTED,
             fpp: float = BLOOM_FPP) -> DataFrame:
    """Bloom-bitmap estimate of distinct users per window, rounded to a whole number (``uv``).

    NULL users don't count.  A window's users are made distinct before each sets its ``k`` bits.  A full bitmap gives
    the largest estimate it can state (one bit unset); size it with ``expected``.
    """
    df = df.select(_window(df, ts, size).alias("w"), F.col(user).alias("_user"))
    windows = df.select("w").distinct()
    bits = bloom_bits(df.distinct(), user="_user", expected=expected, fpp=fpp)
    per_bucket = bits.groupBy("w", "bucket").agg(F.bitmap_count(F.bitmap_construct_agg("bit")).alias("x"))
    per_window = per_bucket.groupBy("w").agg(F.sum("x").alias("set_bits"))
    per_window = windows.withColumnRenamed("w", "_w").join(per_window, F.col("_w") == F.col("w"), "left")
    return per_window.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                             bloom_estimate(F.col("set_bits"), expected=expected, fpp=fpp).alias("uv"))


def bloom_bitmaps(df: DataFrame, *, user="user_id", ts="ts", size="1 hour", expected: int = BLOOM_EXPECTED,
                  fpp: float = BLOOM_FPP) -> DataFrame:
    """The filters themselves: ``window_start, window_end, bucket, bitmap`` of every bucket with a set bit.

    One aggregate without a distinct step, since setting a bit twice changes nothing: on a watermarked stream the state is
    one bitmap per window and bucket, into which every batch sets its bits."""
    bits = bloom_bits(df.select(F.col(ts), F.col(user)), user=user, expected=expected, fpp=fpp)
    maps = bits.groupBy(F.window(F.col(ts), size).alias("w"), "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return maps.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bucket", "bitmap")


def uv_hll(df: DataFrame, *, user="user_id", ts="ts", size="1 hour", lg_k: int = 12) -> DataFrame:
    """The sketch's own estimate per window (``uv``); also on watermarked streams."""
    out = df.groupBy(_window(df, ts, size).alias("w")).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col(user), lg_k)).alias("uv"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")


def uv_hll_sliding(df: DataFrame, *, user="user_id", ts="ts", size="1 hour", slide="5 minutes", lg_k: int = 12) -> DataFrame:
    """Estimated distinct users per sliding window (``uv``) from sketch panes.

    Rows are sketched once, in their slide-long pane (combined map-side); only the panes' sketches, a few KB at most each,
    go to the ``size / slide`` windows and are united there.  Distinct counts of panes could not be added up."""
    size_s, slide_s = to_seconds(size), to_seconds(slide)
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    panes = df.groupBy(F.window(F.col(ts), slide).alias("p")).agg(F.hll_sketch_agg(F.col(user), lg_k).alias("s"))
    spread = panes.select("s", F.explode(F.sequence(
        F.col("p.end"), F.col("p.start") + F.make_dt_interval(secs=F.lit(size_s)),
        F.make_dt_interval(secs=F.lit(slide_s)))).alias("window_end"))
    out = spread.groupBy("window_end").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("uv"))
    return out.select((F.col("window_end") - F.make_dt_interval(secs=F.lit(size_s))).alias("window_start"), "window_end", "uv")


# Fixed values of the UV report text (must equal the reference's output format; ``hh`` is the 12-hour clock).
UV_REPORT_PREFIX = "window end: "
UV_REPORT_TIME_PATTERN = "yyyy-MM-dd hh:mm:ss"
UV_REPORT_COUNT = " uv count: "


def uv_report(uv: DataFrame) -> DataFrame:
    """``window end: yyyy-MM-dd hh:mm:ss uv count: N`` (12-hour clock, as in the reference; zone UTC)."""
    return uv.select("window_end", "uv", F.concat(F.lit(UV_REPORT_PREFIX),
                                                  F.date_format("window_end", UV_REPORT_TIME_PATTERN),
                                                  F.lit(UV_REPORT_COUNT), F.col("uv").cast("string")).alias("report"))
