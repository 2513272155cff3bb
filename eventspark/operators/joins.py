"""Two-input operators: window join, interval join, one-to-one reconciliation.

* ``window_join`` — equi-join on ``(key, window)``: all pairs of a key inside the same tumbling window.
* ``interval_join`` — ``right.ts`` within ``[left.ts + lower, left.ts + upper]`` of the same key.  A plain equi-join
  on the key would compare every left row of a key with every right row of that key (a hot key is quadratic).
  Instead both sides are cut into time buckets one interval long: each left row has one bucket, each right row is
  sent to the (at most two) left buckets it can match, and the join key becomes ``(key, bucket)``.  Candidate pairs
  are then only rows close in time; the range predicate removes the rest.  Every matching pair meets in exactly one
  bucket, so no pair is lost or duplicated.
* ``reconcile`` — match each left row with at most one right row of the same key within a tolerance (the reference's
  keyed two-state process with timers), reporting unmatched rows of both sides.  Batch form as a chain rule over the
  merged, time-ordered rows of a key (see :func:`reconcile`), computed with skew-safe prefix scans and one unique-key
  join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from .scan import neighbors_in_pieces, prefix_scan


def _plain_time(col: str):
    """The row time as a value: on a stream, only the window stays the event-time column of the join."""
    return F.col(col) + F.make_dt_interval(secs=F.lit(0))


def window_join(left: DataFrame, right: DataFrame, *, key: str, ts: str = "ts", size: str = "5 seconds",
                left_cols=("event_id",), right_cols=("event_id",)) -> DataFrame:
    """All pairs of a key inside the same tumbling window (stream-stream capable: the join key holds the window)."""
    lw = left.select(F.col(key).alias("key"), F.window(ts, size).alias("w"), _plain_time(ts).alias("left_ts"),
                     *[F.col(c).alias(f"left_{c}") for c in left_cols])
    rw = right.select(F.col(key).alias("key"), F.window(ts, size).alias("w"), _plain_time(ts).alias("right_ts"),
                      *[F.col(c).alias(f"right_{c}") for c in right_cols])
    j = lw.join(rw, ["key", "w"])
    return j.select(F.col("key").alias(key), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "left_ts", *[f"left_{c}" for c in left_cols], "right_ts", *[f"right_{c}" for c in right_cols])


def _micros(col):
    return F.unix_micros(F.col(col).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, *, key: str, ts: str = "ts", lower: str = "-10 minutes",
                  upper: str = "0 seconds", left_cols=("event_id",), right_cols=("event_id",)) -> DataFrame:
    """Inner interval join, both bounds inclusive."""
    lo, hi = to_micros(lower), to_micros(upper)
    if hi < lo:
        raise ValueError("upper must be >= lower")
    width = max(hi - lo, 1)
    lsel = left.select(F.col(key).alias("_k"), F.col(ts).alias("left_ts"),
                       *[F.col(c).alias(f"left_{c}") for c in left_cols],
                       F.floor(_micros(ts) / width).alias("_b"))
    # left.ts in [right.ts - hi, right.ts - lo]  →  buckets floor((r - hi)/w) .. floor((r - lo)/w)  (≤ 2 of them)
    r_us = _micros(ts)
    rsel = right.select(F.col(key).alias("_k"), F.col(ts).alias("right_ts"),
                        *[F.col(c).alias(f"right_{c}") for c in right_cols],
                        F.explode(F.sequence(F.floor((r_us - hi) / width), F.floor((r_us - lo) / width))).alias("_b"))
    j = lsel.join(rsel, ["_k", "_b"])
    lts, rts = _micros("left_ts"), _micros("right_ts")
    j = j.where((rts >= lts + F.lit(lo)) & (rts <= lts + F.lit(hi)))
    return j.select(F.col("_k").alias(key), "left_ts", *[f"left_{c}" for c in left_cols],
                    "right_ts", *[f"right_{c}" for c in right_cols])


def interval_join_plain(left: DataFrame, right: DataFrame, *, key: str, ts: str = "ts", lower="-10 minutes",
                        upper="0 seconds", left_cols=("event_id",), right_cols=("event_id",)) -> DataFrame:
    """Un-bucketed form (key equality + range); used by the bucket-equivalence test."""
    lo, hi = to_micros(lower), to_micros(upper)
    ls = left.select(F.col(key).alias("_k"), F.col(ts).alias("left_ts"), *[F.col(c).alias(f"left_{c}") for c in left_cols])
    rs = right.select(F.col(key).alias("_k"), F.col(ts).alias("right_ts"),
                      *[F.col(c).alias(f"right_{c}") for c in right_cols])
    j = ls.join(rs, "_k").where((_micros("right_ts") >= _micros("left_ts") + F.lit(lo))
                                & (_micros("right_ts") <= _micros("left_ts") + F.lit(hi)))
    return j.select(F.col("_k").alias(key), "left_ts", *[f"left_{c}" for c in left_cols],
                    "right_ts", *[f"right_{c}" for c in right_cols])


def reconcile(left: DataFrame, right: DataFrame, *, key: str, ts: str = "ts", id_col: str = "event_id",
              tolerance: str = "5 seconds", left_name: str = "order", right_name: str = "pay") -> DataFrame:
    """One-to-one matching of two streams per key within ``tolerance``; unmatched rows of each side reported.

    Sequential meaning (per key, rows in ``(ts, id)`` order, one pending row at most): a pending row whose
    ``ts + tolerance`` has passed is reported unmatched; a row of the other side matches the pending row; a row of the
    same side replaces it (the replaced row is reported unmatched); the pending row left at the end is unmatched.
    ``Δts <= tolerance`` matches.

    Equivalent chain rule used here: a row *links* to its predecessor when it is of the other side and within
    tolerance; links form chains; inside a chain rows 1-2, 3-4, … match and a trailing odd row is unmatched.
    Output: ``key, tag (matched | unmatched_<left> | unmatched_<right>), <left>_ts, <left>_event_id, <right>_ts, <right>_event_id``.
    """
    tol = to_micros(tolerance)
    both = (left.select(F.col(key).alias("_k"), F.col(ts).alias("_ts"), F.col(id_col).alias("_id"),
                        F.lit(0).alias("_side"))
            .unionByName(right.select(F.col(key).alias("_k"), F.col(ts).alias("_ts"), F.col(id_col).alias("_id"),
                                      F.lit(1).alias("_side"))))
    order = ["_ts", "_id"]
    # pass 1: predecessor's side/time and the row's position within its key
    p1 = prefix_scan(both, key="_k", order=order, inclusive=False, values=[
        ("_before", F.lit(1).cast("bigint"), "sum"),
        ("_prev_side", F.col("_side"), "last"),
        ("_prev_us", _micros("_ts"), "last")]).withColumn("_rn", F.col("_before") + 1)
    linked = p1.withColumn("_link", (F.col("_prev_side").isNotNull() & (F.col("_prev_side") != F.col("_side"))
                                     & (_micros("_ts") - F.col("_prev_us") <= F.lit(tol))))
    linked = linked.select("_k", "_ts", "_id", "_side", "_rn", "_link")
    # pass 2: start position of the chain each row belongs to; odd chain positions open a pair
    p2 = prefix_scan(linked, key="_k", order=order, keep_piece=True, values=[
        ("_chain_start", F.when(~F.col("_link"), F.col("_rn")), "last")])
    pos = p2.withColumn("_odd", ((F.col("_rn") - F.col("_chain_start")) % 2) == 0)
    # the row after an odd row is its partner when it is even (then it is in the same chain); fetched as a neighbour
    # inside the scan's pieces, so no join shuffle
    nb = neighbors_in_pieces(pos, key="_k", order=order, offsets=[1], cols=["_ts", "_id", "_side", "_odd"],
                             rn_col="_rn", keep=["_k", "_rn", "_ts", "_id", "_side", "_odd"])
    partner = F.coalesce(~F.col("_odd_1"), F.lit(False))
    pairs = nb.where(F.col("_odd")).select(
        "_k", "_ts", "_id", "_side", partner.alias("_paired"),
        F.when(partner, F.col("_ts_1")).alias("_pts"), F.when(partner, F.col("_id_1")).alias("_pid_"))
    l_ts = F.when(F.col("_side") == 0, F.col("_ts")).otherwise(F.col("_pts"))
    l_id = F.when(F.col("_side") == 0, F.col("_id")).otherwise(F.col("_pid_"))
    r_ts = F.when(F.col("_side") == 1, F.col("_ts")).otherwise(F.col("_pts"))
    r_id = F.when(F.col("_side") == 1, F.col("_id")).otherwise(F.col("_pid_"))
    tag = (F.when(F.col("_paired"), F.lit("matched"))
           .when(F.col("_side") == 0, F.lit(f"unmatched_{left_name}")).otherwise(F.lit(f"unmatched_{right_name}")))
    return pairs.select(F.col("_k").alias(key), tag.alias("tag"),
                        l_ts.alias(f"{left_name}_ts"), l_id.alias(f"{left_name}_event_id"),
                        r_ts.alias(f"{right_name}_ts"), r_id.alias(f"{right_name}_event_id"))
