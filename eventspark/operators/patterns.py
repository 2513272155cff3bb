"""Strictly consecutive event patterns per key (``begin().where().next().where()…within()``).

A pattern of n steps matches at row r when rows r, r+1, …, r+n-1 of the key (in ``(ts, id)`` order) satisfy the
step predicates and the last is less than ``within`` after the first.  Overlapping matches are all reported.
Neighbouring rows come from :func:`~eventspark.operators.scan.with_neighbors` (skew-safe positions + unique-key
joins) instead of ``lead`` over a single-key window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from .scan import with_neighbors


def _us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def match_consecutive(df: DataFrame, *, key: str, steps: Sequence[Callable[[Callable[[str], Column]], Column]],
                      within: str, cols: Sequence[str], order=("ts", "event_id")) -> DataFrame:
    """Rows where the ``len(steps)`` consecutive rows starting there match.

    Each step is a function of an accessor ``get(col)`` that returns that step's row column.  The result keeps the
    first row's columns plus ``{col}_{i}`` for step i ≥ 1.
    """
    n = len(steps)
    need = sorted(set(cols) | {"ts"})
    nb = with_neighbors(df, key=key, order=list(order), offsets=list(range(1, n)), cols=need)
    cond = F.lit(True)
    for i, step in enumerate(steps):
        cond = cond & step(lambda c, i=i: F.col(c) if i == 0 else F.col(f"{c}_{i}"))
    last_ts = F.col(f"ts_{n - 1}") if n > 1 else F.col("ts")
    cond = cond & (_us(last_ts) - _us(F.col("ts")) < F.lit(to_micros(within)))
    return nb.where(cond)


def login_fail_3(logins: DataFrame, *, within: str = "5 seconds") -> DataFrame:
    """Three consecutive failed logins of a user within ``within`` → ``(user_id, ip1, ip2, ip3)``."""
    fail = lambda get: get("event_type") == "fail"
    m = match_consecutive(logins, key="user_id", steps=[fail, fail, fail], within=within,
                          cols=["event_type", "ip_address", "event_id"])
    return m.select("user_id", F.col("ip_address").alias("ip1"), F.col("ip_address_1").alias("ip2"),
                    F.col("ip_address_2").alias("ip3"), F.col("ts").alias("first_ts"), F.col("ts_2").alias("last_ts"),
                    F.col("event_id").alias("first_event_id"))


def order_timeout_pattern(orders: DataFrame, *, within: str = "5 seconds") -> DataFrame:
    """``create`` strictly followed by ``pay`` within ``within`` → ``payed``; a create whose successor is absent or not
    earlier than ``create + within`` → ``timeout`` at ``create + within``; a create followed in time by any other
    event is a broken partial match and is dropped."""
    nb = with_neighbors(orders, key="order_id", order=["ts", "event_id"], offsets=[1],
                        cols=["order_type", "ts", "event_id"])
    w = to_micros(within)
    dt = _us(F.col("ts_1")) - _us(F.col("ts"))
    payed = F.coalesce((F.col("order_type_1") == "pay") & (dt < w), F.lit(False))
    timeout = F.col("ts_1").isNull() | (dt >= w)
    res = (nb.where((F.col("order_type") == "create") & (payed | timeout))
           .select("order_id", F.col("ts").alias("create_ts"), F.col("event_id").alias("create_event_id"),
                   F.when(payed, F.lit("payed")).otherwise(F.lit("timeout")).alias("result"),
                   F.when(payed, F.col("ts_1")).alias("pay_ts"),
                   F.when(payed, F.col("event_id_1")).alias("pay_event_id"),
                   F.when(~payed, F.col("ts") + F.make_dt_interval(secs=F.lit(w / 1e6))).alias("timeout_ts")))
    return res
