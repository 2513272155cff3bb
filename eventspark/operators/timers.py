"""Keyed state + event-time timers, replayed over bounded input.

* ``event_timers`` — every event schedules a reminder at ``ts + delay``; a key fires once per distinct time.  This is
  a ``DISTINCT`` and needs no state at all.
* ``temp_rise_alerts``, ``periodic_counts``, ``order_timeout_state`` — greedy, re-arming timers whose next state
  depends on the previous firing, which no window expression states.  All keys, at every size, go through the parallel
  chains of :mod:`eventspark.operators.chains`: DataFrame operations only, keys of any type, NULL keys one group.

The :class:`FoldSpec` state machines state the same rules row by row; the streaming twins run them, and the tests hold
the chains against them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durations import interval, to_micros
from . import chains


def event_timers(df: DataFrame, *, key: str = "key", ts: str = "ts", delay: str = "10 seconds") -> DataFrame:
    return df.select(key, (F.col(ts) + interval(delay)).alias("timer_ts")).distinct()


class Fifo:
    """A queue of whole numbers: its first and its last can be seen."""

    def __init__(self):
        self.items = deque()

    def __len__(self) -> int:
        return len(self.items)

    @property
    def first(self) -> int:
        return self.items[0]

    @property
    def last(self) -> int:
        return self.items[-1]

    def append(self, value: int) -> None:
        self.items.append(value)

    def popleft(self) -> int:
        return self.items.popleft()


@dataclass(frozen=True)
class FoldSpec:
    """A keyed state machine over time-ordered rows.

    ``columns`` are the row fields handed to ``step`` (the first is the event time in epoch microseconds) and
    ``order`` sorts rows within a key.  ``step(state, row)`` may fire timers that are due before the row and returns
    output tuples (without the key); ``finish(state)`` fires whatever timer is pending and clears it; ``due(state)``
    is the pending timer (microseconds) or None.  Timers fire when time passes them strictly, so a row at exactly the
    timer's time is still seen first.  ``finish`` is due at the end of a key's rows; the streaming fold
    (``eventspark.streaming.stateful``) calls it once the watermark has passed ``due``.  ``queues`` names the entries of
    the state that are a :class:`Fifo` of whole numbers; a stream keeps each element of them in a state cell of its own.
    """
    make: Callable[[], dict]
    step: Callable[[dict, tuple], list]
    finish: Callable[[dict], list]
    due: Callable[[dict], int | None]
    columns: tuple[str, ...]
    order: tuple[str, ...]
    out_fields: tuple[tuple[str, T.DataType], ...]
    queues: tuple[str, ...] = ()

    def out_schema(self, key: str, key_type: T.DataType) -> T.StructType:
        return T.StructType([T.StructField(key, key_type)] + [T.StructField(n, t) for n, t in self.out_fields])


def _us(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def _ts(col: str):
    return F.timestamp_micros(F.col(col)).cast("timestamp_ntz")


def temp_rise_spec(rise_for: str = "1 second") -> FoldSpec:
    """Rise alert: per row, a pending timer earlier than the row fires (and clears) first; then a fall (or the key's
    first row) clears the timer, a rise with no pending timer arms one at ``ts + rise_for``; an equal reading changes
    nothing.  A fall exactly at the timer time cancels it."""
    d = to_micros(rise_for)

    def make():
        return {"prev": None, "timer": None, "first": True}

    def step(s, row):
        ts, temp = row[0], row[1]
        out = []
        if s["timer"] is not None and s["timer"] < ts:
            out.append((s["timer"],))
            s["timer"] = None
        if s["first"]:
            s["first"] = False
        elif temp < s["prev"]:
            s["timer"] = None
        elif temp > s["prev"] and s["timer"] is None:
            s["timer"] = ts + d
        s["prev"] = temp
        return out

    def finish(s):
        out = [(s["timer"],)] if s["timer"] is not None else []
        s["timer"] = None
        return out

    return FoldSpec(make, step, finish, lambda s: s["timer"], ("_ts_us", "temperature", "event_id"),
                    ("_ts_us", "event_id"), (("_alert_us", T.LongType()),))


def temp_rise_alerts(readings: DataFrame, *, key: str = "id", rise_for: str = "1 second") -> DataFrame:
    """Alert when a sensor's temperature has not fallen for ``rise_for`` after it began to rise (rule in
    :func:`temp_rise_spec`).  A pending timer fires at the end of input.  Output ``id, alert_ts``."""
    prepared = (readings.where(F.col("temperature").isNotNull())  # a reading without a value changes nothing
                .select(key, _us("ts").alias("_ts_us"), "temperature", "event_id"))
    out = chains.temp_rise_chain(prepared, key=key, rise_us=to_micros(rise_for))
    return out.select(key, _ts("_alert_us").alias("alert_ts"))


def periodic_counts_spec(period: str = "10 seconds") -> FoldSpec:
    """``period`` after the first reading since the last firing, emit the number of readings so far (cumulative,
    rows with ``ts <= timer``).  The next timer is armed by the first reading after the firing."""
    d = to_micros(period)

    def make():
        return {"timer": None, "n": 0}

    def step(s, row):
        ts = row[0]
        out = []
        if s["timer"] is not None and ts > s["timer"]:
            out.append((s["timer"], s["n"]))
            s["timer"] = None
        if s["timer"] is None:
            s["timer"] = ts + d
        s["n"] += 1
        return out

    def finish(s):
        out = [(s["timer"], s["n"])] if s["timer"] is not None else []
        s["timer"] = None
        return out

    return FoldSpec(make, step, finish, lambda s: s["timer"], ("_ts_us", "event_id"), ("_ts_us", "event_id"),
                    (("_fire_us", T.LongType()), ("cnt", T.LongType())))


def periodic_counts(readings: DataFrame, *, key: str = "id", period: str = "10 seconds") -> DataFrame:
    """Periodic cumulative counts (rule in :func:`periodic_counts_spec`).  Output ``id, fire_ts, cnt``."""
    prepared = readings.select(key, _us("ts").alias("_ts_us"), "event_id")
    out = chains.periodic_counts_chain(prepared, key=key, period_us=to_micros(period))
    return out.select(key, _ts("_fire_us").alias("fire_ts"), "cnt")


def order_timeout_spec(timeout: str = "5 seconds") -> FoldSpec:
    """A ``create`` opens the order until ``create + timeout`` (a second create while open is ignored).  Each ``pay``
    while open → ``payed``; no pay by the deadline → ``not_payed`` at the deadline.  A pay while no order is open is
    ``late_pay`` when a create came before it, else ``orphan_pay``."""
    w = to_micros(timeout)

    def make():
        return {"open": None, "paid": False, "seen": False}

    def expire(s):
        out = [("not_payed", s["open"] + w, s["open"])] if not s["paid"] else []
        s["open"] = None
        return out

    def step(s, row):
        ts, typ = row[0], row[1]
        out = []
        if s["open"] is not None and ts > s["open"] + w:
            out.extend(expire(s))
        if typ == "create":
            if s["open"] is None:
                s["open"], s["paid"], s["seen"] = ts, False, True
        elif typ == "pay":
            if s["open"] is not None:
                out.append(("payed", ts, s["open"]))
                s["paid"] = True
            else:
                out.append(("late_pay" if s["seen"] else "orphan_pay", ts, None))
        return out

    def finish(s):
        return expire(s) if s["open"] is not None else []

    return FoldSpec(make, step, finish, lambda s: None if s["open"] is None else s["open"] + w,
                    ("_ts_us", "order_type", "event_id"), ("_ts_us", "event_id"),
                    (("result", T.StringType()), ("_event_us", T.LongType()), ("_create_us", T.LongType())))


def order_timeout_state(orders: DataFrame, *, key: str = "order_id", timeout: str = "5 seconds") -> DataFrame:
    """Order create → pay within ``timeout`` with keyed state and a timer (rule in :func:`order_timeout_spec`).
    Output ``order_id, result, event_ts, create_ts``."""
    prepared = orders.select(key, _us("ts").alias("_ts_us"), "order_type", "event_id")
    out = chains.order_timeout_chain(prepared, key=key, timeout_us=to_micros(timeout))
    return out.select(key, "result", _ts("_event_us").alias("event_ts"), _ts("_create_us").alias("create_ts"))
