"""Order-sensitive keyed operators on streams: one ``transformWithStateInPandas`` processor for every fold.

A :class:`~eventspark.operators.timers.FoldSpec` states an operator as a step function over a key's rows in time
order plus a pending timer.  On a stream the rows of a key arrive in micro-batches, possibly out of order, so the
processor keeps per key

* ``rows`` (map state) — rows not yet final, by the millisecond of their event time, each with a timer at its end;
* ``fold`` (value state) — the step function's state (a small dict, stored as JSON), and
* one map state per queue of that state, from a running number to the element: the JSON holds the queue's ends only.

Arriving rows go into their millisecond's cell.  When the watermark passes it, Spark calls the timers in time order:
the cell's rows are fed to ``step`` in ``order``, then the spec's pending timer fires if it is due by then.  Rows older
than the watermark can no longer be joined by earlier rows (Spark drops rows older than the watermark before the
processor), so the output equals the batch fold over the same rows once the watermark has passed them — the parity tests
check exactly that.

A row costs the same however many rows and timers its key has pending.  State per key is the fold state plus the rows of
the last ``delay`` of event time: bounded by the watermark delay, not by the key's history.  A key's rows still go to one
task per micro-batch, which is what keyed state means.

The batch twins use window functions and prefix scans (:mod:`eventspark.operators.joins`, ``control``, ``patterns``);
the specs below restate those operators as folds for streams.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.durations import to_micros
from ..operators.timers import Fifo, FoldSpec


class StateQueue:
    """The interface of :class:`~eventspark.operators.timers.Fifo` over a map state: one cell per element."""

    def __init__(self, cells, head: int = 0, tail: int = 0):
        self.cells, self.head, self.tail = cells, head, tail

    def __len__(self) -> int:
        return self.tail - self.head

    @property
    def first(self) -> int:
        return self.cells.getValue((self.head,))[0]

    @property
    def last(self) -> int:
        return self.cells.getValue((self.tail - 1,))[0]

    def append(self, value: int) -> None:
        self.cells.updateValue((self.tail,), (value,))
        self.tail += 1

    def popleft(self) -> int:
        value = self.first
        self.cells.removeKey((self.head,))
        self.head += 1
        return value


_LONG = T.StructType([T.StructField("v", T.LongType())])


class FoldProcessor(StatefulProcessor):
    def __init__(self, spec: FoldSpec, row_schema: T.StructType, out_names: list[str], positions: list[int]):
        self.spec = spec
        self.positions = positions
        self.row_schema = row_schema
        self.out_names = out_names
        self.order_idx = [spec.columns.index(c) for c in spec.order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", T.StructType([T.StructField("s", T.StringType())]))
        self.rows = handle.getMapState("rows", _LONG, T.StructType([T.StructField("r", T.ArrayType(self.row_schema))]))
        self.queues = {q: handle.getMapState(f"queue_{q}", _LONG, _LONG) for q in self.spec.queues}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, list] = {}
        for pdf in rows:
            # by position: computed input columns may reach the worker under positional names
            for r in zip(*[pdf.iloc[:, i].tolist() for i in self.positions], strict=True):
                new.setdefault(r[0] // 1000, []).append(r)
        for ms, own in new.items():
            if self.rows.containsKey((ms,)):
                own = [tuple(r) for r in self.rows.getValue((ms,))[0]] + own
            else:
                self.handle.registerTimer(ms + 1)
            self.rows.updateValue((ms,), (own,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()  # all earlier times are final
        spec, out = self.spec, []
        state = self._load()
        if self.rows.containsKey((at - 1,)):
            for r in sorted((tuple(r) for r in self.rows.getValue((at - 1,))[0]),
                            key=lambda r: tuple(r[i] for i in self.order_idx)):
                out.extend(spec.step(state, r))
            self.rows.removeKey((at - 1,))
        while (d := spec.due(state)) is not None and d < at * 1000:
            out.extend(spec.finish(state))
        if d is not None:
            self.handle.registerTimer(d // 1000 + 1)
        self._save(state)
        if out:
            yield pd.DataFrame([(*key, *o) for o in out], columns=self.out_names)

    def _load(self) -> dict:
        if not self.fold.exists():
            state = self.spec.make()
            return state | {q: StateQueue(cells) for q, cells in self.queues.items()}
        state = json.loads(self.fold.get()[0])
        return state | {q: StateQueue(cells, *state[q]) for q, cells in self.queues.items()}

    def _save(self, state: dict) -> None:
        self.fold.update((json.dumps(state | {q: (state[q].head, state[q].tail) for q in self.queues}),))

    def close(self) -> None:
        pass


def stream_fold(df: DataFrame, spec: FoldSpec, *, key: str) -> DataFrame:
    """Run ``spec`` per ``key`` over a watermarked stream.  ``df`` holds ``key`` and ``spec.columns`` (event time in
    epoch microseconds first) plus the watermarked event-time column."""
    row_schema = T.StructType([df.schema[c] for c in spec.columns])
    out_schema = spec.out_schema(key, df.schema[key].dataType)
    proc = FoldProcessor(spec, row_schema, [f.name for f in out_schema.fields],
                         [df.columns.index(c) for c in spec.columns])
    return df.groupBy(key).transformWithStateInPandas(proc, out_schema, "Append", "EventTime")


def us(col: str = "ts"):
    return F.unix_micros(F.col(col).cast("timestamp"))


def ts_of(col: str):
    return F.timestamp_micros(F.col(col)).cast("timestamp_ntz")


# --- specs of operators whose batch form is not a fold ---------------------------------------------------------------

def reconcile_spec(tolerance: str = "5 seconds", left_name: str = "order", right_name: str = "pay") -> FoldSpec:
    """One pending row per key: a pending row older than ``tolerance`` is unmatched; a row of the other side matches
    it; a row of the same side replaces it (the replaced row is unmatched).  Rows ``(ts_us, side 0|1, id)``."""
    tol = to_micros(tolerance)

    def side_row(r):
        return (r[0], r[2]) if r[1] == 0 else (None, None)

    def other_row(r):
        return (r[0], r[2]) if r[1] == 1 else (None, None)

    def unmatched(p):
        return (f"unmatched_{left_name}" if p[1] == 0 else f"unmatched_{right_name}", *side_row(p), *other_row(p))

    def step(s, r):
        out, p = [], s["p"]
        if p is not None and p[0] + tol < r[0]:
            out.append(unmatched(p))
            p = None
        if p is None:
            p = list(r)
        elif p[1] != r[1]:
            left, right = (p, r) if p[1] == 0 else (r, p)
            out.append(("matched", left[0], left[2], right[0], right[2]))
            p = None
        else:
            out.append(unmatched(p))
            p = list(r)
        s["p"] = p
        return out

    def finish(s):
        out = [unmatched(s["p"])] if s["p"] is not None else []
        s["p"] = None
        return out

    return FoldSpec(lambda: {"p": None}, step, finish, lambda s: None if s["p"] is None else s["p"][0] + tol,
                    ("_ts_us", "_side", "event_id"), ("_ts_us", "event_id"),
                    (("tag", T.StringType()), (f"_{left_name}_us", T.LongType()),
                     (f"{left_name}_event_id", T.LongType()), (f"_{right_name}_us", T.LongType()),
                     (f"{right_name}_event_id", T.LongType())))


def switch_gate_spec(duration: str = "10 seconds") -> FoldSpec:
    """Switch rows (``_rank`` 0) open the gate and schedule a close at ``ts + duration``; readings (``_rank`` 1) pass
    while the gate is open.  A later switch does not extend an open gate: every scheduled close closes it."""
    d = to_micros(duration)

    def close_before(s, t):
        while s["closes"] and s["closes"].first < t:
            s["closes"].popleft()
            s["gate"] = False

    def step(s, r):
        ts, rank, eid, temp = r
        close_before(s, ts)
        if rank == 0:
            s["gate"] = True
            s["closes"].append(ts + d)  # rows come in time order, so the queue is sorted
            return []
        return [(ts, temp, eid)] if s["gate"] else []

    def finish(s):
        if s["closes"]:
            s["closes"].popleft()
            s["gate"] = False
        return []

    return FoldSpec(lambda: {"gate": False, "closes": Fifo()}, step, finish,
                    lambda s: s["closes"].first if s["closes"] else None,
                    ("_ts_us", "_rank", "event_id", "temperature"), ("_ts_us", "_rank", "event_id"),
                    (("_ts_out", T.LongType()), ("temperature", T.DoubleType()), ("event_id", T.LongType())), ("closes",))


def smoke_gate_spec(threshold: float = -100.0, default_level: str = "LOW", alert_level: str = "HIGH") -> FoldSpec:
    """Control rows (``_rank`` 0) set the level; readings (``_rank`` 1) above ``threshold`` pass while it is
    ``alert_level``.  A control row without a level changes nothing."""
    def step(s, r):
        ts, rank, eid, key, temp, level = r
        if rank == 0:
            s["level"] = s["level"] if level is None else level
            return []
        passes = s["level"] == alert_level and temp is not None and (temp > threshold or temp != temp)
        return [(key, ts, temp, eid)] if passes else []

    return FoldSpec(lambda: {"level": default_level}, step, lambda s: [], lambda s: None,
                    ("_ts_us", "_rank", "event_id", "id", "temperature", "level"), ("_ts_us", "_rank", "event_id"),
                    (("id", T.StringType()), ("_ts_out", T.LongType()), ("temperature", T.DoubleType()),
                     ("event_id", T.LongType())))


def login_fail_spec(within: str = "5 seconds", n: int = 3) -> FoldSpec:
    """``n`` strictly consecutive ``fail`` rows of a key spanning less than ``within``."""
    w = to_micros(within)

    def step(s, r):
        last = s["last"] + [list(r)]
        s["last"] = last[-(n - 1):] if n > 1 else []
        if len(last) == n and all(x[1] == "fail" for x in last) and last[-1][0] - last[0][0] < w:
            return [(*[x[2] for x in last], last[0][0], last[-1][0], last[0][3])]
        return []

    return FoldSpec(lambda: {"last": []}, step, lambda s: [], lambda s: None,
                    ("_ts_us", "event_type", "ip_address", "event_id"), ("_ts_us", "event_id"),
                    tuple((f"ip{i + 1}", T.StringType()) for i in range(n))
                    + (("_first_us", T.LongType()), ("_last_us", T.LongType()), ("first_event_id", T.LongType())))


def order_pattern_spec(within: str = "5 seconds") -> FoldSpec:
    """``create`` strictly followed by ``pay`` less than ``within`` later → payed; a create whose next row is at or
    after ``create + within`` (or that has none) → timeout; any other next row discards the partial match."""
    w = to_micros(within)

    def timeout(p):
        return ("timeout", p[0], p[1], None, None, p[0] + w)

    def step(s, r):
        ts, typ, eid = r
        out, p = [], s["p"]
        if p is not None:
            dt = ts - p[0]
            if typ == "pay" and dt < w:
                out.append(("payed", p[0], p[1], ts, eid, None))
            elif dt >= w:
                out.append(timeout(p))
        s["p"] = [ts, eid] if typ == "create" else None
        return out

    def finish(s):
        out = [timeout(s["p"])] if s["p"] is not None else []
        s["p"] = None
        return out

    return FoldSpec(lambda: {"p": None}, step, finish, lambda s: None if s["p"] is None else s["p"][0] + w,
                    ("_ts_us", "order_type", "event_id"), ("_ts_us", "event_id"),
                    (("result", T.StringType()), ("_create_us", T.LongType()), ("create_event_id", T.LongType()),
                     ("_pay_us", T.LongType()), ("pay_event_id", T.LongType()), ("_timeout_us", T.LongType())))


# --- stream operators with the batch operators' output columns --------------------------------------------------------

def temp_rise_alerts_stream(readings: DataFrame, *, key: str = "id", rise_for: str = "1 second") -> DataFrame:
    from ..operators.timers import temp_rise_spec
    prepared = (readings.where(F.col("temperature").isNotNull())  # a reading without a value changes nothing
                .select(key, "ts", us().alias("_ts_us"), "temperature", "event_id"))
    return stream_fold(prepared, temp_rise_spec(rise_for), key=key).select(key, ts_of("_alert_us").alias("alert_ts"))


def periodic_counts_stream(readings: DataFrame, *, key: str = "id", period: str = "10 seconds") -> DataFrame:
    from ..operators.timers import periodic_counts_spec
    prepared = readings.select(key, "ts", us().alias("_ts_us"), "event_id")
    return stream_fold(prepared, periodic_counts_spec(period), key=key).select(
        key, ts_of("_fire_us").alias("fire_ts"), "cnt")


def order_timeout_state_stream(orders: DataFrame, *, key: str = "order_id", timeout: str = "5 seconds") -> DataFrame:
    from ..operators.timers import order_timeout_spec
    prepared = orders.select(key, "ts", us().alias("_ts_us"), "order_type", "event_id")
    return stream_fold(prepared, order_timeout_spec(timeout), key=key).select(
        key, "result", ts_of("_event_us").alias("event_ts"), ts_of("_create_us").alias("create_ts"))


def reconcile_stream(left: DataFrame, right: DataFrame, *, key: str, tolerance: str = "5 seconds",
                     left_name: str = "order", right_name: str = "pay") -> DataFrame:
    """Strict 1:1 reconciliation of two watermarked streams (one keyed processor over the tagged union)."""
    both = (left.select(F.col(key), "ts", us().alias("_ts_us"), F.lit(0).alias("_side"), "event_id")
            .unionByName(right.select(F.col(key), "ts", us().alias("_ts_us"), F.lit(1).alias("_side"), "event_id")))
    out = stream_fold(both, reconcile_spec(tolerance, left_name, right_name), key=key)
    return out.select(key, "tag", ts_of(f"_{left_name}_us").alias(f"{left_name}_ts"), f"{left_name}_event_id",
                      ts_of(f"_{right_name}_us").alias(f"{right_name}_ts"), f"{right_name}_event_id")


def gate_by_switch_stream(readings: DataFrame, switches: DataFrame, *, duration: str = "10 seconds",
                          key: str = "id") -> DataFrame:
    both = (switches.select(key, "ts", us().alias("_ts_us"), F.lit(0).alias("_rank"), "event_id",
                            F.lit(None).cast("double").alias("temperature"))
            .unionByName(readings.select(key, "ts", us().alias("_ts_us"), F.lit(1).alias("_rank"), "event_id",
                                         "temperature")))
    out = stream_fold(both, switch_gate_spec(duration), key=key)
    return out.select(key, ts_of("_ts_out").alias("ts"), "temperature", "event_id")


def smoke_alerts_stream(readings: DataFrame, levels: DataFrame, *, threshold: float = -100.0, default_level: str = "LOW",
                        alert_level: str = "HIGH", buckets: int | None = None) -> DataFrame:
    """The global control gate on two watermarked streams that may be out of order.

    Readings are dealt to ``buckets`` keys (as many as shuffle partitions) by their id, and every control row goes to
    each of them.  A bucket keeps both for the watermark delay and judges readings in time order once the watermark has
    passed them, so a control row that arrives after its readings still counts."""
    n = buckets or int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ctrl = levels.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("_bucket"), "ts",
                         us().alias("_ts_us"), F.lit(0).alias("_rank"), "event_id", F.lit(None).cast("string").alias("id"),
                         F.lit(None).cast("double").alias("temperature"), "level")
    data = readings.select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("long").alias("_bucket"), "ts", us().alias("_ts_us"),
                           F.lit(1).alias("_rank"), "event_id", "id", "temperature", F.lit(None).cast("string").alias("level"))
    out = stream_fold(ctrl.unionByName(data), smoke_gate_spec(threshold, default_level, alert_level), key="_bucket")
    return out.select("id", ts_of("_ts_out").alias("ts"), "temperature", "event_id")


def login_fail_3_stream(logins: DataFrame, *, within: str = "5 seconds") -> DataFrame:
    prepared = logins.select("user_id", "ts", us().alias("_ts_us"), "event_type", "ip_address", "event_id")
    out = stream_fold(prepared, login_fail_spec(within, 3), key="user_id")
    return out.select("user_id", "ip1", "ip2", "ip3", ts_of("_first_us").alias("first_ts"),
                      ts_of("_last_us").alias("last_ts"), "first_event_id")


def order_timeout_pattern_stream(orders: DataFrame, *, within: str = "5 seconds") -> DataFrame:
    prepared = orders.select("order_id", "ts", us().alias("_ts_us"), "order_type", "event_id")
    out = stream_fold(prepared, order_pattern_spec(within), key="order_id")
    return out.select("order_id", ts_of("_create_us").alias("create_ts"), "create_event_id", "result",
                      ts_of("_pay_us").alias("pay_ts"), "pay_event_id", ts_of("_timeout_us").alias("timeout_ts"))


def event_timers_spec(delay: str = "10 seconds") -> FoldSpec:
    """Every row schedules a reminder at ``ts + delay``; a key fires once per distinct time."""
    d = to_micros(delay)

    def step(s, r):
        out = []
        while s["t"] and s["t"].first < r[0]:
            out.append((s["t"].popleft(),))
        t = r[0] + d
        if not s["t"] or s["t"].last != t:  # rows come in time order, so equal times are neighbours
            s["t"].append(t)
        return out

    def finish(s):
        return [(s["t"].popleft(),)] if s["t"] else []

    return FoldSpec(lambda: {"t": Fifo()}, step, finish, lambda s: s["t"].first if s["t"] else None,
                    ("_ts_us", "event_id"), ("_ts_us", "event_id"), (("_timer_us", T.LongType()),), ("t",))


def event_timers_stream(df: DataFrame, *, key: str = "key", delay: str = "10 seconds") -> DataFrame:
    prepared = df.select(key, "ts", us().alias("_ts_us"), "event_id")
    return stream_fold(prepared, event_timers_spec(delay), key=key).select(key, ts_of("_timer_us").alias("timer_ts"))
