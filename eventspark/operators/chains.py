"""Re-arming timers followed in parallel, piece by piece.

The timers of :mod:`eventspark.operators.timers` are one automaton: a row may *arm* a timer (at its time plus ``gap``,
unless one is pending), *clear* it, or do neither; a pending timer fires at the first later row.  What a piece of a
key's rows does depends on the rows before it only through the pending timer's time, so keys need not be whole in any
task:

1. Rows are cut into range pieces over ``(key, time, id)``, as prefix scans cut theirs, and each piece is read once in
   order (Arrow batches, numpy over all its runs of equal keys).  Runs inside the piece are finished there.  The first
   run, whose key may have begun in an earlier piece, hands on its rows and a *border function*: which timer is pending
   after it, for any timer pending before it.  Chains that start at different rows soon meet, and neighbouring rows with
   the same outcome are one step of the function; it has at most as many steps as there are rows within one ``gap`` of
   the piece's start.  The last run hands on its pending timer.  All of that is written once to the shared checkpoint
   folder, so a recomputed task sees the same pieces.
2. The border records, a few per piece, are brought together per key and composed in order: each lookup gives the timer
   that enters the next piece.  A key's rows end there, so timers pending at the end fire.
3. Every first run is judged with the timer that enters it (one row a piece, broadcast).

One shuffle of the rows, one of the first runs' rows; no joins on rows and no rounds.  A task holds the times and kinds
of one piece.  Rows without a time are ignored; NULL keys are one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runs import run_starts, same_key
from ..session import reliable_checkpoint

_NONE = -(1 << 63)  # no pending timer
_NEUTRAL, _ARM, _CLEAR, _PAY = range(4)
# what a row of the passes is: a result, a border record, a step of a border function, a row of a first run, an entry
_RESULT, _BORDER, _STEP, _ROW, _ENTRY = range(5)
_LONGS, _DOUBLES = ("tag", "pid", "seq", "a", "b", "n", "flag"), ("x", "y")
#: Verdicts of :func:`order_timeout_chain` by code.
_VERDICTS = ("payed", "late_pay", "orphan_pay", "not_payed")


def _join_ns(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols`` with NULL matching NULL (keys may be NULL); keeps one copy of the join columns."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*[f"_r_{c}" for c in cols])


def _trend(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rises arm, falls clear; NaN is above all numbers, as Spark orders it."""
    up = (x > before) | (np.isnan(x) & ~np.isnan(before))
    down = (x < before) | (~np.isnan(x) & np.isnan(before))
    return np.where(up, _ARM, np.where(down, _CLEAR, _NEUTRAL))


class _Runs:
    """Runs of rows in time order, laid end to end, and what a timer armed at each row comes to."""

    def __init__(self, ts: np.ndarray, kind: np.ndarray, start: np.ndarray, gap: int):
        n = len(ts)
        self.ts, self.kind, self.start, self.gap, self.n = ts, kind, start, gap, n
        self.ends = np.append(start[1:], n)
        self.run = np.repeat(np.arange(len(start)), self.ends - start)
        self.end = self.ends[self.run]
        self.later = self._later()
        self.arm_at, self.clear_at = self._next(kind == _ARM), self._next(kind == _CLEAR)
        cleared = self.clear_at[np.arange(1, n + 1)]
        self.cancelled = cleared < self.later
        self.pending = ~self.cancelled & (self.later == self.end)
        self.follower = self.arm_at[np.where(self.cancelled, cleared + 1, self.later)]
        self.follower = np.where(self.follower < self.end, self.follower, n)

    def _later(self) -> np.ndarray:
        """The first row of the run later than each row's time plus ``gap``; the run's end if there is none."""
        since = self.ts - self.ts[self.start][self.run]
        span = int(since.max(initial=0)) + self.gap + 2
        per = max(1, (1 << 62) // span)  # so many runs can lie end to end on one time axis
        out = np.empty(self.n, np.int64)
        for first in range(0, len(self.start), per):
            lo, hi = self.start[first], self.ends[min(first + per, len(self.start)) - 1]
            axis = since[lo:hi] + (self.run[lo:hi] - first) * span
            out[lo:hi] = lo + np.searchsorted(axis, axis + self.gap, side="right")
        return out

    def _next(self, is_such: np.ndarray) -> np.ndarray:
        """The first such row at or after each position."""
        at = np.append(np.where(is_such, np.arange(self.n), self.n), self.n)
        return np.minimum.accumulate(at[::-1])[::-1]

    def armed(self, first: np.ndarray) -> np.ndarray:
        """The rows that arm, in order, following the chains that begin at ``first``."""
        follower, out = self.follower.tolist(), []
        for at in first.tolist():
            while at < self.n:
                out.append(at)
                at = follower[at]
        return np.array(out, np.int64)

    def ending(self) -> np.ndarray:
        """For each row, the last row of the chain that begins there."""
        to = np.where(self.follower < self.n, self.follower, np.arange(self.n))
        while (to != (further := to[to])).any():
            to = further
        return to


def _judged(how: str, runs: _Runs, finish: np.ndarray, enter: tuple | None = None):
    """Results ``(run, a, b, n, flag)`` of the runs and, per run, the timer pending after it and whether it was paid for.

    ``finish``: runs whose pending timer fires.  ``enter``: the timer, count, paid and seen marks before a single run."""
    pay_before = np.concatenate([[0], np.cumsum(runs.kind == _PAY)])
    timer, count, paid, seen = enter or (_NONE, 0, False, False)
    begin = runs.arm_at[runs.start]
    early, upto = [], 0  # what the entering timer comes to; rows that it still covers
    if timer != _NONE:
        upto = int(np.searchsorted(runs.ts, timer, side="right"))
        cut = int(runs.clear_at[0])
        if cut < upto:
            begin = runs.arm_at[[cut + 1]]
        else:
            begin = runs.arm_at[[upto]]
            paid = paid or bool(pay_before[upto])
            if upto < runs.n:
                early = [(0, timer, timer - runs.gap, count + upto, 3)] if how != "order" or not paid else []
    own = runs.armed(np.where(begin < runs.ends, begin, runs.n))
    later, run = runs.later[own], runs.run[own]
    was_paid = pay_before[later] > pay_before[own + 1] if len(own) else np.zeros(0, bool)
    fires = ~runs.cancelled[own] & (~runs.pending[own] | finish[run])
    if how == "order":
        fires &= ~was_paid
    who = own[fires]
    out = [np.array([run[fires], runs.ts[who] + runs.gap, runs.ts[who], count + runs.later[who] - runs.start[run[fires]],
                     np.full(len(who), 3)], np.int64).T]
    if early:
        out.append(np.array(early, np.int64))
    if how == "order":
        pays = np.flatnonzero(runs.kind == _PAY)
        marks = np.full(runs.n, -1, np.int64)
        marks[own] = own
        last = np.maximum.accumulate(marks)[pays] if runs.n else marks
        last = np.where(last >= runs.start[runs.run[pays]], last, -1)
        in_first = pays < upto  # paid while the entering order was open
        good = in_first | ((last >= 0) & (pays < runs.later[last]))
        opened = np.where(in_first, timer - runs.gap if timer != _NONE else 0, runs.ts[last] if runs.n else 0)
        verdict = np.where(good, 0, np.where((last >= 0) | seen, 1, 2))
        out.append(np.array([runs.run[pays], runs.ts[pays], np.where(good, opened, _NONE), np.zeros(len(pays)), verdict],
                            np.int64).T)
    left = np.full(len(runs.start), _NONE, np.int64)
    left_paid = np.zeros(len(runs.start), bool)
    still = own[runs.pending[own] & ~finish[run]]
    left[runs.run[still]] = runs.ts[still] + runs.gap
    left_paid[runs.run[still]] = pay_before[runs.later[still]] > pay_before[still + 1]
    return np.concatenate(out), left, left_paid


def _steps(ts: np.ndarray, kind: np.ndarray, first_ts: int, gap: int):
    """The border function of a run's rows after its first one: ``(bound, timer, paid)`` steps, the first whose bound is
    later than the entering timer holds.  The last step has no bound; without a timer it leaves the entering one."""
    n = len(ts)
    if not n:
        return [(None, None, 0)]
    runs = _Runs(ts, kind, np.array([0]), gap)
    pay_before = np.concatenate([[0], np.cumsum(kind == _PAY)])
    final = runs.ending()
    timer = np.append(np.where(runs.pending[final], ts[final] + gap, _NONE), _NONE)
    paid = np.append(np.where(runs.pending[final], pay_before[n] > pay_before[final + 1], False), False)
    cut = int(runs.clear_at[0])
    # no timer that enters is later than the first row's own would be, so later bounds are never asked for
    most = min(cut + 1, n, int(np.searchsorted(ts, first_ts + gap, side="right")) + 1)
    to = runs.arm_at[np.arange(most)]
    t, p = timer[to], paid[to]
    keep = np.append((t[1:] != t[:-1]) | (p[1:] != p[:-1]), True)
    steps = [(int(b), int(x), int(y)) for b, x, y in zip(ts[:most][keep], t[keep], p[keep], strict=True)]
    if cut < n:
        at = int(runs.arm_at[cut + 1])
        return [*steps, (None, int(timer[at]), int(paid[at]))]
    return [*steps, (None, None, int(pay_before[n] > 0))]


class _Rows:
    """Collects output rows and hands them out as one batch."""

    def __init__(self):
        self.parts: list[pa.RecordBatch] = []

    def add(self, keys: pa.Array, size: int, **columns) -> None:
        """Rows of ``keys`` with columns given as arrays, or as one value for all rows; others are null."""
        if not size:
            return
        cols = [keys]
        for name in _LONGS + _DOUBLES:
            v = columns.get(name)
            if not isinstance(v, (np.ndarray, pa.Array, list)):
                v = [v] * size
            cols.append(v if isinstance(v, pa.Array) else pa.array(v, pa.int64() if name in _LONGS else pa.float64()))
        self.parts.append(pa.RecordBatch.from_arrays(cols, names=["key", *_LONGS, *_DOUBLES]))

    def results(self, keys: pa.Array, start: np.ndarray, found: np.ndarray) -> None:
        """``found``: rows ``(run, a, b, n, flag)``; the least number stands for null."""
        b = pa.array(found[:, 2], mask=found[:, 2] == _NONE)
        self.add(keys.take(pa.array(start[found[:, 0]])), len(found), tag=_RESULT, a=found[:, 1], b=b, n=found[:, 3],
                 flag=found[:, 4])


def _whole(batches: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.chunked_array([b.column(b.schema.get_field_index(name)) for b in batches]).combine_chunks()


def _piece_pass(how: str, gap: int):
    """Rows ``(pid, key, ts, kind, x)`` of one piece, in order."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in it if b.num_rows]
        if not batches:
            return
        pid = batches[0].column(0)[0].as_py()
        keys, ts = _whole(batches, "key"), _whole(batches, "ts").to_numpy()
        start = run_starts(keys)
        if how == "rise":
            x = _whole(batches, "x").to_numpy()
            kind = np.append(_NEUTRAL, _trend(x[1:], x[:-1]))
            kind[start[1:]] = _NEUTRAL  # a key's first row; that of the first run is not known yet
        else:
            x, kind = np.full(len(ts), np.nan), _whole(batches, "kind").to_numpy()
        out = _Rows()
        m = int(start[1]) if len(start) > 1 else len(ts)
        first = keys.take(pa.array(np.zeros(m, np.int64)))
        out.add(first, m, tag=_ROW, pid=pid, seq=np.arange(m), a=ts[:m], flag=kind[:m], x=x[:m])
        out.add(keys[:1], 1, tag=_BORDER, pid=pid, seq=-1, a=ts[:1], b=int((kind[1:m] == _ARM).any()), n=m, flag=kind[:1],
                x=x[:1], y=x[m - 1:m])
        steps = _steps(ts[1:m], kind[1:m], int(ts[0]), gap)
        out.add(keys.take(pa.array(np.zeros(len(steps), np.int64))), len(steps), tag=_STEP, pid=pid,
                seq=np.arange(len(steps)), a=[s[0] for s in steps], b=[s[1] for s in steps], flag=[s[2] for s in steps])
        if len(start) > 1:
            runs = _Runs(ts[m:], kind[m:], start[1:] - m, gap)
            finish = np.ones(len(start) - 1, bool)
            finish[-1] = False  # its key may go on in the next piece
            found, left, paid = _judged(how, runs, finish)
            out.results(keys[m:], runs.start, found)
            s = int(start[-1])
            out.add(keys[s:s + 1], 1, tag=_BORDER, pid=pid, seq=-2, a=left[-1:], b=int((kind[s:] == _ARM).any()),
                    n=len(ts) - s, flag=paid[-1:].astype(np.int64), y=x[-1:])
        yield from out.parts

    return run


def _compose(how: str, gap: int):
    """Border records and steps, by key and piece: the entry of every first run, and timers pending at a key's end.

    Of one piece a key's first run comes before its last one only if they are the same run, so a key has one record a
    piece; ``seq`` -1 is a first run, followed by its steps, -2 a last run that begins in the piece."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        timer, count, before, paid, seen = _NONE, 0, None, False, False
        waiting = None  # timer whose step is looked for
        last_key, have = None, False
        for batch in it:
            out = _Rows()
            keys = batch.column(batch.schema.get_field_index("key"))
            starts = set(run_starts(keys).tolist()) if batch.num_rows else set()
            rows = batch.select([*_LONGS, *_DOUBLES]).to_pylist()
            for i, r in enumerate(rows):
                if i in starts and (i or not have or not same_key([last_key], [keys[:1]])):
                    if have and timer != _NONE and not (how == "order" and paid):
                        out.add(last_key, 1, tag=_RESULT, a=timer, b=timer - gap, n=count, flag=3)
                    timer, count, before, paid, seen, waiting = _NONE, 0, None, False, False, None
                    last_key, have = keys[i:i + 1], True
                if r["tag"] == _STEP:
                    if waiting is not None and (r["a"] is None or waiting < r["a"]):
                        if r["b"] is None:  # nothing later: the timer stays
                            paid = paid or bool(r["flag"]) if timer != _NONE else False
                        else:
                            timer, paid = r["b"], bool(r["flag"])
                        waiting = None
                    continue
                if r["seq"] == -2:
                    timer, paid, seen, count, before = r["a"], bool(r["flag"]), bool(r["b"]), r["n"], r["y"]
                    continue
                out.add(keys[i:i + 1], 1, tag=_ENTRY, pid=r["pid"], a=timer, n=count, flag=int(paid) + 2 * int(seen),
                        x=before)
                kind = r["flag"]
                if how == "rise" and before is not None:
                    kind = int(_trend(np.array([r["x"]]), np.array([before]))[0])
                if timer < r["a"]:
                    timer, paid = _NONE, False
                if kind == _ARM:
                    seen = True
                    if timer == _NONE:
                        timer, paid = r["a"] + gap, False
                elif kind == _CLEAR:
                    timer, paid = _NONE, False
                elif kind == _PAY and timer != _NONE:
                    paid = True
                waiting, count, before, seen = timer, count + r["n"], r["y"], seen or bool(r["b"])
            yield from out.parts
        if have and timer != _NONE and not (how == "order" and paid):
            out = _Rows()
            out.add(last_key, 1, tag=_RESULT, a=timer, b=timer - gap, n=count, flag=3)
            yield from out.parts

    return run


def _entered(how: str, gap: int):
    """Rows of first runs ``(pid, key, a, flag, x)`` in order, with their entry ``(timer, count, marks, before)``."""

    def judge(batches: list[pa.RecordBatch], out: _Rows) -> None:
        keys, ts, kind = (_whole(batches, c) for c in ("key", "a", "flag"))
        ts, kind = ts.to_numpy(), kind.to_numpy().copy()
        timer, count, marks, before, x = (batches[0].column(batches[0].schema.get_field_index(c))[0].as_py()
                                          for c in ("timer", "count", "marks", "before", "x"))
        if how == "rise" and before is not None:
            kind[0] = _trend(np.array([x]), np.array([before]))[0]
        found, _, _ = _judged(how, _Runs(ts, kind, np.array([0]), gap), np.zeros(1, bool),
                              (timer, count, bool(marks & 1), bool(marks & 2)))
        out.results(keys, np.array([0]), found)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, held = None, []
        for batch in it:
            out = _Rows()
            pids = batch.column(batch.schema.get_field_index("pid")).to_numpy()
            cuts = [0, *(np.flatnonzero(pids[1:] != pids[:-1]) + 1).tolist(), len(pids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                if held and pids[a] != pid:
                    judge(held, out)
                    held = []
                pid = pids[a]
                held.append(batch.slice(a, b - a))
            yield from out.parts
        if held:
            out = _Rows()
            judge(held, out)
            yield from out.parts

    return run


def _followed(rows: DataFrame, *, key: str, how: str, gap: int, kind=None, x=None) -> DataFrame:
    """``(key, a, b, n, flag)`` of all results: the firing time (or a pay's time), the arming time, the rows of the key up to
    the firing, and the verdict's number."""
    spark = rows.sparkSession
    pieces = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.where(F.col("_ts_us").isNotNull()).select(
        F.col(key).alias("key"), F.col("_ts_us").alias("ts"), "event_id",
        (F.lit(None) if kind is None else kind).cast("long").alias("kind"),
        (F.lit(None) if x is None else x).cast("double").alias("x"))
    cut = cut.repartitionByRange(pieces, "key", "ts", "event_id").sortWithinPartitions("key", "ts", "event_id")
    schema = T.StructType([T.StructField("key", cut.schema["key"].dataType), *[T.StructField(c, T.LongType()) for c in _LONGS],
                           *[T.StructField(c, T.DoubleType()) for c in _DOUBLES]])
    seen = reliable_checkpoint(cut.select(F.spark_partition_id().cast("long").alias("pid"), "key", "ts", "kind", "x")
                               .mapInArrow(_piece_pass(how, gap), schema))
    borders = seen.where(F.col("tag").isin(_BORDER, _STEP)).repartition(pieces, "key")
    composed = reliable_checkpoint(borders.sortWithinPartitions("key", "pid", "seq").mapInArrow(
        _compose(how, gap), schema))
    # one entry a piece
    entry = composed.where(F.col("tag") == _ENTRY).select(F.col("pid").alias("of"), F.col("a").alias("timer"),
                                                          F.col("n").alias("count"), F.col("flag").alias("marks"),
                                                          F.col("x").alias("before"))
    firsts = seen.where(F.col("tag") == _ROW).select("pid", "seq", "key", "a", "flag", "x")
    firsts = firsts.join(F.broadcast(entry), F.col("pid") == F.col("of")).drop("of")
    firsts = firsts.repartition(pieces, "pid").sortWithinPartitions("pid", "seq").mapInArrow(
        _entered(how, gap), schema)
    done = F.col("tag") == _RESULT
    return seen.where(done).union(composed.where(done)).union(firsts).select(F.col("key").alias(key), "a", "b", "n", "flag")


def periodic_counts_chain(rows: DataFrame, *, key: str, period_us: int) -> DataFrame:
    """``(key, _fire_us, cnt)`` of :func:`~eventspark.operators.timers.periodic_counts_spec`: every row arms."""
    out = _followed(rows, key=key, how="count", gap=period_us, kind=F.lit(_ARM))
    return out.select(key, F.col("a").alias("_fire_us"), F.col("n").alias("cnt"))


def order_timeout_chain(rows: DataFrame, *, key: str, timeout_us: int) -> DataFrame:
    """``(key, result, _event_us, _create_us)`` of :func:`~eventspark.operators.timers.order_timeout_spec`: creates arm, and
    each pay is judged by the order open at its time."""
    kind = F.when(F.col("order_type") == "create", _ARM).when(F.col("order_type") == "pay", _PAY).otherwise(_NEUTRAL)
    out = _followed(rows, key=key, how="order", gap=timeout_us, kind=kind)
    verdict = F.element_at(F.array(*[F.lit(v) for v in _VERDICTS]), (F.col("flag") + 1).cast("int"))
    return out.select(key, verdict.alias("result"), F.col("a").alias("_event_us"), F.col("b").alias("_create_us"))


def temp_rise_chain(rows: DataFrame, *, key: str, rise_us: int) -> DataFrame:
    """``(key, _alert_us)`` of :func:`~eventspark.operators.timers.temp_rise_spec`: rises arm, falls clear."""
    out = _followed(rows, key=key, how="rise", gap=rise_us, x=F.col("temperature"))
    return out.select(key, F.col("a").alias("_alert_us"))
