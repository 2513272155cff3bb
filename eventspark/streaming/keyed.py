"""Allowed lateness and the top-n changelog as keyed stream state (``transformWithStateInPandas``).

Both keep a window's state in cells of its own, so a micro-batch costs what the windows it touches cost, and timers
remove what is over.  Spark versions and restores the state; there are no files to manage.

* :func:`allowed_lateness_stream` is the firing rule of :func:`eventspark.operators.replay.allowed_lateness` with the
  watermark as a stream has it, constant during a micro-batch (``max event time of earlier batches - bound``); the replay
  handler of :mod:`eventspark.streaming.replay` moves it with every row.  Spark filters rows by their own time and its
  watermark, a window is late by its end: the stream's delay is widened to ``bound + lateness + size``, which never drops
  a row that is still admissible, and the rule's own watermark is computed back from it.
* :func:`topn_changelog_stream` keeps each window's count per item in a map and its present top ``n``.  Counts only grow,
  so the new top ``n`` lies among the old one and the items that the batch touched; no other count is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.durations import to_micros

_STATE = T.StructType([T.StructField("n0", T.LongType()), T.StructField("nu", T.LongType()), T.StructField("fired", T.BooleanType())])


def _micros(value) -> int:
    return pd.Timestamp(value).value // 1000


class LatenessProcessor(StatefulProcessor):
    """State of one key and window: rows on time, late updates so far, and whether it has fired."""

    def __init__(self, size_us: int, lateness_us: int, names: list[str]):
        self.size_us, self.lateness_us, self.names = size_us, lateness_us, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", _STATE)

    def _now(self, timer_values) -> float:
        """The rule's watermark: the newest event time of earlier batches less the bound."""
        ms = timer_values.getCurrentWatermarkInMs()
        return ms * 1000 + self.lateness_us + self.size_us if ms > 0 else float("-inf")

    def _timer_at(self, soft_us: int) -> None:
        """A timer for when the rule's watermark has reached ``soft_us``."""
        self.handle.registerTimer(max(0, -(-(soft_us - self.lateness_us - self.size_us) // 1000)))

    def _out(self, key, firings: list) -> Iterator[pd.DataFrame]:
        if firings:
            yield pd.DataFrame([(*key, no, "first" if no == 1 else "update", cnt) for no, cnt in firings], columns=self.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, end, now = sum(len(pdf) for pdf in rows), _micros(key[2]), self._now(timerValues)
        if now >= end + self.lateness_us:
            return  # dropped
        known = self.window.exists()
        n0, nu, fired = self.window.get() if known else (0, 0, False)
        firings = []
        if now < end:
            n0 += n
        else:
            if n0 and not fired:  # its own timer comes after the rows of this batch
                firings.append((1, n0))
            fired = True
            firings += [((n0 > 0) + nu + i, n0 + nu + i) for i in range(1, n + 1)]
            nu += n
        self.window.update((n0, nu, fired))
        if not known:
            self._timer_at(end)
            self._timer_at(end + self.lateness_us)
        yield from self._out(key, firings)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.window.exists():
            return
        end, now = _micros(key[2]), self._now(timerValues)
        n0, nu, fired = self.window.get()
        if n0 and not fired and now >= end:
            self.window.update((n0, nu, True))
            yield from self._out(key, [(1, n0)])
        if now >= end + self.lateness_us:
            self.window.clear()

    def close(self) -> None:
        pass


def allowed_lateness_stream(df: DataFrame, *, key: str = "key", ts: str = "ts", size: str = "5 seconds",
                            bound: str = "5 seconds", lateness: str = "5 seconds") -> DataFrame:
    """``key, window_start, window_end, firing, kind (first|update), cnt`` of an unwatermarked stream ``df``."""
    delay = f"{(to_micros(bound) + to_micros(lateness) + to_micros(size)) // 1000} milliseconds"
    w = F.window(F.col(ts), size)
    rows = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).select(
        key, ts, w.start.alias("window_start"), w.end.alias("window_end"))
    schema = T.StructType([rows.schema[key], T.StructField("window_start", T.TimestampType()),
                           T.StructField("window_end", T.TimestampType()), T.StructField("firing", T.LongType()),
                           T.StructField("kind", T.StringType()), T.StructField("cnt", T.LongType())])
    proc = LatenessProcessor(to_micros(size), to_micros(lateness), schema.names)
    return rows.groupBy(key, "window_start", "window_end").transformWithStateInPandas(proc, schema, "Append", "EventTime")


class ChangelogProcessor(StatefulProcessor):
    """State of one window: a cell per item with its count, and the present top rows."""

    def __init__(self, n: int, item_type: T.DataType, names: list[str], keep_us: int | None):
        self.n, self.item_type, self.names, self.keep_us = n, item_type, names, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        item, cnt = T.StructField("item", self.item_type), T.StructField("cnt", T.LongType())
        self.counts = handle.getMapState("counts", T.StructType([item]), T.StructType([cnt]))
        self.top = handle.getValueState("top", T.StructType([T.StructField("rows", T.ArrayType(T.StructType([item, cnt])))]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = _micros(key[0])
        if self.keep_us is not None:
            if max(timerValues.getCurrentWatermarkInMs(), 0) * 1000 >= end + self.keep_us:
                return  # over: nothing is added to or retracted from it
            self.handle.registerTimer(-(-(end + self.keep_us) // 1000))
        came: dict = {}
        for pdf in rows:
            for item, n in pdf.iloc[:, 1].value_counts(dropna=False).items():
                item = None if pd.isna(item) else item.item() if hasattr(item, "item") else item
                came[item] = came.get(item, 0) + int(n)
        for item, n in came.items():
            if self.counts.containsKey((item,)):
                n += self.counts.getValue((item,))[0]
            self.counts.updateValue((item,), (n,))
            came[item] = n
        before = [tuple(r) for r in self.top.get()[0]] if self.top.exists() else []
        known = dict(before) | came
        # ties go to the smaller item, a null one first, as in the batch ranking
        after = sorted(known.items(), key=lambda r: (-r[1], r[0] is not None, r[0] if r[0] is not None else 0))[:self.n]
        self.top.update((after,))
        old = {(item, n, rank) for rank, (item, n) in enumerate(before, 1)}
        new = {(item, n, rank) for rank, (item, n) in enumerate(after, 1)}
        out = [(False, key[0], *r) for r in sorted(old - new, key=lambda r: r[2])]
        out += [(True, key[0], *r) for r in sorted(new - old, key=lambda r: r[2])]
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        self.top.clear()
        yield from ()

    def close(self) -> None:
        pass


def topn_changelog_stream(pv: DataFrame, *, n: int = 3, item: str = "item_id", ts: str = "ts", size: str = "1 hour",
                          slide: str = "5 minutes", retention: str | None = None) -> DataFrame:
    """``is_add, window_end, item, cnt, rank``: the changes of each window's top ``n``, batch by batch (output mode
    ``update``), retractions first.

    ``pv`` carries a watermark.  With ``retention`` a window leaves the state that long after its end by the watermark, and
    later rows of it are ignored; without it windows are kept.  A window's rows of one batch go to one task."""
    w = F.window(F.col(ts), size, slide)
    rows = pv.select(w.end.alias("window_end"), item, ts)
    schema = T.StructType([T.StructField("is_add", T.BooleanType()), T.StructField("window_end", T.TimestampType()),
                           rows.schema[item], T.StructField("cnt", T.LongType()), T.StructField("rank", T.LongType())])
    proc = ChangelogProcessor(n, rows.schema[item].dataType, schema.names, None if retention is None else to_micros(retention))
    return rows.groupBy("window_end").transformWithStateInPandas(proc, schema, "Update", "EventTime")
