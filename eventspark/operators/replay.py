"""Replaying an out-of-order stream in arrival order: watermarks and late data, as batch operators.

Definitions (the reference samples its watermark periodically; we idealise it per row):

* ``watermark`` of a row = ``max(ts of all rows that arrived before it) - bound - 1 ms``; NULL for the first row.
* union of inputs: the watermark is the minimum of the inputs' watermarks, NULL until every input has a row.
* a row is *late* when ``ts < watermark``.
* a window ``[start, end)`` has fired once ``max ts seen - bound >= end``; rows arriving later are late for it.
* allowed lateness L: with ``m = max ts seen before the row - bound``: ``m < end`` on time; ``end <= m < end + L``
  a late update that re-fires the window; otherwise dropped.

The running maximum runs over the *global* arrival order.  A ``Window`` without ``partitionBy`` would do that in one
task; :func:`~eventspark.operators.scan.prefix_scan` range-partitions by arrival and carries the per-partition maxima
instead, so the work stays spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from ..session import reliable_checkpoint
from .chains import _join_ns
from .scan import prefix_scan

ORDER = ["arrival", "event_id"]


def _us(c: str | Column) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def _ts_from_us(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def _max_before(df: DataFrame, out: str = "_max_before_us", initial_max_us: int | None = None) -> DataFrame:
    """Max event time of the rows that arrived before each row; ``initial_max_us`` is the max of everything that
    arrived before ``df`` (earlier micro-batches of a stream)."""
    s = prefix_scan(df, order=ORDER, inclusive=False, values=[(out, _us("ts"), "max")])
    if initial_max_us is not None:
        s = s.withColumn(out, F.greatest(F.col(out), F.lit(int(initial_max_us))))
    return s


def watermark_trace(df: DataFrame, *, bound: str = "10 seconds", initial_max_us: int | None = None) -> DataFrame:
    """Every row with the watermark in force when it arrives."""
    b = to_micros(bound) + 1000
    s = _max_before(df, initial_max_us=initial_max_us)
    return s.select(*df.columns, _ts_from_us(F.col("_max_before_us") - F.lit(b)).alias("watermark"))


def union_watermark_trace(a: DataFrame, b: DataFrame, *, bound: str = "0 seconds", initial_max_a_us: int | None = None,
                          initial_max_b_us: int | None = None) -> DataFrame:
    """Rows of two inputs merged in arrival order; the watermark is the least of the two inputs' watermarks.
    ``initial_max_*_us`` are the inputs' max event times before these rows (earlier micro-batches)."""
    bb = to_micros(bound) + 1000
    u = a.withColumn("source", F.lit("a")).unionByName(b.withColumn("source", F.lit("b")))
    s = prefix_scan(u, order=ORDER, inclusive=False, values=[
        ("_ma", F.when(F.col("source") == "a", _us("ts")), "max"),
        ("_mb", F.when(F.col("source") == "b", _us("ts")), "max")])
    for col, init in (("_ma", initial_max_a_us), ("_mb", initial_max_b_us)):
        if init is not None:
            s = s.withColumn(col, F.greatest(F.col(col), F.lit(int(init))))
    wm = F.when(F.col("_ma").isNotNull() & F.col("_mb").isNotNull(),
                _ts_from_us(F.least("_ma", "_mb") - F.lit(bb)))
    return s.select(*u.columns, wm.alias("watermark"))


def late_row_split(df: DataFrame, *, bound: str = "0 seconds", initial_max_us: int | None = None) -> DataFrame:
    """Tag every row ``main`` or ``late`` (``ts < watermark``); a late row is not passed on as main."""
    t = watermark_trace(df, bound=bound, initial_max_us=initial_max_us)
    late = F.coalesce(F.col("ts") < F.col("watermark"), F.lit(False))
    return t.select(*df.columns, F.when(late, F.lit("late")).otherwise(F.lit("main")).alias("tag"))


def _classify(df: DataFrame, *, key: str, size: str, bound: str, lateness: str = "0 seconds",
              initial_max_us: int | None = None) -> DataFrame:
    w = F.window(F.col("ts"), size)
    s = _max_before(df.select("*", w.start.alias("window_start"), w.end.alias("window_end")),
                    initial_max_us=initial_max_us)
    m = F.col("_max_before_us") - F.lit(to_micros(bound))
    end = _us("window_end")
    cls = (F.when(F.col("_max_before_us").isNull() | (m < end), F.lit("on_time"))
           .when(m < end + F.lit(to_micros(lateness)), F.lit("update"))
           .otherwise(F.lit("dropped")))
    return s.withColumn("class", cls)


def window_lateness(df: DataFrame, *, key: str = "key", size: str = "5 seconds", bound: str = "0 seconds",
                    initial_max_us: int | None = None) -> DataFrame:
    """Every row tagged ``main`` (its window had not fired when it arrived) or ``late``, with its window bounds."""
    c = _classify(df, key=key, size=size, bound=bound, initial_max_us=initial_max_us)
    return c.select(*df.columns, "window_start", "window_end",
                    F.when(F.col("class") == "on_time", F.lit("main")).otherwise(F.lit("late")).alias("tag"))


def late_window_split(df: DataFrame, *, key: str = "key", size: str = "5 seconds", bound: str = "0 seconds"
                      ) -> DataFrame:
    """Tumbling-window counts of the rows that arrive before their window fired (``tag = main``) plus the late rows
    themselves (``tag = late``), in one frame: ``tag, key, window_start, window_end, cnt, ts, event_id``."""
    c = _classify(df, key=key, size=size, bound=bound)
    main = (c.where(F.col("class") == "on_time").groupBy(key, "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit("main").alias("tag"), key, "window_start", "window_end", "cnt",
                    F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("bigint").alias("event_id")))
    late = c.where(F.col("class") != "on_time").select(
        F.lit("late").alias("tag"), key, "window_start", "window_end", F.lit(None).cast("bigint").alias("cnt"),
        "ts", "event_id")
    return main.unionByName(late)


def allowed_lateness(df: DataFrame, *, key: str = "key", size: str = "5 seconds", bound: str = "5 seconds",
                     lateness: str = "5 seconds") -> DataFrame:
    """Window firings with allowed lateness: ``key, window_start, window_end, firing, kind (first|update), cnt``.

    The window fires once when the watermark passes its end (with the rows that were on time), then once more for
    every late row within the lateness, each time with the count so far.  The first firing is ``first`` (also when
    it is triggered by a late row), the others ``update``.  Rows beyond the lateness are dropped.
    """
    c = _classify(df, key=key, size=size, bound=bound, lateness=lateness)
    kw = [key, "window_start", "window_end"]
    on_time = c.where(F.col("class") == "on_time").groupBy(*kw).agg(F.count(F.lit(1)).alias("_n0"))
    c = reliable_checkpoint(c)  # read three times below, and scanned again for the update rows
    upd = c.where(F.col("class") == "update").withColumn("_kw", F.struct(*kw))
    upd = prefix_scan(upd, key="_kw", order=ORDER, values=[("_u", F.lit(1).cast("bigint"), "sum")])
    upd = _join_ns(upd, on_time, kw, "left").select(*kw, F.coalesce("_n0", F.lit(0)).alias("_n0"), "_u")
    first_from_on_time = on_time.select(*kw, F.lit(1).cast("bigint").alias("firing"), F.col("_n0").alias("cnt"))
    firings_upd = upd.select(*kw, (F.when(F.col("_n0") > 0, 1).otherwise(0) + F.col("_u")).cast("bigint")
                             .alias("firing"), (F.col("_n0") + F.col("_u")).alias("cnt"))
    out = first_from_on_time.unionByName(firings_upd)
    return out.select(*kw, "firing", F.when(F.col("firing") == 1, F.lit("first")).otherwise(F.lit("update"))
                      .alias("kind"), "cnt")
