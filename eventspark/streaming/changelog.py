"""Top-N per sliding window as a retract/add changelog on a stream (the relational result kept up to date).

Spark's streaming top-N (:func:`eventspark.streaming.windows.hot_items_stream`) emits each window once, when final.
The changelog form instead reports every change as it happens: ``foreachBatch`` adds the batch's pane-aggregated
sliding counts to the stored counts, recomputes the top N only for the windows the batch touched, and emits the
multiset difference against their previous top N — ``is_add = false`` rows retract, ``true`` rows add.  The counts
are stored per batch id under ``state_path`` (a re-run batch reads the version before it; outputs should be written
per batch id).  ``retention`` drops windows that ended that long before the newest event, bounding the state; later rows of
dropped windows are ignored, so nothing is added to or retracted from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from ..operators.topn import changelog, top_n_per_window
from ..operators.windows import sliding_count
from .versions import version_before, write_version


def topn_changelog_handler(write: Callable[[DataFrame, int], None], state_path: str, *, n: int = 3,
                           item: str = "item_id", size: str = "1 hour", slide: str = "5 minutes",
                           retention: str | None = None):
    def since(counts: DataFrame):
        """The end of the oldest window that is kept: ``retention`` before the newest event (to the slide)."""
        if retention is None:
            return None
        newest = counts.agg(F.max("window_end").alias("m")).first()["m"]
        if newest is None:
            return None
        return F.lit(newest).cast("timestamp_ntz") - F.make_dt_interval(
            secs=F.lit((to_micros(size) + to_micros(retention)) / 1e6))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delta = sliding_count(batch, key=item, ts="ts", size=size, slide=slide).select(item, "window_end", "cnt")
        prev = version_before(spark, state_path, batch_id)
        if prev is None:
            prev = delta.limit(0)
        if (oldest := since(prev)) is not None:  # what has left the state would start from zero again
            delta = delta.where(F.col("window_end") >= oldest)
        touched = delta.select("window_end").distinct()
        merged = (prev.unionByName(delta).groupBy(item, "window_end").agg(F.sum("cnt").cast("bigint").alias("cnt"))
                  .cache())
        try:
            before = top_n_per_window(prev.join(touched, "window_end"), n=n, item_col=item)
            after = top_n_per_window(merged.join(touched, "window_end"), n=n, item_col=item)
            cols = ["window_end", item, "cnt", "rank"]
            write(changelog(before.select(*cols), after.select(*cols)), batch_id)
            oldest = since(merged)
            write_version(merged if oldest is None else merged.where(F.col("window_end") >= oldest), state_path, batch_id)
        finally:
            merged.unpersist()

    return handle
