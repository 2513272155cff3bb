"""SQL surface: registering frames (batch or streaming) as views with column choice, renames and event time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_view(df: DataFrame, name: str, *, columns: Mapping[str, str] | None = None,
                  rowtime: str | None = None, watermark_delay: str | None = None) -> DataFrame:
    """Create or replace temp view ``name``.

    ``columns`` maps source column → view column (choice and rename, like listing fields when registering a stream);
    ``rowtime`` names the event-time column, which gets a watermark of ``watermark_delay`` on streaming frames
    (cast to ``timestamp``, which ``withWatermark`` requires).
    """
    view = df if columns is None else df.select(*[F.col(src).alias(dst) for src, dst in columns.items()])
    if rowtime and df.isStreaming:
        view = view.withColumn(rowtime, F.col(rowtime).cast("timestamp")).withWatermark(
            rowtime, watermark_delay or "0 seconds")
    view.createOrReplaceTempView(name)
    return view
