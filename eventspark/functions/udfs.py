"""User-function contracts: per-task mapper with setup/teardown, grouped-aggregate and whole-window escape hatches.

The last two bring a whole group into one task: they are the second form, for functions that cannot be stated with partial
states.  Those that can belong in :mod:`eventspark.functions.aggregates`, whose groups may have any size.

These are the slow path and only exist for logic that built-in expressions cannot state; every operator of the
library that has a built-in form uses it instead.  All of them are Arrow-batched (``mapInArrow`` / ``pandas_udf`` /
``applyInPandas``), never row-at-a-time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_partitions_with_lifecycle(df: DataFrame, fn: Callable[[pa.RecordBatch, object], pa.RecordBatch], schema,
                                  *, open_fn: Callable[[], object] = lambda: None,
                                  close_fn: Callable[[object], None] = lambda ctx: None) -> DataFrame:
    """``RichMapFunction`` shape: ``open`` once per task, ``fn`` per Arrow batch, ``close`` once at the end or on error.

    Batches stay Arrow, so columns that ``fn`` passes on keep every value, 64-bit integers beside NULLs included.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = open_fn()
        try:
            for batch in batches:
                yield fn(batch, ctx)
        finally:
            close_fn(ctx)

    return df.mapInArrow(run, schema)


def partition_scoped_increment(df: DataFrame, col: str, delta: int = 1, *, out: str | None = None) -> DataFrame:
    """The reference's rich mapper (``value + 1``), run through the per-task lifecycle contract."""
    out = out or col
    fields = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType(fields + [T.StructField(out, df.schema[col].dataType)])
    names = [f.name for f in schema.fields]

    def add(batch: pa.RecordBatch, _ctx) -> pa.RecordBatch:
        column = batch.column(batch.schema.get_field_index(col))
        added = pc.add(column, pa.scalar(delta, column.type))
        return pa.RecordBatch.from_arrays(
            [added if n == out else batch.column(batch.schema.get_field_index(n)) for n in names], names=names)

    return map_partitions_with_lifecycle(df, add, schema)


def grouped_agg(df: DataFrame, keys: list[str], fn: Callable[[pd.Series], object], value: str, return_type: str,
                out: str) -> DataFrame:
    """UDAF escape hatch: a grouped-aggregate pandas UDF; a group's values come together in one task."""
    def agg(s: pd.Series) -> float:  # series → scalar: a grouped-aggregate pandas UDF
        return fn(s)

    udaf = F.pandas_udf(agg, return_type)  # type: ignore[call-overload]
    return df.groupBy(*keys).agg(udaf(F.col(value)).alias(out))


def window_apply(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Whole-window user function (``ProcessWindowFunction``) as ``applyInPandas`` per group.

    Only for functions that need all rows of a group at once; such a group must fit one task.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)
