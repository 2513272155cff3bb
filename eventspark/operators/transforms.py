"""Row-level transforms: projection, filters, value-driven replication, tagged side outputs, unions.

All of these are narrow (no shuffle) and stay inside whole-stage codegen; row replication uses ``explode`` over a
computed array so a 1:N map is a single ``Generate`` node rather than a Python function.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """1:1 map to the given columns (``map(r -> r.id)``)."""
    return df.select(*cols)


def filter_by(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows for which ``predicate`` is true (NULL counts as false)."""
    return df.where(predicate)


def replicate_by_value(df: DataFrame, col: str, copies: Mapping[str, int], default: int = 0) -> DataFrame:
    """1:N flat map: each row is emitted ``copies[value]`` times (``default`` for other values; 0 drops the row).

    Expressed as ``explode(array_repeat(...))`` so it is one vectorised ``Generate``; ``copy_no`` numbers the copies.
    """
    n = F.lit(default)
    for value, k in copies.items():
        n = F.when(F.col(col) == value, F.lit(int(k))).otherwise(n)
    out = df.select("*", F.posexplode(F.array_repeat(F.lit(0), n.cast("int"))).alias("copy_no", "_r")).drop("_r")
    return out.withColumn("copy_no", F.col("copy_no").cast("bigint"))


def tag_split(df: DataFrame, side_predicate: Column, *, main="main", side="side", tag_col="tag") -> DataFrame:
    """Single-pass side output: every row is tagged ``main``; rows matching ``side_predicate`` are also tagged
    ``side``.  Consumers split with ``where(tag == ...)`` (or write each tag to its own sink in ``foreachBatch``)."""
    tags = F.when(side_predicate, F.array(F.lit(main), F.lit(side))).otherwise(F.array(F.lit(main)))
    return df.select("*", F.explode(tags).alias(tag_col))


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def co_flat_map(left: DataFrame, right: DataFrame, *, left_copies: int = 2, right_copies: int = 1,
                value_col: str = "v", side_col: str = "side") -> DataFrame:
    """Two inputs, one operator: each side is expanded by its own rule and tagged, then the sides are unioned.

    The reference's connected flat map emits left values twice and right values once; the copy counts are
    parameters here.
    """
    lft = left.select("*", F.lit("left").alias(side_col),
                      F.posexplode(F.array_repeat(F.lit(0), left_copies)).alias("copy_no", "_r")).drop("_r")
    rgt = right.select("*", F.lit("right").alias(side_col),
                       F.posexplode(F.array_repeat(F.lit(0), right_copies)).alias("copy_no", "_r")).drop("_r")
    return lft.unionByName(rgt, allowMissingColumns=True).withColumn("copy_no", F.col("copy_no").cast("bigint"))
