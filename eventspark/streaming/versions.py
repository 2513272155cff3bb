"""State of a ``foreachBatch`` handler, one folder ``v=<batch id>`` per version.

A batch reads the version before its own and writes its own, replacing what an earlier run of the same batch left.
Versions are found by listing the folders, so an empty version counts.  Once a version is written, all but the one
before it are removed: a re-run of the batch still finds what it read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .sources import path_exists


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, path):
        return []
    p, fs = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def version_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The newest version older than ``batch_id``, or None."""
    older = [v for v in versions(spark, path) if v < batch_id]
    return spark.read.parquet(os.path.join(path, f"v={older[-1]}")) if older else None


def write_version(df: DataFrame, path: str, batch_id: int) -> None:
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(os.path.join(path, f"v={int(batch_id)}"))
    for v in [v for v in versions(spark, path) if v < batch_id][:-1]:
        p, fs = _folder(spark, os.path.join(path, f"v={v}"))
        fs.delete(p, True)
