"""Session construction and lineage helpers.

All operators take and return DataFrames and never create a session themselves; this module is only used by tests,
``bench.py`` and the entry points.  Time zone is pinned to UTC so that epoch conversions and ``date_format`` agree with
the SQL oracle.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Confs every session of ours carries; AQE is on so shuffle partition counts and join strategies are re-planned from
# runtime sizes (coalescing small partitions, splitting skewed join partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle partitions are coalesced to about this size after each stage; input splits stay at the default 128 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "eventspark",
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("EVENTSPARK_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, taking it from ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is always used as-is.  Only when it is unset *and* the master
    is local (tests, local benches) do we create a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventspark-ckpt-"))
    return sc.getCheckpointDir()


#: Written frames: the JVM's weak reference to the relation that reads them, and their folder.
_written: list[tuple[object, str]] = []


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the shared checkpoint folder; what is written there goes when the driver's JVM ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_unread(spark: SparkSession) -> None:
    """Delete the written frames that no plan reads any more."""
    for entry in list(_written):
        ref, folder = entry
        try:
            if ref.refersTo(None):
                remove_folder(spark, folder)
                _written.remove(entry)
        except Py4JError:  # written by a JVM that has ended
            _written.remove(entry)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back, which cuts its lineage.

    A recomputation after a lost executor re-reads the files instead of re-running a range shuffle whose sample could
    differ.  The planner's size estimate of the result is the size of its files: ``DataFrame.checkpoint`` keeps the
    estimate of the plan that it cuts, and the product of a join's sides, taken anew in every round of a loop, grows
    beyond what the planner can multiply.  Files go once no plan reads them (seen at the next call) and at the end of
    the driver's JVM.
    """
    spark = df.sparkSession
    _remove_unread(spark)
    folder = scratch_folder(spark, "frame")
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]  # Parquet has no such type
    df.drop(*void).write.mode("overwrite").parquet(folder)
    out = spark.read.schema(df.drop(*void).schema).parquet(folder)
    _written.append((spark._jvm.java.lang.ref.WeakReference(out._jdf.queryExecution().analyzed().relation()), folder))
    return out.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns]) if void else out
