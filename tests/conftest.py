from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
EPOCH = dt.datetime(1970, 1, 1)


@pytest.fixture(scope="session")
def spark():
    from eventspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app="eventspark-tests",
                    extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def _usual_pieces(request):
    yield
    if "spark" in request.fixturenames:
        cut(request.getfixturevalue("spark"), 4)


def cut(spark, pieces: int) -> None:
    """Prefix scans from now on cut their rows into that many pieces."""
    spark.conf.set("spark.sql.shuffle.partitions", str(pieces))


def ms(v: int) -> dt.datetime:
    """Epoch milliseconds → naive UTC datetime (the fixtures' time unit)."""
    return EPOCH + dt.timedelta(milliseconds=v)


def rows(df, *cols):
    """Result rows as sorted tuples of the given columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: [(v is not None, v) for v in t])


def folded(df, spec, key):
    """The rows of a :class:`FoldSpec` run over each key's rows in order, one after the other, times in microseconds."""
    from pyspark.sql import functions as F
    by_key = {}
    for r in df.withColumn("_ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).select(key, *spec.columns).collect():
        by_key.setdefault(r[0], []).append(r)
    out = []
    for k, rs in by_key.items():
        state = spec.make()
        for r in sorted(rs, key=lambda r: [r[c] for c in spec.order]):
            out += [(k, *o) for o in spec.step(state, tuple(r)[1:])]
        out += [(k, *o) for o in spec.finish(state)]
    return sorted(out, key=str)


def in_micros(df):
    """Rows with timestamps as microseconds, sorted like those of :func:`folded`."""
    from pyspark.sql import functions as F
    cols = [F.unix_micros(F.col(c).cast("timestamp")) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes]
    return sorted(map(tuple, df.select(*cols).collect()), key=str)
