"""Staged writes: failed tasks, failed jobs and replayed batches leave the store as one clean run."""

from __future__ import annotations

import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from conftest import ms
from eventspark.sinks import keyed
from eventspark.sinks.staged import DbApiStore, _StreamWriter, register_store, write_latest

COLUMNS = ["id", "temperature", "event_id"]


def make_store(path):
    """A store in an SQLite file, reached by every task for itself."""
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE readings (id TEXT, temperature REAL, event_id INTEGER)")

    def open_store():
        return DbApiStore(lambda: sqlite3.connect(path, timeout=60), "readings", "id", COLUMNS, ["event_id"])
    return open_store


def held(path):
    with sqlite3.connect(path) as c:
        return sorted(c.execute("SELECT * FROM readings").fetchall()), c.execute("SELECT COUNT(*) FROM readings_staged").fetchone()[0]


def readings(spark, n=60, shift=0):
    rows = [(f"s{i % 7}", ms(1000 * i), float(i + shift), i + shift) for i in range(n)]
    return spark.createDataFrame(rows, "id string, ts timestamp_ntz, temperature double, event_id long").repartition(5)


def want(*frames):
    out = {}
    for df in frames:
        for r in keyed.latest_by_key(df).collect():
            if r["id"] not in out or out[r["id"]][2] <= r["event_id"]:
                out[r["id"]] = (r["id"], r["temperature"], r["event_id"])
    return sorted(out.values())


def test_a_write_is_published_whole(spark, tmp_path):
    path = str(tmp_path / "store.db")
    register_store(spark, "staged_clean", make_store(path))
    write_latest(readings(spark), "staged_clean")
    write_latest(readings(spark, shift=100), "staged_clean")
    assert held(path) == (want(readings(spark), readings(spark, shift=100)), 0)
    write_latest(readings(spark), "staged_clean")  # older rows change nothing
    assert held(path)[0] == want(readings(spark, shift=100))
    write_latest(readings(spark).limit(0), "staged_clean")
    assert held(path)[0] == want(readings(spark, shift=100))


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "store.db")
    register_store(spark, "staged_failing", make_store(path))
    bad = readings(spark).select("id", "temperature", F.expr("IF(event_id = 41, raise_error('lost'), event_id)").cast("long").alias("event_id"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("staged_failing").mode("append").save()
    assert held(path)[0] == []  # tasks that outlive the abort may still stage, out of sight


def test_what_a_failed_attempt_staged_is_not_published(spark, tmp_path):
    path = str(tmp_path / "store.db")
    writer = _StreamWriter(make_store(path), 2)
    rows = keyed.latest_by_key(readings(spark)).select(*COLUMNS).collect()

    def failing():
        yield from rows[:4]
        raise OSError("executor lost")
    with pytest.raises(OSError):
        writer.write(failing())
    first = [writer.write(iter(rows[:4])), writer.write(iter(rows[4:]))]
    assert held(path)[0] == [] and held(path)[1] > len(rows)
    writer.commit(first, 0)
    assert held(path) == (want(readings(spark)), 0)
    again = _StreamWriter(make_store_again(path), 2)  # the batch is run again by a new driver
    again.commit([again.write(iter([r for r in rows]))], 0)
    assert held(path) == (want(readings(spark)), 0)
    newer = keyed.latest_by_key(readings(spark, shift=500)).select(*COLUMNS).collect()
    again.abort([again.write(iter(newer))], 1)
    assert held(path) == (want(readings(spark)), 0)
    again.commit([again.write(iter(newer))], 1)
    assert held(path) == (want(readings(spark, shift=500)), 0)


def make_store_again(path):
    return lambda: DbApiStore(lambda: sqlite3.connect(path, timeout=60), "readings", "id", COLUMNS, ["event_id"])


def test_a_stream_writes_each_batch_once(spark, tmp_path):
    path = str(tmp_path / "store.db")
    register_store(spark, "staged_stream", make_store(path))
    d = tmp_path / "in"
    for i in range(3):
        p = str(d / f"{i}")
        readings(spark, shift=100 * i).select(*COLUMNS).filter(F.col("event_id") % 60 >= 0).coalesce(1).write.parquet(p)
    src = (spark.readStream.schema("id string, temperature double, event_id long").option("maxFilesPerTrigger", 1)
           .parquet(str(d / "*")))

    def run(checkpoint):
        q = (src.writeStream.format("staged_stream").option("checkpointLocation", str(tmp_path / checkpoint))
             .trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert q.exception() is None
    run("ck")
    got = held(path)
    assert got == (want(*[readings(spark, shift=100 * i) for i in range(3)]), 0)
    run("ck_lost")  # without its checkpoint the stream replays the same batch numbers
    assert held(path) == got
    assert os.path.exists(path)
