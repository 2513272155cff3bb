"""Sink row shaping and writers with in-memory fakes (no external service is started)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Row

from conftest import ms, rows
from eventspark.sinks import kafka, keyed


def _readings(spark):
    return spark.createDataFrame([("s1", ms(1000), 10.0, 1), ("s1", ms(2000), 12.5, 2), ("s2", ms(1000), 3.0, 3),
                                  ("s1", ms(2000), 11.0, 0)],
                                 "id string, ts timestamp_ntz, temperature double, event_id long")


def test_latest_by_key_is_last_write(spark):
    out = keyed.latest_by_key(_readings(spark), key="id")
    assert rows(out, "id", "temperature") == [("s1", 12.5), ("s2", 3.0)]


def test_hset_rows(spark):
    out = keyed.hset_rows(_readings(spark), hash_name="sensor")
    assert rows(out, "hash", "field", "value") == [("sensor", "s1", "12.5"), ("sensor", "s2", "3.0")]


def test_es_documents(spark):
    out = keyed.es_documents(_readings(spark), index="sensor").collect()
    assert len(out) == 4 and {r["index"] for r in out} == {"sensor"}
    assert all(set(json.loads(r["source"])) == {"data"} for r in out)


class FakeCursor:
    def __init__(self, db, log):
        self.db, self.log, self.rowcount = db, log, 0

    def execute(self, sql, params):
        self.log.append(sql.split()[0])
        self.found = [(k,) for k in params if k in self.db]

    def fetchall(self):
        return self.found

    def executemany(self, sql, rows_):
        self.log.append(sql.split()[0])
        for params in rows_:
            if sql.startswith("UPDATE"):
                self.db[params[-1]] = params[:-1]
            else:
                assert params[0] not in self.db
                self.db[params[0]] = params[1:]


class FakeConn:
    def __init__(self):
        self.db, self.log, self.commits, self.closed = {}, [], 0, False

    def cursor(self):
        return FakeCursor(self.db, self.log)

    def commit(self):
        self.commits += 1

    def close(self):
        self.closed = True


def test_upsert_partition_update_else_insert():
    conn = FakeConn()
    data = [Row(id="a", v=1), Row(id="b", v=2), Row(id="a", v=3)]
    keyed.upsert_partition(iter(data), connect=lambda: conn, table="t", key="id", columns=["id", "v"], batch_size=2)
    assert conn.db == {"a": [3], "b": [2]}
    assert conn.log == ["SELECT", "INSERT", "SELECT", "UPDATE"]
    assert conn.commits == 2 and conn.closed
    keyed.upsert_partition(iter(data), connect=lambda: conn, table="t", key="id", columns=["id", "v"], batch_size=9)
    assert conn.db == {"a": [3], "b": [2]}  # replayed, in one batch that holds a key twice


class FakeRedis:
    def __init__(self):
        self.h, self.closed = {}, False

    def hset(self, name, field, value):
        self.h.setdefault(name, {})[field] = value

    def close(self):
        self.closed = True


def test_hset_partition_and_replay_idempotent():
    r = FakeRedis()
    data = [{"hash": "sensor", "field": "s1", "value": "1.0"}, {"hash": "sensor", "field": "s2", "value": "2.0"}]
    keyed.hset_partition(iter(data), client_factory=lambda: r, batch_size=1)
    keyed.hset_partition(iter(data), client_factory=lambda: r, batch_size=1)
    assert r.h == {"sensor": {"s1": "1.0", "s2": "2.0"}} and r.closed


def test_bulk_index_partition_batches_and_replay_idempotent():
    calls, stored = [], {}

    class ES:
        def bulk(self, reqs):
            calls.append(list(reqs))
            stored.update({(index, doc_id): source for index, doc_id, source in reqs})

    data = [{"index": "sensor", "event_id": i, "source": str(i)} for i in range(5)]
    for _ in range(2):
        keyed.bulk_index_partition(iter(data), client_factory=ES, batch_size=2)
    assert [len(c) for c in calls] == [2, 2, 1] * 2
    assert stored == {("sensor", i): str(i) for i in range(5)}


def test_kafka_decode_encode(spark):
    recs = spark.createDataFrame([(b"k", b"hello", "t", 0, 5, ms(0))], kafka.KAFKA_RECORD_SCHEMA)
    dec = kafka.decode_strings(recs).first()
    assert (dec["key"], dec["value"], dec["offset"]) == ("k", "hello", 5)
    enc = kafka.encode_strings(kafka.decode_strings(recs), "value", "key").first()
    assert (bytes(enc["key"]), bytes(enc["value"])) == (b"k", b"hello")


def test_kafka_refuses_feedback_loop(spark):
    with pytest.raises(ValueError):
        kafka.write_kafka(spark.range(1).selectExpr("'x' AS value"), servers="unused:0", topic="a",
                          checkpoint="/nonexistent", source_topic="a")


def test_writers_through_partitions_and_stream(spark, tmp_path):
    """The per-partition writers run on the executors (file-backed fake clients record their calls), in batch and as
    a streaming foreachBatch sink; the hash ends at the last value per field."""
    import glob
    import os
    import uuid
    from pyspark.sql import functions as F
    from conftest import SF001
    from eventspark.sources import views
    from eventspark.sources.tables import read_table
    from eventspark.streaming.sources import read_parquet_stream

    out = str(tmp_path / "calls")
    os.makedirs(out)

    def client_factory():
        class FileRedis:
            def __init__(self):
                self.f = open(os.path.join(out, f"{uuid.uuid4().hex}.jsonl"), "w")

            def hset(self, name, field, value):
                self.f.write(json.dumps([name, field, value]) + "\n")

            def close(self):
                self.f.close()
        return FileRedis()

    ev = read_table(spark, SF001, "events")
    r = views.readings(ev)
    keyed.write_hset(r, client_factory=client_factory, batch_size=50)
    calls = [json.loads(line) for p in glob.glob(os.path.join(out, "*.jsonl")) for line in open(p)]
    want = {x["field"]: x["value"] for x in keyed.hset_rows(r).collect()}
    assert {f: v for _, f, v in calls} == want and len(calls) == len(want)

    # stream: each micro-batch is reduced to its last value per field and written once
    src = tmp_path / "src"
    src.mkdir()
    pdf = ev.toPandas().sort_values(["ts", "event_id"])
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    for i in range(3):
        p = str(src / f"part-{i}.parquet")
        pdf.iloc[i::3].to_parquet(p, index=False)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    for p in glob.glob(os.path.join(out, "*.jsonl")):
        os.replace(p, p + ".batch")
    stream = views.readings(read_parquet_stream(spark, str(src), ev.schema, max_files_per_trigger=1))
    q = (stream.writeStream.foreachBatch(keyed.foreach_batch_writer(
        lambda d: keyed.write_hset(d, client_factory=client_factory)))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = [json.loads(line) for p in glob.glob(os.path.join(out, "*.jsonl")) for line in open(p)]
    fields = {f for _, f, _ in streamed}
    assert fields == set(want)
    assert len(streamed) >= len(want)  # one write per field per batch that touched it
    assert all(isinstance(v, str) for _, _, v in streamed)
    assert r.select(F.countDistinct("id")).first()[0] == len(fields)
