"""Exactly-once writes to a keyed store: a Python ``DataSource`` whose tasks stage and whose driver publishes.

Each task stages its rows under a token of its own and hands the token on as its commit message.  Only when all tasks of
a batch have succeeded does the driver publish the staged rows, in one step of the store, together with the batch's
number; a batch that the store has already published is not published again.  What failed or repeated tasks staged is
never published, and goes with the batch (a task that outlives its aborted job may leave rows, which stay out of sight).
So a failed task, a failed job and a replayed batch id all leave the store as one clean run would.

The store is reached through a client that ``open_store()`` makes, in tasks and on the driver:

* ``stage(job, token, rows)`` keeps ``rows``, a list of dicts, out of sight;
* ``publish(staged, batch)`` makes the rows of those ``(job, token)`` pairs visible, last write per key, and remembers
  ``batch`` (None: not numbered); it does nothing for a batch at or below the last one remembered;
* ``discard(job)`` forgets whatever the job still has staged;
* ``close()``.

:class:`DbApiStore` is such a client for any DB-API 2.0 connection.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from .keyed import _batched, latest_by_key


@dataclass
class Staged(WriterCommitMessage):
    job: str
    token: str
    rows: int


class _StagedWriter:
    """What batch and stream writers share; ``self.open_store`` and ``self.batch_size`` are the source's."""

    def __init__(self, open_store: Callable[[], object], batch_size: int):
        self.open_store, self.batch_size, self.job = open_store, batch_size, uuid.uuid4().hex

    def _with(self, act: Callable):
        store = self.open_store()
        try:
            return act(store)
        finally:
            store.close()

    def write(self, iterator: Iterator) -> Staged:
        token, n = uuid.uuid4().hex, 0

        def stage(store):
            nonlocal n
            for chunk in _batched(iterator, self.batch_size):
                store.stage(self.job, token, [r.asDict(recursive=True) for r in chunk])
                n += len(chunk)
        self._with(stage)
        return Staged(self.job, token, n)

    def _jobs(self, messages: list) -> list[str]:
        """The jobs that staged: Spark may commit with another copy of the writer than the tasks wrote with."""
        return sorted({m.job for m in messages if m is not None} | {self.job})

    def _publish(self, messages: list, batch: int | None) -> None:
        def publish(store):
            store.publish([(m.job, m.token) for m in messages if m is not None], batch)
            for job in self._jobs(messages):
                store.discard(job)
        self._with(publish)

    def _discard(self, messages: list) -> None:
        self._with(lambda store: [store.discard(job) for job in self._jobs(messages)])


class _BatchWriter(_StagedWriter, DataSourceWriter):
    def commit(self, messages: list) -> None:
        self._publish(messages, None)

    def abort(self, messages: list) -> None:
        self._discard(messages)


class _StreamWriter(_StagedWriter, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._discard(messages)


def register_store(spark: SparkSession, name: str, open_store: Callable[[], object], batch_size: int = 500) -> None:
    """Make ``df.write.format(name)`` and ``df.writeStream.format(name)`` write to the store."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool):
            return _BatchWriter(open_store, batch_size)

        def streamWriter(self, schema, overwrite: bool):
            return _StreamWriter(open_store, batch_size)

    spark.dataSource.register(Source)


def write_latest(df: DataFrame, name: str, *, key: str = "id", order: Sequence[str] = ("ts", "event_id")) -> None:
    """Write the last row per key to a registered store, all or nothing."""
    latest_by_key(df, key=key, order=order).write.format(name).mode("append").save()


class DbApiStore:
    """Staging, publishing and batch numbers in three tables of one database; a publication is one transaction.

    ``<table>_staged (job, token, line)`` and ``<table>_batches (target, batch)`` are made where missing.  ``key`` and
    ``columns`` name the target's columns; of two rows of a key the one greater by ``order`` stays, also against what the
    table holds."""

    def __init__(self, connect: Callable[[], object], table: str, key: str, columns: Sequence[str], order: Sequence[str] = ()):
        self.conn, self.table, self.key, self.columns, self.order = connect(), table, key, list(columns), list(order)
        cur = self.conn.cursor()
        cur.execute(f"CREATE TABLE IF NOT EXISTS {table}_staged (job TEXT, token TEXT, line TEXT)")
        cur.execute(f"CREATE TABLE IF NOT EXISTS {table}_batches (target TEXT, batch INTEGER)")
        self.conn.commit()

    def stage(self, job: str, token: str, rows: list[dict]) -> None:
        self.conn.cursor().executemany(f"INSERT INTO {self.table}_staged VALUES (?, ?, ?)",
                                       [(job, token, json.dumps(r, default=str)) for r in rows])
        self.conn.commit()

    def publish(self, staged: list[tuple[str, str]], batch: int | None) -> None:
        cur, t = self.conn.cursor(), self.table
        if batch is not None:
            cur.execute(f"SELECT MAX(batch) FROM {t}_batches WHERE target = ?", [t])
            last = cur.fetchone()[0]
            if last is not None and batch <= last:
                return
            cur.execute(f"INSERT INTO {t}_batches VALUES (?, ?)", [t, batch])
        marks = ", ".join("?" for _ in self.columns)
        sets = ", ".join(f"{c} = ?" for c in self.columns if c != self.key)
        newer = " AND ".join([f"{self.key} = ?"] + ([f"({', '.join(self.order)}) <= ({', '.join('?' for _ in self.order)})"]
                                                    if self.order else []))
        for job, token in staged:
            rows = self.conn.cursor()
            rows.execute(f"SELECT line FROM {t}_staged WHERE job = ? AND token = ?", [job, token])
            while lines := rows.fetchmany(500):
                for r in (json.loads(line[0]) for line in lines):
                    cur.execute(f"SELECT 1 FROM {t} WHERE {self.key} = ?", [r[self.key]])
                    if cur.fetchone():
                        cur.execute(f"UPDATE {t} SET {sets} WHERE {newer}",
                                    [*[r[c] for c in self.columns if c != self.key], r[self.key], *[r[c] for c in self.order]])
                    else:
                        cur.execute(f"INSERT INTO {t} ({', '.join(self.columns)}) VALUES ({marks})", [r[c] for c in self.columns])
        self.conn.commit()  # the rows and the batch's number together

    def discard(self, job: str) -> None:
        self.conn.cursor().execute(f"DELETE FROM {self.table}_staged WHERE job = ?", [job])
        self.conn.commit()

    def close(self) -> None:
        self.conn.rollback()
        self.conn.close()
