"""Keyed-store sinks: relational upsert, hash-field store, document index.

Each sink is two parts:

1. a Spark transformation that shapes the rows (last write per key, ``(hash, field, value)`` triples, JSON documents)
   — checked against SQL like every other operator;
2. a thin writer run on the executors through ``foreachPartition`` (batch) or ``foreachBatch`` (stream), which opens
   one client per partition, writes in bulk batches and closes it.  Clients come from a caller-supplied factory, so
   the library holds no credentials and tests use in-memory fakes.

Last-write-wins reduction happens in Spark before the write (``max_by`` over ``(ts, event_id)``, a partial
aggregate, so a hot key costs one row per map task); each key is then written once per batch, which also makes a
replayed micro-batch idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, *, key: str = "id", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The last row per key in ``order`` (what an UPDATE-else-INSERT table holds after all writes)."""
    others = [c for c in df.columns if c != key]
    latest = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(latest.alias("_last")).select(key, *[F.col("_last")[c].alias(c) for c in others])


def hset_rows(df: DataFrame, *, hash_name: str = "sensor", key: str = "id", value: str = "temperature",
              order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """``HSET <hash> <field> <value>`` triples, last write per field."""
    last = latest_by_key(df.select(key, value, *order), key=key, order=order)
    return last.select(F.lit(hash_name).alias("hash"), F.col(key).alias("field"),
                       F.col(value).cast("string").alias("value"))


# A reading's text form is "(" id ", " epoch-ms ", " temperature ")", sent as field "data".
READING_OPEN, READING_SEP, READING_CLOSE = "(", ", ", ")"
DOCUMENT_FIELD = "data"


def reading_text(id_col="id", ts_col="ts", temp_col="temperature"):
    """A reading's text form ``(id, epoch_ms, temperature)``."""
    return F.concat(F.lit(READING_OPEN), F.col(id_col), F.lit(READING_SEP),
                    F.unix_millis(F.col(ts_col).cast("timestamp")).cast("string"), F.lit(READING_SEP),
                    F.col(temp_col).cast("string"), F.lit(READING_CLOSE))


def es_documents(df: DataFrame, *, index: str = "sensor") -> DataFrame:
    """Index requests ``(index, source, event_id)``, the id being the document's, where source is ``{"data": "<reading text>"}`` for every reading."""
    return df.select(F.lit(index).alias("index"), F.to_json(F.struct(reading_text().alias(DOCUMENT_FIELD))).alias("source"),
                     "event_id")


# --- writers ---------------------------------------------------------------------------------------------------------

def _batched(rows: Iterable, size: int):
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) >= size:
            yield buf
            buf = []
    if buf:
        yield buf


def upsert_partition(rows: Iterable, *, connect: Callable[[], object], table: str, key: str,
                     columns: Sequence[str], batch_size: int = 500) -> None:
    """UPDATE the keys that the table holds, INSERT the others; one DB-API connection per partition, commit per batch.

    A batch takes one SELECT of its keys and at most one ``executemany`` of either kind; of rows with the same key the
    last wins."""
    conn = connect()
    try:
        cur = conn.cursor()
        sets = ", ".join(f"{c} = ?" for c in columns if c != key)
        upd = f"UPDATE {table} SET {sets} WHERE {key} = ?"
        ins = f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join('?' for _ in columns)})"
        for chunk in _batched(rows, batch_size):
            new = {d[key]: d for d in (r.asDict() if hasattr(r, "asDict") else dict(r) for r in chunk)}
            cur.execute(f"SELECT {key} FROM {table} WHERE {key} IN ({', '.join('?' for _ in new)})", list(new))
            old = [new.pop(k[0]) for k in cur.fetchall()]
            if old:
                cur.executemany(upd, [[d[c] for c in columns if c != key] + [d[key]] for d in old])
            if new:
                cur.executemany(ins, [[d[c] for c in columns] for d in new.values()])
            conn.commit()
    finally:
        conn.close()


def write_upserts(df: DataFrame, *, connect: Callable[[], object], table: str, key: str = "id",
                  order: Sequence[str] = ("ts", "event_id"), batch_size: int = 500) -> None:
    rows = latest_by_key(df, key=key, order=order)
    cols = rows.columns
    rows.foreachPartition(lambda it: upsert_partition(it, connect=connect, table=table, key=key, columns=cols,
                                                      batch_size=batch_size))


def hset_partition(rows: Iterable, *, client_factory: Callable[[], object], batch_size: int = 500) -> None:
    client = client_factory()
    try:
        for chunk in _batched(rows, batch_size):
            pipe = client.pipeline() if hasattr(client, "pipeline") else client
            for r in chunk:
                pipe.hset(r["hash"], r["field"], r["value"])
            if pipe is not client:
                pipe.execute()
    finally:
        if hasattr(client, "close"):
            client.close()


def write_hset(df: DataFrame, *, client_factory: Callable[[], object], batch_size: int = 500, **kw) -> None:
    hset_rows(df, **kw).foreachPartition(lambda it: hset_partition(it, client_factory=client_factory,
                                                                  batch_size=batch_size))


def bulk_index_partition(rows: Iterable, *, client_factory: Callable[[], object], batch_size: int = 500) -> None:
    """Bulk requests ``(index, document id, source)``: the id is the event's, so a replayed batch replaces documents."""
    client = client_factory()
    try:
        for chunk in _batched(rows, batch_size):
            client.bulk([(r["index"], r["event_id"], r["source"]) for r in chunk])
    finally:
        if hasattr(client, "close"):
            client.close()


def write_documents(df: DataFrame, *, client_factory: Callable[[], object], index: str = "sensor",
                    batch_size: int = 500) -> None:
    es_documents(df, index=index).foreachPartition(
        lambda it: bulk_index_partition(it, client_factory=client_factory, batch_size=batch_size))


def foreach_batch_writer(write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """Adapt a batch writer for ``writeStream.foreachBatch`` (each micro-batch reduced and written once)."""
    return lambda batch_df, _epoch_id: write(batch_df)
