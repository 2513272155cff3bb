"""User-defined aggregates and window functions over groups of any size, by partial states.

Both contracts are Python objects with a small picklable state; rows reach them as Arrow batches of one group.

* :class:`Aggregate` (order does not matter): every input task accumulates its rows into one state per group and hands
  on only the states, which a second step merges as a stream.  A group that holds a third of all rows is accumulated by
  all tasks; the task that merges it sees one state per input task.
* :class:`WindowFunction` (rows in order, output at any row or at the group's end): rows are cut into range pieces over
  ``(keys, order)``, so a large group spans many of them.  A piece runs its groups row batch by row batch, holding one
  state; of its first group, which may have begun in an earlier piece, it keeps the rows and the state they lead to by
  themselves.  Those states, one or two a piece, are merged in order into the state that enters each piece, and the
  first groups run from there.  No task holds a group.

NULL and NaN keys are groups of their own; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import reliable_checkpoint
from .runs import run_starts, same_key


_STATE = "partial state of the group"  # beside the caller's key columns


@dataclass(frozen=True)
class Aggregate:
    """``accumulate(state, batch)`` adds rows of one group, ``merge(a, b)`` joins two states in either order, and
    ``finish(state)`` gives the result."""
    zero: Callable[[], object]
    accumulate: Callable[[object, pa.RecordBatch], object]
    merge: Callable[[object, object], object]
    finish: Callable[[object], object]


@dataclass(frozen=True)
class WindowFunction:
    """``step(state, batch)`` sees the next rows of a group and returns the new state and output rows or None (it may be
    called for the same rows twice, from different states);
    ``merge(earlier, later)`` joins the states of two neighbouring stretches of a group, the later one begun from ``zero``;
    ``finish(state)`` gives the output rows at the group's end, or None."""
    zero: Callable[[], object]
    step: Callable[[object, pa.RecordBatch], tuple[object, pa.RecordBatch | None]]
    merge: Callable[[object, object], object]
    finish: Callable[[object], pa.RecordBatch | None]


def _grouped(columns: list[pa.Array]) -> Iterator[pa.Array]:
    """Row numbers of each group of equal keys."""
    code = np.zeros(len(columns[0]), np.int64)
    for col in columns:
        if pa.types.is_nested(col.type):
            seen: dict[str, int] = {}
            own = np.array([seen.setdefault(repr(v), len(seen)) for v in col.to_pylist()], np.int64)
        else:
            own = col.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, code = np.unique(code * (int(own.max(initial=0)) + 1) + own, return_inverse=True)
    order = np.argsort(code, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        yield pa.array(part)


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregate, columns: Sequence[str], return_type: str, out: str,
              states_per_task: int = 10_000) -> DataFrame:
    """``keys`` and the aggregate ``out`` of ``columns`` per group.  A task hands its states on whenever it holds
    ``states_per_task`` of them."""
    keys, columns = list(keys), list(columns)
    rows = df.select(*keys, *columns)
    key_fields = rows.schema.fields[:len(keys)]

    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def flush(types) -> pa.RecordBatch:
            ks = [pa.concat_arrays([h[0][i] for h in held.values()]) for i in range(len(types))]
            states = pa.array([pickle.dumps(h[1]) for h in held.values()], pa.binary())
            held.clear()
            return pa.RecordBatch.from_arrays([*ks, states], names=[*keys, _STATE])

        for batch in it:
            if not batch.num_rows:
                continue
            ks, values = batch.columns[:len(keys)], batch.select(columns)
            for rows_ in _grouped(ks) if keys else [pa.array(np.arange(batch.num_rows))]:
                own = [k.take(rows_[:1]) for k in ks]
                name = pickle.dumps([k[0].as_py() for k in own])
                mine = held.setdefault(name, [own, agg.zero()])
                mine[1] = agg.accumulate(mine[1], values.take(rows_))
            if len(held) >= states_per_task:
                yield flush(ks)
        if held:
            yield flush(next(iter(held.values()))[0])

    def merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in it:
            done_keys, done = [], []
            ks = batch.columns[:len(keys)]
            starts = set(run_starts(*ks).tolist()) if batch.num_rows and ks else {0}
            for i in range(batch.num_rows):
                one = pickle.loads(batch.column(len(keys))[i].as_py())
                own = [k[i:i + 1] for k in ks]
                if last is None or (i in starts and (i or not same_key(last, own))):
                    if last is not None:
                        done_keys.append(last)
                        done.append(agg.finish(state))
                    last, state = own, one
                else:
                    state = agg.merge(state, one)
            if done:
                yield ended(done_keys, done)
        if last is not None:
            yield ended([last], [agg.finish(state)])

    def ended(done_keys, done) -> pa.RecordBatch:
        cols = [pa.concat_arrays([k[i] for k in done_keys]) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(done, pa_type)], names=[*keys, out])

    schema = T.StructType([*key_fields, T.StructField(out, T._parse_datatype_string(return_type))])
    pa_type = to_arrow_type(schema[out].dataType)
    states = rows.mapInArrow(partial, T.StructType([*key_fields, T.StructField(_STATE, T.BinaryType())]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = states.repartition(n, *keys).sortWithinPartitions(*keys) if keys else states.repartition(1)
    return dealt.mapInArrow(merged, schema)


# what a row of the window passes is: output, a row of a first group, the state after a first or a last one, an entry
_OUT, _ROW, _FIRST, _LAST, _ENTRY = range(5)


class _Emit:
    """Batches of the passes' mixed rows ``(tag, pid, seq, k, state, row, out)``."""

    def __init__(self, k: pa.DataType, row: pa.DataType, out: pa.DataType):
        self.schema = pa.schema([("tag", pa.int32()), ("pid", pa.int64()), ("seq", pa.int64()), ("k", k),
                                 ("state", pa.binary()), ("row", row), ("out", out)])

    def batch(self, size: int, **columns) -> pa.RecordBatch:
        cols = []
        for f in self.schema:
            v = columns.get(f.name)
            cols.append(v if isinstance(v, pa.Array) else pa.array([v] * size, f.type))
        return pa.RecordBatch.from_arrays(cols, schema=self.schema)

    def out(self, key: pa.Array, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is not None and rows.num_rows:
            kind = self.schema.field("out").type
            cols = [rows.column(rows.schema.get_field_index(f.name)).cast(f.type) for f in kind]
            yield self.batch(rows.num_rows, tag=_OUT, k=key.take(pa.array(np.zeros(rows.num_rows, np.int64))),
                             out=pa.StructArray.from_arrays(cols, fields=list(kind)))


def _stretches(batch: pa.RecordBatch, last: pa.Array | None) -> Iterator[tuple[bool, int, int, pa.Array]]:
    """``(new, from, to, key)`` of the runs of a batch; ``new``: not a continuation of ``last``."""
    k = batch.column(batch.schema.get_field_index("k"))
    if not len(k):
        return
    cuts = [*run_starts(*k.flatten()).tolist(), len(k)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        key = k.slice(a, 1)
        yield (a > 0 or last is None or not same_key(last.flatten(), key.flatten())), a, b, key


def _records(struct: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_struct_array(struct)


def window_process(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: WindowFunction, schema: str) -> DataFrame:
    """``keys`` and the rows of ``schema`` that ``fn`` gives for each group, whose rows it sees in ``order`` (which must
    make them unique, or rows of equal order come in any order)."""
    keys, order = list(keys), list(order)
    values = [c for c in df.columns if c not in keys]
    out_type = T._parse_datatype_string(schema)
    pieces = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = df.repartitionByRange(pieces, *keys, *order).sortWithinPartitions(*keys, *order).select(
        F.spark_partition_id().cast("long").alias("pid"), F.struct(*keys).alias("k"), F.struct(*values).alias("row"))
    mixed = T.StructType([T.StructField("tag", T.IntegerType()), T.StructField("pid", T.LongType()),
                          T.StructField("seq", T.LongType()), T.StructField("k", cut.schema["k"].dataType),
                          T.StructField("state", T.BinaryType()), T.StructField("row", cut.schema["row"].dataType),
                          T.StructField("out", out_type)])
    out_arrow = to_arrow_type(out_type)

    def emitter(batch: pa.RecordBatch) -> _Emit:
        return _Emit(batch.schema.field("k").type, batch.schema.field("row").type, out_arrow)

    def piece(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, runs, seq, pid, emit = None, None, 0, 0, None, None
        for batch in it:
            emit = emit or emitter(batch)
            for new, a, b, own in _stretches(batch, key):
                pid = batch.column(0)[a].as_py()
                if new:
                    if runs == 1:
                        yield emit.batch(1, tag=_FIRST, pid=pid, seq=-1, k=key, state=pa.array([pickle.dumps(state)], pa.binary()))
                    elif runs:
                        yield from emit.out(key, fn.finish(state))
                    key, state, runs = own, fn.zero(), runs + 1
                part = batch.slice(a, b - a)
                rows = part.column(part.schema.get_field_index("row"))
                state, given = fn.step(state, _records(rows))
                if runs == 1:  # run again when the state before it is known
                    yield emit.batch(b - a, tag=_ROW, pid=pid, seq=pa.array(np.arange(seq, seq + b - a)),
                                     k=part.column(part.schema.get_field_index("k")), row=rows)
                    seq += b - a
                else:
                    yield from emit.out(key, given)
        if runs:
            yield emit.batch(1, tag=_FIRST if runs == 1 else _LAST, pid=pid, seq=-1, k=key,
                             state=pa.array([pickle.dumps(state)], pa.binary()))

    def compose(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, emit = None, None, None
        for batch in it:
            emit = emit or emitter(batch)
            for new, a, b, own in _stretches(batch, key):
                if new:
                    if key is not None:
                        yield from emit.out(key, fn.finish(state))
                    key, state = own, None
                for i in range(a, b):
                    part = pickle.loads(batch.column(batch.schema.get_field_index("state"))[i].as_py())
                    if batch.column(0)[i].as_py() == _FIRST:
                        before = fn.zero() if state is None else state
                        yield emit.batch(1, tag=_ENTRY, pid=batch.column(1)[i].as_py(), seq=-1, k=own,
                                         state=pa.array([pickle.dumps(before)], pa.binary()))
                    state = part if state is None else fn.merge(state, part)
        if key is not None:
            yield from emit.out(key, fn.finish(state))

    def entered(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, emit = None, None
        for batch in it:
            emit = emit or emitter(batch)
            tag, pid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((tag[1:] != tag[:-1]) | (pid[1:] != pid[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(tag)], strict=True):
                if b == a:
                    continue
                if tag[a] == _ENTRY:
                    state = pickle.loads(batch.column(batch.schema.get_field_index("state"))[a].as_py())
                    continue
                part = batch.slice(a, b - a)
                state, given = fn.step(state, _records(part.column(part.schema.get_field_index("row"))))
                yield from emit.out(part.column(part.schema.get_field_index("k")).slice(0, 1), given)

    seen = reliable_checkpoint(cut.mapInArrow(piece, mixed))
    borders = seen.where(F.col("tag").isin(_FIRST, _LAST)).repartition(pieces, *[F.col(f"k.`{c}`") for c in keys])
    composed = reliable_checkpoint(borders.sortWithinPartitions(*[F.col(f"k.`{c}`") for c in keys], "pid").mapInArrow(compose, mixed))
    firsts = seen.where(F.col("tag") == _ROW).union(composed.where(F.col("tag") == _ENTRY))
    firsts = firsts.repartition(pieces, "pid").sortWithinPartitions("pid", "seq").mapInArrow(entered, mixed)
    done = F.col("tag") == _OUT
    return seen.where(done).union(composed.where(done)).union(firsts).select(
        *[F.col(f"k.`{c}`") for c in keys], *[F.col(f"out.`{f.name}`") for f in out_type.fields])
