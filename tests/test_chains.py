"""Timer chains cut at arbitrary rows against the sequential folds, without and with Spark."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import cut
from eventspark.operators import chains, timers

SPECS = {"count": timers.periodic_counts_spec, "rise": timers.temp_rise_spec, "order": timers.order_timeout_spec}


def in_pieces(how, rows, cuts, gap, batch=3):
    """Results of the three passes over sorted ``rows`` (key, ts, kind, x), cut before the rows ``cuts``."""
    key = pa.string()
    seen = []
    for pid, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        own = rows[a:b]
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([pid] * len(part), pa.int64()), pa.array([r[0] for r in part], key), pa.array([r[1] for r in part], pa.int64()),
             pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.float64())],
            names=["pid", "key", "ts", "kind", "x"]) for part in (own[i:i + batch] for i in range(0, len(own), batch))]
        seen += [r for out in chains._piece_pass(how, gap)(iter(batches)) for r in out.to_pylist()]
    schema = pa.schema([("key", key), *[(c, pa.int64()) for c in chains._LONGS], *[(c, pa.float64()) for c in chains._DOUBLES]])

    def batched(found, more=()):
        cols = pa.schema([*schema, *more])
        return iter([pa.RecordBatch.from_pylist(found[i:i + batch], schema=cols) for i in range(0, len(found), batch)])

    border = [r for r in seen if r["tag"] in (chains._BORDER, chains._STEP)]
    border.sort(key=lambda r: (r["key"] is not None, r["key"] or "", r["pid"], r["seq"]))
    composed = [r for out in chains._compose(how, gap)(batched(border)) for r in out.to_pylist()]
    entry = {r["pid"]: r for r in composed if r["tag"] == chains._ENTRY}
    first = [r | {"timer": entry[r["pid"]]["a"], "count": entry[r["pid"]]["n"], "marks": entry[r["pid"]]["flag"],
                  "before": entry[r["pid"]]["x"]} for r in seen if r["tag"] == chains._ROW]
    first.sort(key=lambda r: (r["pid"], r["seq"]))
    more = [pa.field("timer", pa.int64()), pa.field("count", pa.int64()), pa.field("marks", pa.int64()), pa.field("before", pa.float64())]
    judged = [r for out in chains._entered(how, gap)(batched(first, more)) for r in out.to_pylist()]
    out = [r for r in seen + composed if r["tag"] == chains._RESULT] + judged
    if how == "order":
        return sorted(((r["key"], chains._VERDICTS[r["flag"]], r["a"], r["b"]) for r in out), key=str)
    return sorted(((r["key"], r["a"], *([r["n"]] if how == "count" else [])) for r in out), key=str)


def one_after_the_other(how, rows, gap):
    spec = SPECS[how](gap / 1_000_000)
    by_key = {}
    for k, ts, kind, x in rows:
        row = {"count": (ts,), "rise": (ts, x), "order": (ts, ["else", "create", "else", "pay"][kind])}[how]
        by_key.setdefault(k, []).append(row)
    out = []
    for k, own in by_key.items():
        state = spec.make()
        for row in own:
            out += [(k, *o) for o in spec.step(state, row)]
        out += [(k, *o) for o in spec.finish(state)]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", sorted(SPECS))
def test_any_cut_gives_the_rows_of_the_fold(how):
    rng = random.Random(how)
    for _ in range(600):
        gap, wide = rng.randrange(1, 12), rng.choice([3, 20, 60])
        rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.randrange(wide), 1 if how == "count" else rng.choice([0, 1, 1, 3]),
                 float(rng.randrange(4))) for _ in range(rng.randrange(1, 30))]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(0, 6))))
        assert in_pieces(how, rows, cuts, gap) == one_after_the_other(how, rows, gap), (rows, cuts, gap)


def test_border_functions_are_small_where_chains_meet():
    ts = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000))
    steps = chains._steps(ts[1:], np.full(len(ts) - 1, chains._ARM), int(ts[0]), 50_000)
    assert len(steps) < 20  # about a hundred rows lie within the gap


def test_runs_that_do_not_fit_one_time_axis():
    n = 64
    runs = chains._Runs(np.tile([0, 1 << 57], n), np.ones(2 * n, np.int64), np.arange(0, 2 * n, 2), 5)
    assert (runs.later == np.repeat(np.arange(n), 2) * 2 + np.tile([1, 2], n)).all()


@pytest.mark.parametrize("key", ["CAST(NULL AS DOUBLE)", "CAST('NaN' AS DOUBLE)", "struct(1 AS a)", "TIMESTAMP '2024-01-01'", "true"])
def test_keys_of_any_type(spark, key):
    cut(spark, 5)
    df = spark.range(200).select(F.expr(key).alias("id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
                                 F.col("id").alias("event_id"))
    got = timers.periodic_counts(df, period="9 seconds")
    assert got.schema["id"].dataType.simpleString() == df.schema["id"].dataType.simpleString()
    assert sorted(r["cnt"] for r in got.collect()) == list(range(10, 201, 10))


def test_a_chain_of_a_million_rows(spark):
    cut(spark, 6)
    df = spark.range(1_000_000).select(F.lit("hot").alias("id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
                                       F.col("id").alias("event_id"))
    got = timers.periodic_counts(df, period="500 milliseconds").select(F.unix_micros(F.col("fire_ts").cast("timestamp")).alias("us"), "cnt")
    wrong = got.filter((F.col("cnt") - 1) * 1_000_000 + 500_000 != F.col("us"))
    assert got.count() == 1_000_000 and wrong.count() == 0 and got.select("cnt").distinct().count() == 1_000_000
