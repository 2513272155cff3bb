"""Partial-state aggregates and window functions against plain groups, at any cut of the rows."""

from __future__ import annotations

import pickle
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import cut
from eventspark.functions.aggregates import Aggregate, WindowFunction, aggregate, window_process

TOP2 = Aggregate(lambda: (), lambda s, b: tuple(sorted([*s, *(v for v in b.column("v").to_pylist() if v is not None)])[-2:]),
                 lambda a, b: tuple(sorted([*a, *b])[-2:]), lambda s: list(s))


def running() -> WindowFunction:
    """The running sum beside each row's number, and at the end the count of rows."""
    def positions(state, batch):
        n, total = state
        out, sums = [], []
        for i, v in zip(batch.column("o").to_pylist(), batch.column("v").to_pylist(), strict=True):
            total += v or 0
            out.append(i)
            sums.append(total)
        return (n + batch.num_rows, total), pa.RecordBatch.from_pydict({"at": pa.array(out), "total": pa.array(sums, pa.int64())})

    return WindowFunction(lambda: (0, 0), positions, lambda a, b: (a[0] + b[0], a[1] + b[1]),
                          lambda s: pa.RecordBatch.from_pydict({"at": pa.array([-1]), "total": pa.array([s[0]])}))


def sample(spark, n=400, hot=0.5, seed=3):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < hot else rng.choice(["a", "b", None, "c"]), i, rng.choice([None, *range(50)])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, o long, v long")


def test_aggregate_of_a_hot_key(spark):
    df = sample(spark).repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = {r["k"]: r["top"] for r in aggregate(df, ["k"], TOP2, ["v"], "array<long>", "top", states_per_task=2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r["k"]: sorted(r["all"])[-2:] for r in df.groupBy("k").agg(F.collect_list("v").alias("all")).collect()}
    assert got == want
    assert aggregate(df.limit(0), ["k"], TOP2, ["v"], "array<long>", "top").count() == 0
    assert aggregate(df, [], TOP2, ["v"], "array<long>", "top").collect()[0]["top"] == sorted(
        r["v"] for r in df.collect() if r["v"] is not None)[-2:]


def test_only_states_are_shuffled(spark):
    plan = aggregate(sample(spark), ["k"], TOP2, ["v"], "array<long>", "top")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "MapInArrow partial" in plan[exchange:]


def test_order_of_merging_does_not_matter():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.choice([None, *range(30)]) for _ in range(rng.randrange(1, 40))]
        cuts = sorted(rng.sample(range(len(values) + 1), min(len(values), rng.randrange(0, 6))))
        parts = [values[a:b] for a, b in zip([0, *cuts], [*cuts, len(values)], strict=True)]
        states = [TOP2.accumulate(TOP2.zero(), pa.RecordBatch.from_pydict({"v": pa.array(p, pa.int64())})) for p in parts]
        rng.shuffle(states)
        while len(states) > 1:
            a, b = states.pop(rng.randrange(len(states))), states.pop()
            states.append(TOP2.merge(pickle.loads(pickle.dumps(a)), b))
        assert TOP2.finish(states[0]) == sorted(v for v in values if v is not None)[-2:]


@pytest.mark.parametrize("pieces,batch", [(2, 1000), (9, 4), (25, 1)])
def test_window_function_at_any_cut(spark, pieces, batch):
    cut(spark, pieces)
    df = sample(spark, 200).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted(map(tuple, window_process(df, ["k"], ["o"], running(), "at long, total long").collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("k", F.col("o").alias("at"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("total")).collect()
    want += df.groupBy("k").agg(F.lit(-1).alias("at"), F.count(F.lit(1)).alias("total")).collect()
    assert got == sorted(map(tuple, want), key=str)
    assert window_process(df.limit(0), ["k"], ["o"], running(), "at long, total long").count() == 0


def test_no_task_holds_a_group(spark):
    """One key with 300,000 rows: the largest batch that the function sees stays an Arrow batch."""
    cut(spark, 4)
    df = spark.range(300_000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    biggest = WindowFunction(lambda: 0, lambda s, b: (max(s, b.num_rows), None), max,
                             lambda s: pa.RecordBatch.from_pydict({"rows": pa.array([s])}))
    assert window_process(df, ["k"], ["o"], biggest, "rows long").collect()[0]["rows"] <= 10_000
    counted = Aggregate(lambda: 0, lambda s, b: s + b.num_rows, lambda a, b: a + b, lambda s: s)
    assert aggregate(df, ["k"], counted, ["o"], "long", "n").collect()[0]["n"] == 300_000


@pytest.mark.parametrize("key", ["CAST('NaN' AS DOUBLE)", "CAST(NULL AS STRING)", "struct(1 AS a, 'x' AS b)", "DATE '2024-01-01'", "true"])
def test_keys_of_any_type(spark, key):
    df = spark.range(100).select(F.expr(key).alias("k"), F.col("id").alias("v"), F.col("id").alias("o"))
    total = Aggregate(lambda: 0, lambda s, b: s + pc.sum(b.column("v")).as_py(), lambda a, b: a + b, lambda s: s)
    assert [r["n"] for r in aggregate(df, ["k"], total, ["v"], "long", "n").collect()] == [4950]
    out = window_process(df, ["k"], ["o"], running(), "at long, total long").filter("at = 99").collect()
    assert [r["total"] for r in out] == [4950]
