"""Edge cases from FIXTURES.md: empty input, NULL keys and values, duplicate timestamps within a key."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import cut, ms, rows
from eventspark.operators import control, joins, patterns, rolling, scan, timers, topn, windows

READING_SCHEMA = "id string, ts timestamp_ntz, temperature double, event_id long"
ORDER_SCHEMA = "order_id string, order_type string, ts timestamp_ntz, event_id long"


def test_empty_inputs(spark):
    r = spark.createDataFrame([], READING_SCHEMA)
    assert rolling.running_max(r).count() == 0
    assert timers.periodic_counts(r, period="10 seconds").count() == 0
    assert timers.temp_rise_alerts(r).count() == 0
    assert windows.minmax_per_window(r).count() == 0
    assert control.gate_by_switch(r, spark.createDataFrame([], "id string, ts timestamp_ntz, event_id long")).count() == 0
    o = spark.createDataFrame([], ORDER_SCHEMA)
    assert timers.order_timeout_state(o).count() == 0
    assert patterns.order_timeout_pattern(o).count() == 0
    keyed = spark.createDataFrame([], "order_id string, ts timestamp_ntz, event_id long")
    assert joins.reconcile(keyed, keyed, key="order_id").count() == 0
    b = spark.createDataFrame([], "item_id long, behavior string, ts timestamp_ntz")
    assert topn.hot_items(b).count() == 0


def test_null_keys_group_together_and_null_values(spark):
    data = [(None, 0, 5.0), (None, 1000, 7.0), ("a", 0, None), ("a", 1000, 3.0), ("a", 2000, 1.0)]
    r = spark.createDataFrame([(k, ms(t), v, i) for i, (k, t, v) in enumerate(data)], READING_SCHEMA)
    got = rows(rolling.running_max(r), "id", "ts", "running_max")
    assert got == [(None, ms(0), 5.0), (None, ms(1000), 7.0), ("a", ms(0), None), ("a", ms(1000), 3.0),
                   ("a", ms(2000), 3.0)]
    mm = windows.minmax_per_window(r, size="5 seconds").collect()
    assert {(x["id"], x["min_temp"], x["max_temp"]) for x in mm} == {(None, 5.0, 7.0), ("a", 1.0, 3.0)}


@pytest.mark.parametrize("pieces", [None, 3])
def test_prefix_scan_null_keys_across_pieces(spark, monkeypatch, pieces):
    if pieces:
        cut(spark, 12)
    df = spark.range(0, 400).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 2).cast("string"))
                                    .alias("k"), F.col("id").alias("o"))
    got = scan.running_count(df, key="k", order=["o"], out="rn")
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("k", "o", F.row_number().over(w).cast("bigint").alias("rn"))
    assert sorted(map(tuple, got.select("k", "o", "rn").collect()), key=str) == sorted(
        map(tuple, want.collect()), key=str)


def test_duplicate_timestamps_within_key_ordered_by_id(spark):
    # create and pay at the same instant: the pay with the lower id comes first and is an orphan; the later one pays
    o = spark.createDataFrame([("o", "pay", ms(1000), 1), ("o", "create", ms(1000), 2), ("o", "pay", ms(1000), 3)],
                              ORDER_SCHEMA)
    assert rows(timers.order_timeout_state(o, timeout="5 seconds"), "result", "event_ts") == [
        ("orphan_pay", ms(1000)), ("payed", ms(1000))]
    r = spark.createDataFrame([("s", ms(0), 1.0, 2), ("s", ms(0), 9.0, 1), ("s", ms(0), 4.0, 3)], READING_SCHEMA)
    assert rows(rolling.running_max(r), "event_id", "running_max") == [(1, 9.0), (2, 9.0), (3, 9.0)]


def test_timer_chains_with_null_keys(spark):
    data = [(None, 0), (None, 3000), (None, 12000), ("a", 0), ("a", 20000)]
    r = spark.createDataFrame([(k, ms(t), 1.0, i) for i, (k, t) in enumerate(data)], READING_SCHEMA)
    assert rows(timers.periodic_counts(r, period="10 seconds"), "id", "fire_ts", "cnt") == [
        (None, ms(10000), 2), (None, ms(22000), 3), ("a", ms(10000), 1), ("a", ms(30000), 2)]
    o = spark.createDataFrame([(None, "create", ms(0), 1), (None, "pay", ms(1000), 2), (None, "create", ms(9000), 3)],
                              ORDER_SCHEMA)
    assert rows(timers.order_timeout_state(o, timeout="5 seconds"), "result", "event_ts") == [
        ("not_payed", ms(14000)), ("payed", ms(1000))]


def test_timers_keep_big_integer_keys_beside_nulls(spark):
    big = 9007199254740993
    data = [(big, 0), (big, 1000), (None, 0), (None, 2000), (None, 3000)]
    r = spark.createDataFrame([(k, ms(t), 1.0, i) for i, (k, t) in enumerate(data)],
                              READING_SCHEMA.replace("id string", "id long"))
    assert rows(timers.periodic_counts(r, period="10 seconds"), "id", "fire_ts", "cnt") == [
        (None, ms(10000), 3), (big, ms(10000), 2)]


def test_rise_alert_ignores_missing_readings(spark):
    data = [(0, 1.0), (1000, 2.0), (1500, None), (1800, 1.5), (3000, 4.0), (3500, None)]
    r = spark.createDataFrame([("s", ms(t), v, i) for i, (t, v) in enumerate(data)], READING_SCHEMA)
    assert rows(timers.temp_rise_alerts(r, rise_for="1 second"), "alert_ts") == [(ms(4000),)]


def test_reconcile_null_key_matches_within_key(spark):
    orders = spark.createDataFrame([(None, ms(1000), 1)], "order_id string, ts timestamp_ntz, event_id long")
    pays = spark.createDataFrame([(None, ms(2000), 2)], "order_id string, ts timestamp_ntz, event_id long")
    assert rows(joins.reconcile(orders, pays, key="order_id", tolerance="5 seconds"), "order_id", "tag") == [
        (None, "matched")]


def test_prefix_scan_literal_boundaries_awkward_values(spark, monkeypatch):
    """Boundary literals with quotes, backslashes, non-ASCII text, NaN and NTZ timestamps still cut pieces exactly."""
    cut(spark, 12)
    keys = ["a'b", "c\\\\d", "é\U0001F600", "plain", None]
    df = spark.range(0, 1000).select(
        F.element_at(F.array(*[F.lit(k) for k in keys]), (F.col("id") % 5 + 1).cast("int")).alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 3.0).alias("d"),
        F.timestamp_seconds(F.col("id") * 61).cast("timestamp_ntz").alias("t"), F.col("id").alias("o"))
    got = scan.prefix_scan(df, key="k", order=["d", "t", "o"], values=[("c", F.lit(1).cast("bigint"), "sum")])
    w = Window.partitionBy("k").orderBy("d", "t", "o")
    want = df.select("k", "o", F.row_number().over(w).cast("bigint").alias("c"))
    assert rows(got, "k", "o", "c") == rows(want, "k", "o", "c")


def test_partition_scoped_increment_keeps_big_integers_beside_nulls(spark):
    from eventspark.functions import udfs
    big = 9007199254740993
    df = spark.createDataFrame([(1, big), (2, None)], "event_id long, user_id long")
    got = sorted(tuple(r) for r in udfs.partition_scoped_increment(df, "user_id", 1, out="more").collect())
    assert got == [(1, big, big + 1), (2, None, None)]


def test_lifecycle_opens_and_closes_once_per_task(spark, tmp_path):
    import os
    import uuid
    from eventspark.functions import udfs

    folder = str(tmp_path)

    def note(what):
        open(os.path.join(folder, f"{what}-{uuid.uuid4()}"), "w").close()

    df = spark.range(100, numPartitions=3)
    out = udfs.map_partitions_with_lifecycle(df, lambda b, ctx: b, df.schema, open_fn=lambda: note("open"),
                                             close_fn=lambda ctx: note("close"))
    assert out.count() == 100
    kinds = [x.split("-")[0] for x in os.listdir(folder)]
    assert kinds.count("open") == kinds.count("close") == 3


def test_uv_ignores_null_users_and_states_a_full_bitmap(spark):
    from eventspark.operators import distinct
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts, CAST(x AS BIGINT) AS user_id "
                   "FROM VALUES (NULL), (1) AS t(x)")
    assert [r["uv"] for r in distinct.uv_exact(df).collect()] == [1]
    assert [r["uv"] for r in distinct.uv_bloom(df).collect()] == [1]
    many = spark.range(20_000).selectExpr("timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id")
    assert distinct.uv_bloom(many, expected=200).first()["uv"] > 200
    none = df.where("user_id IS NULL")
    assert [r["uv"] for r in distinct.uv_bloom(none).collect()] == [0]


def test_allowed_lateness_null_key(spark):
    from eventspark.operators import replay
    rows = [(a, k, t) for k in ("x", None) for a, t in ((1, 1), (2, 11), (3, 2))]
    df = spark.createDataFrame([(i, k, a, t) for i, (a, k, t) in enumerate(sorted(rows, key=lambda r: r[0]))],
                               "event_id long, key string, arrival long, t long")
    df = df.selectExpr("event_id", "key", "arrival", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, t) AS ts")
    out = replay.allowed_lateness(df, key="key", size="5 seconds", bound="0 seconds", lateness="10 seconds").collect()
    per = {k: sorted((r["firing"], r["kind"], r["cnt"]) for r in out if r["key"] == k and r["window_end"].second == 5)
           for k in ("x", None)}
    assert per["x"] == per[None] and len(per["x"]) == 2


def test_changelog_retention_ignores_late_rows_of_dropped_windows(spark, tmp_path):
    from eventspark.streaming.changelog import topn_changelog_handler
    from eventspark.streaming.versions import versions
    out = []
    state = f"file:{tmp_path}/state"
    h = topn_changelog_handler(lambda df, b: out.append(rows(df, "is_add", "item_id", "cnt")), state, n=2, size="1 hour",
                               slide="1 hour", retention="2 hours")

    def batch(*data):
        return spark.createDataFrame([(i, ms(m * 60_000)) for i, m in data], "item_id long, ts timestamp_ntz")

    h(batch((1, 0), (1, 1), (1, 2)), 0)
    h(batch((2, 600)), 1)  # ten hours on: the first window leaves the state
    h(batch((1, 3)), 2)
    h(batch((2, 601)), 3)
    assert out == [[(True, 1, 3)], [(True, 2, 1)], [], [(False, 2, 1), (True, 2, 2)]]
    assert versions(spark, state) == [2, 3]


def test_an_empty_state_version_is_the_newest(spark, tmp_path):
    from eventspark.streaming.versions import version_before, write_version
    path = str(tmp_path / "state")
    one = spark.range(3)
    write_version(one, path, 0)
    write_version(one.limit(0), path, 1)
    assert version_before(spark, path, 1).count() == 3
    assert version_before(spark, path, 2).count() == 0
    assert version_before(spark, path, 0) is None


def test_changelog_counts_repeats_and_nulls(spark):
    from eventspark.operators.topn import changelog

    prev = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None)], "k long, v string")
    curr = spark.createDataFrame([(1, "a"), (3, None), (3, None), (4, "d")], "k long, v string")
    got = sorted(tuple(r) for r in changelog(prev, curr).fillna("-").collect())
    assert got == [(False, 1, "a"), (False, 2, "-"), (True, 3, "-"), (True, 4, "d")]


def test_rows_without_time_change_nothing(spark):
    from eventspark.operators import timers

    schema = "id string, ts timestamp_ntz, event_id long, temperature double"
    rows = spark.sql("""SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-01 00:00:00', 1L, 1.0D),
        ('a', timestamp_ntz'2024-01-01 00:00:04', 2L, 2.0D), ('a', timestamp_ntz'2024-01-01 00:00:12', 3L, 3.0D),
        (NULL, timestamp_ntz'2024-01-01 00:00:01', 4L, 5.0D) AS t(id, ts, event_id, temperature)""")
    more = rows.union(spark.createDataFrame([("a", None, 9, 0.5), (None, None, 10, 0.5)], schema))
    for op in (timers.periodic_counts, timers.temp_rise_alerts):
        want, got = (sorted(map(str, op(x).collect())) for x in (rows, more))
        assert want == got
    counts = {(r["id"], str(r["fire_ts"]), r["cnt"]) for r in timers.periodic_counts(rows).collect()}
    assert counts == {("a", "2024-01-01 00:00:10", 2), ("a", "2024-01-01 00:00:22", 3), (None, "2024-01-01 00:00:11", 1)}


def test_size_estimates_stay_those_of_the_files(spark):
    """Twenty rounds of joining a frame with its own aggregate, each written: the planner's estimate does not grow."""
    import gc
    import os
    from eventspark import session
    df = spark.range(500).select("id", F.lit(None).alias("nothing"), (F.col("id") % 7).alias("k"))
    out = first = session.reliable_checkpoint(df)

    def estimate(frame):
        return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    for _ in range(20):
        top = out.groupBy("k").agg(F.max("id").alias("m"))
        out = session.reliable_checkpoint(out.join(top, "k").select(F.least("id", "m").alias("id"), "nothing", "k"))
    assert estimate(out) < 100 * estimate(first)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect())) and out.schema.simpleString() == df.schema.simpleString()
    folders = [f for _, f in session._written[-10:]]
    del top
    gc.collect()
    for _ in range(20):  # folders that no plan reads go, the one that is still read stays
        spark._jvm.System.gc()
        session._remove_unread(spark)
    kept = [f for f in folders if os.path.exists(f.replace("file:", ""))]
    assert folders[-1] in kept and len(kept) < len(folders) and out.count() == 500
