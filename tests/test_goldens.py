"""Golden tests on the reference's inline rows (FIXTURES.md); expected rows were derived by reading its code."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import ms, rows
from eventspark.functions import hashing, udfs
from eventspark.operators import control, joins, patterns, rolling, text, timers, transforms


def test_word_count_final_and_running(spark):
    docs = spark.createDataFrame([(1, "Hello World"), (2, "Hello World")], "doc_id long, text string")
    assert rows(text.word_count(docs), "word", "cnt") == [("Hello", 2), ("World", 2)]
    run = rolling.running_word_count(docs)
    assert rows(run, "word", "doc_id", "running_cnt") == [("Hello", 1, 1), ("Hello", 2, 2),
                                                          ("World", 1, 1), ("World", 2, 2)]


def test_java_whitespace_split_rules(spark):
    docs = spark.createDataFrame([(1, "a  b "), (2, "   "), (3, ""), (4, "\tx")], "doc_id long, text string")
    toks = rows(text.tokens(docs), "doc_id", "pos", "word")
    # inner empty token kept, trailing dropped; blank-only gives none; "" gives one empty token
    assert toks == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (3, 0, ""), (4, 0, ""), (4, 1, "x")]


def test_replicate_by_value(spark):
    df = spark.createDataFrame([("white",), ("black",), ("gray",)], "v string")
    out = transforms.replicate_by_value(df, "v", {"white": 1, "black": 2}, default=0)
    assert rows(out, "v") == [("black",), ("black",), ("white",)]


def test_co_flat_map(spark):
    left = spark.createDataFrame([(1, "aaaaa"), (2, "bbbbb")], "k int, v string")
    right = spark.createDataFrame([(1, "ccccc"), (2, "ddddd")], "k int, v string")
    out = transforms.co_flat_map(left, right, left_copies=2, right_copies=1)
    assert rows(out, "v", "side") == [("aaaaa", "left")] * 2 + [("bbbbb", "left")] * 2 + [
        ("ccccc", "right"), ("ddddd", "right")]


def test_partition_scoped_map(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert rows(udfs.partition_scoped_increment(df, "v", 1), "v") == [(2,), (3,), (4,)]


def test_side_output_and_union(spark):
    df = spark.createDataFrame([("s1", 10.0), ("s2", 40.0)], "id string, temperature double")
    out = transforms.tag_split(df, F.col("temperature") < 32.0)
    assert rows(out, "id", "tag") == [("s1", "main"), ("s1", "side"), ("s2", "main")]
    assert transforms.union_all(df, df).count() == 4


def _logins(spark, data):
    return spark.createDataFrame([(u, ip, t, ms(ts), i) for i, (u, ip, t, ts) in enumerate(data)],
                                 "user_id string, ip_address string, event_type string, ts timestamp_ntz, event_id long")


def test_login_fail_3(spark):
    df = _logins(spark, [("user_1", "0.0.0.0", "fail", 2000), ("user_1", "0.0.0.1", "fail", 3000),
                         ("user_1", "0.0.0.2", "fail", 4000)])
    out = patterns.login_fail_3(df, within="5 seconds")
    assert rows(out, "user_id", "ip1", "ip2", "ip3") == [("user_1", "0.0.0.0", "0.0.0.1", "0.0.0.2")]


def test_login_fail_3_intervening_and_boundary(spark):
    # an intervening success breaks contiguity; a span exactly equal to within does not match
    df = _logins(spark, [("u", "a", "fail", 0), ("u", "b", "fail", 1000), ("u", "c", "success", 1500),
                         ("u", "d", "fail", 2000), ("v", "a", "fail", 0), ("v", "b", "fail", 2000),
                         ("v", "c", "fail", 5000)])
    assert patterns.login_fail_3(df, within="5 seconds").count() == 0


def _orders(spark, data):
    return spark.createDataFrame([(o, t, ms(ts), i) for i, (o, t, ts) in enumerate(data)],
                                 "order_id string, order_type string, ts timestamp_ntz, event_id long")


ORDER_ROWS = [("order_1", "create", 2000), ("order_2", "create", 3000), ("order_1", "pay", 4000),
              ("order_2", "pay", 10000)]


def test_order_timeout_pattern(spark):
    out = patterns.order_timeout_pattern(_orders(spark, ORDER_ROWS), within="5 seconds")
    got = rows(out, "order_id", "result", "pay_ts", "timeout_ts")
    assert got == [("order_1", "payed", ms(4000), None), ("order_2", "timeout", None, ms(8000))]


def test_order_timeout_state(spark):
    out = timers.order_timeout_state(_orders(spark, ORDER_ROWS[:3]), timeout="5 seconds")
    assert rows(out, "order_id", "result", "event_ts") == [("order_1", "payed", ms(4000)),
                                                           ("order_2", "not_payed", ms(8000))]


def test_order_timeout_state_repeat_create_and_orphan(spark):
    df = _orders(spark, [("o", "create", 0), ("o", "create", 1000), ("o", "pay", 7000), ("p", "pay", 0)])
    out = rows(timers.order_timeout_state(df, timeout="5 seconds"), "order_id", "result", "event_ts")
    assert out == [("o", "late_pay", ms(7000)), ("o", "not_payed", ms(5000)), ("p", "orphan_pay", ms(0))]


def _keyed(spark, name, data):
    return spark.createDataFrame([(k, ms(ts), i) for i, (k, ts) in enumerate(data)],
                                 f"{name} string, ts timestamp_ntz, event_id long")


def test_interval_join(spark):
    clicks = _keyed(spark, "user_id", [("user_1", 600000)])
    browses = _keyed(spark, "user_id", [("user_1", 300000), ("user_1", 360000)])
    out = joins.interval_join(clicks, browses, key="user_id", lower="-10 minutes", upper="0 seconds")
    assert rows(out, "user_id", "left_ts", "right_ts") == [("user_1", ms(600000), ms(300000)),
                                                           ("user_1", ms(600000), ms(360000))]


def test_interval_join_inclusive_bounds(spark):
    left = _keyed(spark, "k", [("a", 600000)])
    right = _keyed(spark, "k", [("a", 0), ("a", 600000), ("a", 600001), ("a", -1)])
    out = joins.interval_join(left, right, key="k", lower="-10 minutes", upper="0 seconds")
    assert rows(out, "right_ts") == [(ms(0),), (ms(600000),)]


def test_window_join(spark):
    left = _keyed(spark, "k", [("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)])
    right = _keyed(spark, "k", [("a", 3000), ("b", 3000), ("a", 4000), ("b", 4000)])
    out = joins.window_join(left, right, key="k", size="5 seconds")
    assert out.count() == 8
    assert rows(out.groupBy("k").count(), "k", "count") == [("a", 4), ("b", 4)]


def test_reconcile(spark):
    orders = spark.createDataFrame([("order_1", ms(1000), 1), ("order_2", ms(2000), 2)],
                                   "order_id string, ts timestamp_ntz, event_id long")
    pays = spark.createDataFrame([("order_1", ms(3000), 3), ("order_3", ms(4000), 4)],
                                 "order_id string, ts timestamp_ntz, event_id long")
    out = joins.reconcile(orders, pays, key="order_id", tolerance="5 seconds")
    assert rows(out, "order_id", "tag") == [("order_1", "matched"), ("order_2", "unmatched_order"),
                                            ("order_3", "unmatched_pay")]


def test_reconcile_replaced_and_boundary(spark):
    # a repeated create replaces the pending one (reported unmatched); Δ == tolerance still matches
    orders = spark.createDataFrame([("o", ms(0), 1), ("o", ms(1000), 2)],
                                   "order_id string, ts timestamp_ntz, event_id long")
    pays = spark.createDataFrame([("o", ms(6000), 3)], "order_id string, ts timestamp_ntz, event_id long")
    out = joins.reconcile(orders, pays, key="order_id", tolerance="5 seconds")
    assert rows(out, "tag", "order_event_id", "pay_event_id") == [("matched", 2, 3), ("unmatched_order", 1, None)]


def test_sensor_switch(spark):
    readings = spark.createDataFrame(
        [(s, ms(t), float(t), i) for i, (s, t) in enumerate(
            [("sensor_1", 1000), ("sensor_2", 1000), ("sensor_2", 10000), ("sensor_2", 10001), ("sensor_1", 5000)])],
        "id string, ts timestamp_ntz, temperature double, event_id long")
    switches = spark.createDataFrame([("sensor_2", ms(0), 100)], "id string, ts timestamp_ntz, event_id long")
    out = control.gate_by_switch(readings, switches, duration="10 seconds")
    assert rows(out, "id", "ts") == [("sensor_2", ms(1000)), ("sensor_2", ms(10000))]


def test_sensor_switch_later_switch_does_not_extend(spark):
    readings = spark.createDataFrame([("s", ms(12000), 1.0, 1)],
                                     "id string, ts timestamp_ntz, temperature double, event_id long")
    switches = spark.createDataFrame([("s", ms(0), 10), ("s", ms(5000), 11)],
                                     "id string, ts timestamp_ntz, event_id long")
    assert control.gate_by_switch(readings, switches, duration="10 seconds").count() == 0


def test_smoke_alerts_default_low_and_equal_time(spark):
    readings = spark.createDataFrame([("s", ms(t), 1.0, i) for i, t in enumerate([0, 1000, 2000, 3000])],
                                     "id string, ts timestamp_ntz, temperature double, event_id long")
    levels = spark.createDataFrame([(ms(1000), "HIGH", 10), (ms(3000), "LOW", 11)],
                                   "ts timestamp_ntz, level string, event_id long")
    out = control.smoke_alerts(readings, levels, threshold=-100.0)
    assert rows(out, "ts") == [(ms(1000),), (ms(2000),)]


def test_hash_code(spark):
    df = spark.createDataFrame([("sensor_1",), ("",), (None,), ("a\U0001F600",)], "s string")
    out = df.select("s", hashing.hash_code_times(F.col("s"), 31).alias("h"),
                    hashing.java_hash_code(F.col("s")).alias("raw")).collect()
    got = {r["s"]: (r["h"], r["raw"]) for r in out}
    assert got["sensor_1"] == (470860948, 1262115052)
    assert got[""] == (0, 0)
    assert got[None] == (None, None)

    def java(s):
        h = 0
        b = s.encode("utf-16-be")
        for i in range(0, len(b), 2):
            h = (h * 31 + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h
    assert got["a\U0001F600"][1] == java("a\U0001F600")


def test_hash_code_sql(spark):
    hashing.register_hash_code(spark, "hashCode", factor=31)
    assert spark.sql("SELECT hashCode('sensor_1') AS h").first()["h"] == 470860948


def test_temp_rise_alerts(spark):
    # rise at 0→1000 arms 2000; fall at 2500 is after the timer → alert at 2000; rise at 3000 arms 4000,
    # fall exactly at 4000 cancels; rise at 5000 arms 6000 and fires at end of input
    data = [(0, 1.0), (1000, 2.0), (1500, 2.0), (2500, 1.0), (3000, 2.0), (4000, 1.0), (5000, 3.0)]
    df = spark.createDataFrame([("s", ms(t), v, i) for i, (t, v) in enumerate(data)],
                               "id string, ts timestamp_ntz, temperature double, event_id long")
    out = timers.temp_rise_alerts(df, rise_for="1 second")
    assert rows(out, "alert_ts") == [(ms(2000),), (ms(6000),)]


def test_periodic_counts(spark):
    data = [0, 3000, 10000, 12000, 25000]
    df = spark.createDataFrame([("s", ms(t), 1.0, i) for i, t in enumerate(data)],
                               "id string, ts timestamp_ntz, temperature double, event_id long")
    out = timers.periodic_counts(df, period="10 seconds")
    # timer 10000 (rows <= 10000 → 3), next anchor 12000 → 22000 (4), next 25000 → 35000 (5)
    assert rows(out, "fire_ts", "cnt") == [(ms(10000), 3), (ms(22000), 4), (ms(35000), 5)]


def test_grouped_agg_udf_and_window_apply(spark):
    import pandas as pd
    from pyspark.sql import types as T
    df = spark.createDataFrame([("a", ms(0), 1.0), ("a", ms(1000), 3.0), ("b", ms(0), -2.0), ("a", ms(6000), 5.0)],
                               "id string, ts timestamp_ntz, temperature double")
    avg = udfs.grouped_agg(df, ["id"], lambda s: float(s.mean()), "temperature", "double", "avg_t")
    assert rows(avg, "id", "avg_t") == [("a", 3.0), ("b", -2.0)]
    win = df.withColumn("w", F.window("ts", "5 seconds").end)

    def minmax(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"id": pdf["id"].iloc[0], "window_end": pdf["w"].iloc[0],
                              "min_t": pdf["temperature"].min(), "max_t": pdf["temperature"].max()}])
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("window_end", T.TimestampNTZType()),
                           T.StructField("min_t", T.DoubleType()), T.StructField("max_t", T.DoubleType())])
    out = udfs.window_apply(win, ["id", "w"], minmax, schema)
    assert rows(out, "id", "window_end", "min_t", "max_t") == [("a", ms(5000), 1.0, 3.0), ("a", ms(10000), 5.0, 5.0),
                                                                ("b", ms(5000), -2.0, -2.0)]


def test_minmax_all_negative_window(spark):
    from eventspark.operators import windows
    df = spark.createDataFrame([("s", ms(0), -5.0, 1), ("s", ms(1000), -3.0, 2)],
                               "id string, ts timestamp_ntz, temperature double, event_id long")
    out = windows.minmax_per_window(df, size="5 seconds").collect()
    assert [(r["min_temp"], r["max_temp"]) for r in out] == [(-5.0, -3.0)]


def test_hot_items_fewer_than_n_and_ties(spark):
    from eventspark.operators import topn
    data = [(1, 7, ms(0)), (2, 5, ms(1000)), (3, 5, ms(2000)), (4, 9, ms(3000)), (5, 9, ms(4000))]
    b = spark.createDataFrame([(u, i, "view", "pv", t, u) for u, i, t in data],
                              "user_id long, item_id long, category_id string, behavior string, ts timestamp_ntz, "
                              "event_id long")
    out = topn.hot_items(b, n=2, size="1 hour", slide="1 hour")
    # counts: item 5 → 2, item 9 → 2, item 7 → 1; ties ranked by item id ascending; only 2 per window
    assert rows(out, "item_id", "cnt", "rank") == [(5, 2, 1), (9, 2, 2)]
    one = topn.hot_items(b.where("item_id = 7"), n=3, size="1 hour", slide="1 hour")
    assert rows(one, "item_id", "rank") == [(7, 1)]


def test_timer_goldens_edge_cases(spark):
    """Equal readings, a fall at the timer time, re-arming and late pays."""
    data = [(0, 1.0), (1000, 2.0), (1500, 2.0), (2500, 1.0), (3000, 2.0), (4000, 1.0), (5000, 3.0)]
    df = spark.createDataFrame([("s", ms(t), v, i) for i, (t, v) in enumerate(data)],
                               "id string, ts timestamp_ntz, temperature double, event_id long")
    assert rows(timers.temp_rise_alerts(df, rise_for="1 second"), "alert_ts") == [
        (ms(2000),), (ms(6000),)]
    pc = spark.createDataFrame([("s", ms(t), 1.0, i) for i, t in enumerate([0, 3000, 10000, 12000, 25000])],
                               "id string, ts timestamp_ntz, temperature double, event_id long")
    assert rows(timers.periodic_counts(pc, period="10 seconds"), "fire_ts", "cnt") == [
        (ms(10000), 3), (ms(22000), 4), (ms(35000), 5)]
    od = _orders(spark, [("o", "create", 0), ("o", "create", 1000), ("o", "pay", 7000), ("p", "pay", 0)])
    assert rows(timers.order_timeout_state(od, timeout="5 seconds"),
                "order_id", "result", "event_ts") == [("o", "late_pay", ms(7000)), ("o", "not_payed", ms(5000)),
                                                      ("p", "orphan_pay", ms(0))]
    od2 = _orders(spark, ORDER_ROWS[:3])
    assert rows(timers.order_timeout_state(od2, timeout="5 seconds"),
                "order_id", "result", "event_ts") == [("order_1", "payed", ms(4000)),
                                                      ("order_2", "not_payed", ms(8000))]


def test_java_whitespace_split_all_trailing_kinds(spark):
    docs = spark.createDataFrame([(1, "x\t\r\n\x0b\x0c "), (2, "\x0c\x0b"), (3, "y\x0bz")], "doc_id long, text string")
    assert rows(text.tokens(docs), "doc_id", "pos", "word") == [(1, 0, "x"), (3, 0, "y"), (3, 1, "z")]


def test_lateness_classes(spark):
    """One row per class (A-3): on time, late update within the allowed lateness, dropped beyond it."""
    from eventspark.operators import replay
    data = [("a", 1000, 1000, 1), ("a", 7000, 7000, 2), ("a", 2000, 8000, 3), ("a", 12000, 12000, 4),
            ("a", 3000, 20000, 5)]
    df = spark.createDataFrame([(k, ms(t), ms(a), i) for k, t, a, i in data],
                               "key string, ts timestamp_ntz, arrival timestamp_ntz, event_id long")
    out = replay.allowed_lateness(df, key="key", size="5 seconds", bound="0 seconds", lateness="5 seconds")
    assert rows(out, "window_start", "firing", "kind", "cnt") == [
        (ms(0), 1, "first", 1), (ms(0), 2, "update", 2), (ms(5000), 1, "first", 1), (ms(10000), 1, "first", 1)]
    split = replay.late_row_split(df, bound="0 seconds")
    assert rows(split.where("tag = 'late'"), "event_id") == [(3,), (5,)]
