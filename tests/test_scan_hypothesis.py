"""Randomised check of the skew-safe prefix scan against a plain window (NULL keys and values, ties broken by id,
any number of pieces)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import cut, folded, in_micros
from eventspark.operators import scan

ROW = st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 30),
                st.one_of(st.none(), st.integers(-50, 50)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(ROW, min_size=0, max_size=120), pieces=st.integers(2, 12),
       how=st.sampled_from(["sum", "max", "min", "last"]), inclusive=st.booleans(), keyed=st.booleans())
def test_prefix_scan_matches_window(spark, monkeypatch, data, pieces, how, inclusive, keyed):
    cut(spark, pieces)
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(data)],
                               "k string, t int, v int, id long")
    key = "k" if keyed else None
    got = scan.prefix_scan(df, key=key, order=["t", "id"], inclusive=inclusive,
                           values=[("r", F.col("v"), how)]).select("id", "r")
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    w = (Window.partitionBy("k") if keyed else Window.partitionBy()).orderBy("t", "id").rowsBetween(*frame)
    agg = {"sum": F.sum("v"), "max": F.max("v"), "min": F.min("v"), "last": F.last("v", ignorenulls=True)}[how]
    expr = F.coalesce(agg.over(w), F.lit(0)) if how == "sum" else agg.over(w)
    want = df.select("id", expr.alias("r"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(ROW, min_size=0, max_size=120), pieces=st.integers(2, 12),
       offsets=st.lists(st.sampled_from([-3, -2, -1, 1, 2, 3]), min_size=1, max_size=3, unique=True))
def test_neighbours_match_lead_lag(spark, monkeypatch, data, pieces, offsets):
    cut(spark, pieces)
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(data)],
                               "k string, t int, v int, id long")
    got = scan.with_neighbors(df, key="k", order=["t", "id"], offsets=offsets, cols=["v", "id"])
    w = Window.partitionBy("k").orderBy("t", "id")
    names = [f"{c}_{o if o > 0 else 'm' + str(-o)}" for o in offsets for c in ("v", "id")]
    want = df.select("id", *[(F.lead(c, o) if o > 0 else F.lag(c, -o)).over(w).alias(f"{c}_{o if o > 0 else 'm' + str(-o)}")
                             for o in offsets for c in ("v", "id")])
    assert sorted(map(tuple, got.select("id", *names).collect())) == sorted(map(tuple, want.collect()))


TIMER_ROW = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.sampled_from(["create", "pay"]),
                      st.integers(0, 9))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(TIMER_ROW, min_size=1, max_size=60), gap=st.integers(1, 15), pieces=st.integers(2, 12))
def test_timer_chains_match_folds(spark, monkeypatch, data, gap, pieces):
    import datetime as dt
    from eventspark.operators import timers
    cut(spark, pieces)
    t0 = dt.datetime(2024, 1, 1)
    rows_ = [(k, t0 + dt.timedelta(seconds=s), typ, float(temp), i) for i, (k, s, typ, temp) in enumerate(data)]
    r = spark.createDataFrame([(k, ts, temp, i) for k, ts, _, temp, i in rows_],
                              "id string, ts timestamp_ntz, temperature double, event_id long")
    o = spark.createDataFrame([(k, typ, ts, i) for k, ts, typ, _, i in rows_],
                              "order_id string, order_type string, ts timestamp_ntz, event_id long")
    d = f"{gap} seconds"
    for got, df, spec, key in (
            (timers.periodic_counts(r, period=d), r, timers.periodic_counts_spec(d), "id"),
            (timers.temp_rise_alerts(r, rise_for=d), r, timers.temp_rise_spec(d), "id"),
            (timers.order_timeout_state(o, timeout=d), o, timers.order_timeout_spec(d), "order_id")):
        assert in_micros(got) == folded(df, spec, key)


def _python_fold(spec, rows_by_key):
    """Brute force: run a fold spec sequentially over each key's rows (already in order)."""
    out = []
    for k, rs in rows_by_key.items():
        state = spec.make()
        for r in rs:
            out.extend((k, *o) for o in spec.step(state, r))
        while spec.due(state) is not None:
            out.extend((k, *o) for o in spec.finish(state))
    return out


EV_ROW = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40), st.sampled_from([0, 1]),
                   st.sampled_from(["fail", "success"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(EV_ROW, min_size=1, max_size=50), within=st.integers(1, 12), pieces=st.integers(2, 12))
def test_batch_operators_match_sequential_definitions(spark, monkeypatch, data, within, pieces):
    import datetime as dt
    from eventspark.operators import control, joins, patterns
    from eventspark.streaming import stateful
    cut(spark, pieces)
    t0 = dt.datetime(2024, 1, 1)
    us = lambda s: int((t0 + dt.timedelta(seconds=s) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    rows_ = [(k, s, side, ev, i) for i, (k, s, side, ev) in enumerate(data)]
    d = f"{within} seconds"
    def by_key(rs, order):
        """Rows per key, each key's rows sorted by ``order`` (a function of the row without its key)."""
        return {k: sorted((r[1:] for r in rs if r[0] == k), key=order) for k in {r[0] for r in rs}}
    ts_id = lambda r: (r[0], r[-1])  # noqa: E731 - (ts, event_id)

    # reconcile: side 0 = order, 1 = pay
    left = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), i) for k, s, side, _, i in rows_ if side == 0],
                                 "order_id string, ts timestamp_ntz, event_id long")
    right = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), i) for k, s, side, _, i in rows_ if side == 1],
                                  "order_id string, ts timestamp_ntz, event_id long")
    got = joins.reconcile(left, right, key="order_id", tolerance=d).select(
        "order_id", "tag", F.unix_micros(F.col("order_ts").cast("timestamp")), "order_event_id",
        F.unix_micros(F.col("pay_ts").cast("timestamp")), "pay_event_id")
    want = _python_fold(stateful.reconcile_spec(d), by_key([(k, us(s), side, i) for k, s, side, _, i in rows_], ts_id))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)

    # consecutive failed logins
    logins = spark.createDataFrame([(k, f"ip{i}", ev, t0 + dt.timedelta(seconds=s), i) for k, s, _, ev, i in rows_],
                                   "user_id string, ip_address string, event_type string, ts timestamp_ntz, "
                                   "event_id long")
    got = patterns.login_fail_3(logins, within=d).select("user_id", "ip1", "ip2", "ip3", "first_event_id")
    want = [(k, a, b, c, fid) for k, a, b, c, _, _, fid in _python_fold(
        stateful.login_fail_spec(d), by_key([(k, us(s), ev, f"ip{i}", i) for k, s, _, ev, i in rows_], ts_id))]
    assert sorted(map(tuple, got.collect())) == sorted(want)

    # switch gate: side 0 rows are switches, side 1 rows readings
    readings = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), float(i), i) for k, s, side, _, i in rows_
                                      if side == 1], "id string, ts timestamp_ntz, temperature double, event_id long")
    switches = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), i) for k, s, side, _, i in rows_ if side == 0],
                                     "id string, ts timestamp_ntz, event_id long")
    got = control.gate_by_switch(readings, switches, duration=d).select("id", "event_id")
    folded = _python_fold(stateful.switch_gate_spec(d), by_key(
        [(k, us(s), 0 if side == 0 else 1, i, float(i) if side == 1 else None) for k, s, side, _, i in rows_],
        lambda r: (r[0], r[1], r[2])))  # (ts, rank, event_id): switches before readings at equal time
    assert sorted(map(tuple, got.collect())) == sorted((k, eid) for k, _, _, eid in folded)


ORDER_ROW = st.tuples(st.sampled_from(["o1", "o2"]), st.integers(0, 30), st.sampled_from(["create", "pay"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(ORDER_ROW, min_size=1, max_size=40), within=st.integers(1, 10), pieces=st.integers(2, 12))
def test_order_pattern_matches_sequential_definition(spark, monkeypatch, data, within, pieces):
    import datetime as dt
    from eventspark.operators import patterns
    from eventspark.streaming import stateful
    cut(spark, pieces)
    t0 = dt.datetime(2024, 1, 1)
    us = lambda s: int((t0 + dt.timedelta(seconds=s) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    orders = spark.createDataFrame([(k, typ, t0 + dt.timedelta(seconds=s), i) for i, (k, s, typ) in enumerate(data)],
                                   "order_id string, order_type string, ts timestamp_ntz, event_id long")
    d = f"{within} seconds"
    got = patterns.order_timeout_pattern(orders, within=d).select(
        "order_id", "result", F.unix_micros(F.col("create_ts").cast("timestamp")), "create_event_id",
        F.unix_micros(F.col("pay_ts").cast("timestamp")), "pay_event_id",
        F.unix_micros(F.col("timeout_ts").cast("timestamp")))
    rows_by_key = {}
    for i, (k, s, typ) in enumerate(data):
        rows_by_key.setdefault(k, []).append((us(s), typ, i))
    for k in rows_by_key:
        rows_by_key[k].sort(key=lambda r: (r[0], r[2]))
    want = _python_fold(stateful.order_pattern_spec(d), rows_by_key)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


ARR_ROW = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.integers(0, 20))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(ARR_ROW, min_size=1, max_size=50), bound=st.integers(0, 5), lateness=st.integers(0, 10),
       pieces=st.integers(2, 12))
def test_replay_matches_sequential_simulation(spark, monkeypatch, data, bound, lateness, pieces):
    """Late rows and allowed-lateness firings equal a row-by-row simulation in arrival order (A-2, A-3)."""
    import datetime as dt
    from eventspark.operators import replay
    cut(spark, pieces)
    size = 5
    t0 = dt.datetime(2024, 1, 1)
    rows_ = [(k, s, s + delay, i) for i, (k, s, delay) in enumerate(data)]  # (key, ts, arrival, id) in seconds
    df = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), t0 + dt.timedelta(seconds=a), i)
                                for k, s, a, i in rows_],
                               "key string, ts timestamp_ntz, arrival timestamp_ntz, event_id long")
    late_ids, firings = [], []
    seen_max = None
    n0, nu = {}, {}
    cls = []
    for k, s, a, i in sorted(rows_, key=lambda r: (r[2], r[3])):
        if seen_max is not None and s * 1000 < seen_max * 1000 - bound * 1000 - 1:
            late_ids.append(i)
        start = (s // size) * size
        end = start + size
        m = None if seen_max is None else seen_max - bound
        c = "on_time" if m is None or m < end else ("update" if m < end + lateness else "dropped")
        cls.append((k, start, c))
        seen_max = s if seen_max is None else max(seen_max, s)
    for k, start, c in cls:
        if c == "on_time":
            n0[(k, start)] = n0.get((k, start), 0) + 1
    for (k, start), n in n0.items():
        firings.append((k, start, 1, "first", n))
    for k, start, c in cls:
        if c == "update":
            nu[(k, start)] = nu.get((k, start), 0) + 1
            base = n0.get((k, start), 0)
            f = (1 if base > 0 else 0) + nu[(k, start)]
            firings.append((k, start, f, "first" if f == 1 else "update", base + nu[(k, start)]))
    got_late = [r[0] for r in replay.late_row_split(df, bound=f"{bound} seconds").where("tag = 'late'")
                .select("event_id").collect()]
    assert sorted(got_late) == sorted(late_ids)
    out = replay.allowed_lateness(df, key="key", size=f"{size} seconds", bound=f"{bound} seconds",
                                  lateness=f"{lateness} seconds")
    got = [(r["key"], int((r["window_start"] - t0).total_seconds()), r["firing"], r["kind"], r["cnt"])
           for r in out.collect()]
    assert sorted(got) == sorted(firings)


def _java_hash_times(s, factor):
    h = 0
    b = s.encode("utf-16-be")
    for i in range(0, len(b), 2):
        h = (h * 31 + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
    h = (h * factor) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(words=st.lists(st.text(max_size=40), min_size=1, max_size=40), factor=st.integers(-1000, 1000))
def test_hash_code_matches_java_semantics(spark, words, factor):
    from eventspark.functions import hashing
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, s string")
    got = {r["i"]: r["h"] for r in df.select("i", hashing.hash_code_times(F.col("s"), factor).alias("h")).collect()}
    assert got == {i: _java_hash_times(w, factor) for i, w in enumerate(words)}
    hashing.register_hash_code(spark, "hashCodeT", factor=factor)
    df.createOrReplaceTempView("hash_words")
    got_sql = {r["i"]: r["h"] for r in spark.sql("SELECT i, hashCodeT(s) AS h FROM hash_words").collect()}
    assert got_sql == got


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 100)), min_size=1, max_size=30),
       right=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 100)), min_size=1, max_size=30),
       lo=st.integers(-40, 40), width=st.integers(0, 40))
def test_bucketed_interval_join_matches_range_join(spark, left, right, lo, width):
    import datetime as dt
    from eventspark.operators import joins
    t0 = dt.datetime(2024, 1, 1)
    mk = lambda rs, base: spark.createDataFrame(
        [(k, t0 + dt.timedelta(seconds=s), base + i) for i, (k, s) in enumerate(rs)],
        "k string, ts timestamp_ntz, event_id long")
    lf, rf = mk(left, 0), mk(right, 1000)
    kw = dict(key="k", lower=f"{lo} seconds", upper=f"{lo + width} seconds")
    got = sorted(map(tuple, joins.interval_join(lf, rf, **kw).collect()))
    want = sorted((lk, t0 + dt.timedelta(seconds=ls), li, t0 + dt.timedelta(seconds=rs_), 1000 + ri)
                  for li, (lk, ls) in enumerate(left) for ri, (rk, rs_) in enumerate(right)
                  if lk == rk and ls + lo <= rs_ <= ls + lo + width)
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 120)), min_size=1, max_size=60),
       slide=st.sampled_from([1, 2, 5, 7, 11]), mult=st.integers(1, 6))
def test_pane_sliding_counts_match_brute_force(spark, data, slide, mult):
    import datetime as dt
    from eventspark.operators import windows
    t0 = dt.datetime(2024, 1, 1)
    base = int((t0 - dt.datetime(1970, 1, 1)).total_seconds())  # windows are aligned on the epoch
    size = slide * mult
    df = spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s)) for k, s in data], "item_id long, ts timestamp_ntz")
    got = sorted((r["item_id"], int((r["window_end"] - t0).total_seconds()), r["cnt"])
                 for r in windows.sliding_count(df, key="item_id", size=f"{size} seconds",
                                                slide=f"{slide} seconds").collect())
    counts = {}
    for k, s in data:
        first_end = ((base + s) // slide + 1) * slide - base
        for end in range(first_end, first_end + size, slide):
            counts[(k, end)] = counts.get((k, end), 0) + 1
    assert got == sorted((k, e, c) for (k, e), c in counts.items())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reads=st.lists(st.tuples(st.integers(0, 40), st.integers(-200, 50)), min_size=1, max_size=40),
       ctrl=st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["LOW", "HIGH"])), max_size=15),
       size=st.sampled_from([1, 2, 5]), pieces=st.integers(2, 12))
def test_smoke_gate_and_window_join_match_brute_force(spark, monkeypatch, reads, ctrl, size, pieces):
    import datetime as dt
    from eventspark.operators import control, joins
    cut(spark, pieces)
    t0 = dt.datetime(2024, 1, 1)
    r = spark.createDataFrame([("s", t0 + dt.timedelta(seconds=s), float(v), i) for i, (s, v) in enumerate(reads)],
                              "id string, ts timestamp_ntz, temperature double, event_id long")
    lv = spark.createDataFrame([(t0 + dt.timedelta(seconds=s), lvl, 1000 + i) for i, (s, lvl) in enumerate(ctrl)],
                               "ts timestamp_ntz, level string, event_id long")
    got = sorted(x["event_id"] for x in control.smoke_alerts(r, lv, threshold=-100.0).collect())
    want = []
    for i, (s, v) in enumerate(reads):
        before = sorted((cs, 1000 + j, lvl) for j, (cs, lvl) in enumerate(ctrl) if cs <= s)
        level = before[-1][2] if before else "LOW"
        if level == "HIGH" and v > -100:
            want.append(i)
    assert got == sorted(want)

    left = spark.createDataFrame([("k", t0 + dt.timedelta(seconds=s), i) for i, (s, _) in enumerate(reads)],
                                 "k string, ts timestamp_ntz, event_id long")
    right = spark.createDataFrame([("k", t0 + dt.timedelta(seconds=s), 1000 + i) for i, (s, _) in enumerate(ctrl)],
                                  "k string, ts timestamp_ntz, event_id long")
    got = sorted((x["left_event_id"], x["right_event_id"])
                 for x in joins.window_join(left, right, key="k", size=f"{size} seconds").collect())
    want = sorted((i, 1000 + j) for i, (s, _) in enumerate(reads) for j, (cs, _) in enumerate(ctrl)
                  if s // size == cs // size)
    assert got == want
