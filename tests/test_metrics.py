import datetime as dt
import random

from pyspark.sql import functions as F

from rivulet.operators import metrics as M
from rivulet.operators.filters import match_labels

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def dense_samples(n_series=3, n=400, seed=7):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for s in range(n_series):
        v, t = 0.0, T0
        for _ in range(n):
            t = t + dt.timedelta(seconds=rnd.randint(5, 40))
            v = 0.0 if rnd.random() < 0.02 else v + rnd.randint(0, 9)   # counter resets
            rows.append((eid, t, f"s{s}", float(v)))
            eid += 1
    return rows


def brute_rate(rows, win_s, slide_s):
    out = {}
    by = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by.setdefault(r[2], []).append(r)
    for s, rs in by.items():
        epoch = dt.datetime(1970, 1, 1)
        starts = set()
        for _, t, _, _ in rs:
            sec = int((t - epoch).total_seconds())
            last = sec - 1 - (sec - 1) % slide_s  # windows (start, end]
            for k in range(win_s // slide_s):
                starts.add(last - k * slide_s)
        for st in starts:
            ws, we = epoch + dt.timedelta(seconds=st), epoch + dt.timedelta(seconds=st + win_s)
            inw = [r for r in rs if ws < r[1] <= we]
            inc = 0.0
            for a, b in zip(inw, inw[1:]):
                inc += b[3] if b[3] < a[3] else b[3] - a[3]
            el = (inw[-1][1] - inw[0][1]).total_seconds()
            rate = round(inc / el, 6) if len(inw) >= 2 and el > 0 else None
            out[(ws, s)] = (len(inw), inc, rate)
    return out


def test_counter_rate_with_resets_matches_brute_force(spark):
    rows = dense_samples()
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, series string, value double")
    got = M.counter_rate(df, ["series"], "ts", "value", "id", "5 minutes", "1 minute", pane_seconds=30).collect()
    want = brute_rate(rows, 300, 60)
    assert len(got) == len(want)
    for r in got:
        w = want[(r.window_start, r.series)]
        assert (r.samples, r.increase) == (w[0], w[1])
        assert (r.rate is None and w[2] is None) or abs(r.rate - w[2]) < 1e-9


def extrapolated(inside, start, end):
    """Rate of samples (seconds, value) extended to the window's borders, step by step."""
    if len(inside) < 2 or inside[-1][0] == inside[0][0]:
        return None
    inc = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in zip(inside, inside[1:]))
    span = inside[-1][0] - inside[0][0]
    gap = span / (len(inside) - 1)
    before, after = inside[0][0] - start, end - inside[-1][0]
    if inc > 0 and inside[0][1] >= 0:
        before = min(before, span * inside[0][1] / inc)
    reach = [gap / 2 if way >= gap * 1.1 else way for way in (before, after)]
    return round(inc * (span + sum(reach)) / span / (end - start), 6)


def test_extrapolated_rate_and_panes_of_any_size(spark):
    rows = dense_samples(n_series=2, n=200, seed=5)
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, series string, value double").repartition(3)
    epoch = dt.datetime(1970, 1, 1)
    seconds = lambda t: (t - epoch).total_seconds()
    plain = None
    for pane in (None, 60, 20):
        got = {(r.window_start, r.series): r for r in M.counter_rate(df, ["series"], "ts", "value", "id", "5 minutes", "1 minute", pane, extrapolate=True).collect()}
        for (ws, s), r in got.items():
            a, b = seconds(ws), seconds(ws) + 300
            inside = sorted((seconds(x[1]), x[3]) for x in rows if x[2] == s and a < seconds(x[1]) <= b)
            want = extrapolated(inside, a, b)
            assert (r.rate is None) == (want is None) and (want is None or abs(r.rate - want) < 2e-6)
        plain = plain or sorted(map(tuple, got.values()), key=repr)
        assert sorted(map(tuple, got.values()), key=repr) == plain and len(got) > 100


def test_samples_on_borders_count_as_in_instant_vectors(spark):
    rows = [(k, T0 + dt.timedelta(minutes=5 * k), "a", float(k)) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    rates = {r.window_end: r.samples for r in M.counter_rate(df, ["s"], "ts", "v", "id", "5 minutes").collect()}
    steps = {r.step for r in M.instant_range(df, ["s"], "ts", "v", 300, 300, "id").collect()}
    assert rates == {t: 1 for t in steps}


def test_summaries_join_in_any_grouping(spark):
    rnd = random.Random(8)
    parts = [[(p * 100 + k, 0, float(rnd.randint(0, 9))) for k in range(rnd.randint(1, 6))] for p in range(5)]
    kind = "array<struct<us:bigint,tb:bigint,v:double>>"
    one = spark.createDataFrame([([x for p in parts for x in p],)], f"x {kind}").select(M.pane_summary(F.col("x")).alias("s")).first()["s"]
    df = spark.createDataFrame([(parts,)], f"x array<{kind}>")
    summaries = F.transform("x", M.pane_summary)
    left = M.joined_summaries(summaries)
    right = M.joined_summaries(F.array(M.joined_summaries(F.slice(summaries, 1, 2)), M.joined_summaries(F.slice(summaries, 3, 3))))
    got = df.select(left.alias("a"), right.alias("b")).first()
    assert got["a"] == got["b"] == one


def test_rate_from_increments_equals_rate_of_running_counter(spark):
    rnd = random.Random(3)
    rows = [(i, T0 + dt.timedelta(seconds=i * 17 + rnd.randint(0, 5)), f"s{i % 3}", rnd.randint(1, 50))
            for i in range(900)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, series string, inc long")
    c = M.counter_from_increments(df, ["series"], "ts", "inc", "id", bucket_seconds=300)
    # running sum checked against Python
    run, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        run[r[2]] = run.get(r[2], 0) + r[3]
        want[r[0]] = run[r[2]]
    assert {r.id: r.counter for r in c.collect()} == want
    a = M.counter_rate(c.drop(M.BUCKET).withColumn("counter", F.col("counter").cast("double")),
                       ["series"], "ts", "counter", "id", "10 minutes", "5 minutes", 300)
    b = M.counter_rate_from_increments(df, ["series"], "ts", "inc", "id", "10 minutes", "5 minutes")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_instant_vector_and_health(spark):
    rows = [(1, T0 + dt.timedelta(minutes=1), "api", "a", 1), (2, T0 + dt.timedelta(minutes=2), "api", "a", 0),
            (3, T0 + dt.timedelta(minutes=3), "api", "b", 0), (4, T0 + dt.timedelta(hours=3), "api", "a", 1),
            (5, T0 + dt.timedelta(minutes=1), "db", "a", 1)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, job string, instance string, up int")
    v = M.instant_range(df, ["job", "instance"], "ts", "up", 3600, 3600, "id")
    got = {(r.step, r.job, r.instance): r.up for r in v.collect()}
    h1 = T0 + dt.timedelta(hours=1)
    assert got[(h1, "api", "a")] == 0 and got[(h1, "api", "b")] == 0 and got[(h1, "db", "a")] == 1
    health = {(r.step, r.job): (r.up, r.status) for r in M.health_status(v, "job", "up", 3600).collect()}
    assert health[(h1, "api")] == (0, "red")
    assert health[(T0 + dt.timedelta(hours=2), "api")] == (None, "Offline")
    assert health[(T0 + dt.timedelta(hours=3), "api")] == (1, "green")
    assert health[(h1, "db")] == (1, "green")
    at = F.lit(T0 + dt.timedelta(minutes=2, seconds=30)).cast("timestamp_ntz")
    inst = {(r.job, r.instance): r.up for r in M.instant_at(df, ["job", "instance"], "ts", "up", at, 300, "id").collect()}
    assert inst == {("api", "a"): 0, ("db", "a"): 1}


def test_label_matchers(spark):
    df = spark.createDataFrame([({"job": "web", "name": "x"},), ({"job": "errors"},), ({},)], "labels map<string,string>")
    n = lambda m: match_labels(df, m).count()
    assert n([("job", "=~", "err.*")]) == 1
    assert n([("job", "!~", "err.*")]) == 2          # a missing label is ''
    assert n([("job", "!=", "")]) == 2
    assert n([("name", "=", "")]) == 2
    assert n([("job", "=~", "e")]) == 0              # anchored


def test_uptime_and_last(spark):
    rows = [(1, T0, "a", 1.0), (2, T0 + dt.timedelta(seconds=90), "a", 5.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    as_of = F.lit(T0 + dt.timedelta(minutes=10)).cast("timestamp_ntz")
    assert M.uptime(df, ["s"], "ts", as_of).first().uptime_s == 600.0
    assert M.last_value(df, ["s"], "ts", "v", "id").first()["last"] == 5.0


def test_null_reading_is_no_sample(spark):
    T1 = T0 + dt.timedelta(seconds=1)  # a sample on the border would belong to the window before
    rows = [(1, T1, "a", 5.0), (2, T1 + dt.timedelta(seconds=30), "a", None), (3, T1 + dt.timedelta(seconds=60), "a", 9.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    r = M.counter_rate(df, ["s"], "ts", "v", "id", "5 minutes").first()
    assert (r.samples, r.increase, r.rate) == (2, 4.0, round(4 / 60, 6))
    p = {r.id: (r.prev_ts, r.prev_value) for r in M.with_previous(df, ["s"], "ts", "v", "id").collect()}
    assert p[3] == (T1 + dt.timedelta(seconds=30), None) and p[2] == (T1, 5.0)   # one row's time and value


def test_health_covers_the_query_range_and_silent_jobs(spark):
    rows = [(h * 10 + k, T0 + dt.timedelta(hours=h, minutes=1), job, "x", 1)
            for k, (job, hours) in enumerate((("api", range(5)), ("db", range(2)))) for h in hours]
    v = M.instant_range(spark.createDataFrame(rows, "id long, ts timestamp_ntz, job string, instance string, up int"),
                        ["job", "instance"], "ts", "up", 3600, 3600, "id")
    jobs = spark.createDataFrame([("api",), ("db",), ("ghost",)], "job string")
    got = {(r.job, (r.step - T0).total_seconds() / 3600): r.status for r in M.health_status(v, "job", "up", 3600, jobs).collect()}
    assert len(got) == 15 and got[("db", 2)] == "green" and got[("db", 3)] == got[("db", 5)] == got[("ghost", 1)] == "Offline"
    end = F.lit(T0 + dt.timedelta(hours=7)).cast("timestamp_ntz")
    assert M.health_status(v, "job", "up", 3600, jobs, end=end).count() == 21


def test_gauge_uptime(spark):
    start = (T0 - dt.datetime(1970, 1, 1)).total_seconds()
    rows = [(1, T0 + dt.timedelta(minutes=1), "a", start), (2, T0 + dt.timedelta(minutes=9), "a", start + 500.0),
            (3, T0 + dt.timedelta(minutes=1), "gone", start)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    as_of = F.lit(T0 + dt.timedelta(minutes=10)).cast("timestamp_ntz")
    assert [tuple(r) for r in M.gauge_uptime(df, ["s"], "ts", "v", as_of, 300, "id").collect()] == [("a", start + 500.0, 100.0)]


def test_instant_range_lookback_longer_than_step(spark):
    rnd = random.Random(2)
    rows = [(i, T0 + dt.timedelta(seconds=rnd.randint(0, 7200)), f"s{i % 2}", float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    for step, back in ((60, 300), (600, 900), (600, 250)):
        got = {(r.step, r.s): (r.v, r.sample_ts) for r in M.instant_range(df, ["s"], "ts", "v", step, back, "id").collect()}
        want = {}
        for k in range(0, (7200 + back) // step + 2):
            t = T0 + dt.timedelta(seconds=k * step)
            for s in ("s0", "s1"):
                inside = [(r[1], r[0], r[3]) for r in rows if r[2] == s and t - dt.timedelta(seconds=back) < r[1] <= t]
                if inside:
                    want[(t, s)] = (max(inside)[2], max(inside)[0])
        assert got == want


def test_instant_range_lookback_shorter_than_step(spark):
    rows = [(1, T0 + dt.timedelta(minutes=30), "a", 1.0), (2, T0 + dt.timedelta(minutes=58), "a", 2.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, s string, v double")
    got = [(r.step, r.v) for r in M.instant_range(df, ["s"], "ts", "v", 3600, 300, "id").collect()]
    assert got == [(T0 + dt.timedelta(hours=1), 2.0)]          # 00:30 is outside every (t-5m, t]



def test_null_labels_and_null_increments(spark):
    rows = [(1, T0, None, 1), (2, T0 + dt.timedelta(minutes=1), None, None), (3, T0 + dt.timedelta(hours=2), None, 2)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, job string, inc long")
    got = {r.id: (r.job, r.counter) for r in M.counter_from_increments(df, ["job"], "ts", "inc", "id").collect()}
    assert got == {1: ("", 1), 2: ("", 1), 3: ("", 3)}


def test_recent_counter_runs_from_the_first_sample(spark, tmp_dir):
    """The counter of the last six hours holds the whole history; a null id comes last among samples of one time."""
    import __spark_entry__ as E
    rows = [(1, "2024-01-01 00:00:00", 4, "click", 5.0), (2, "2024-01-09 01:00:00", 4, "click", 2.5), (None, "2024-01-09 01:00:00", 4, "click", 1.0),
            (4, "2024-01-01 00:00:00", 4, "view", 7.0), (5, "2024-01-09 05:00:00", 1, None, None), (6, None, 4, "click", 3.0),
            (7, "2024-01-09 04:00:00", 0, "click", 1.5), (8, "2024-01-09 05:00:00", 5, "error", 0.25)]
    df = spark.createDataFrame([(*r, None) for r in rows], "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    got = sorted((r.job, r.instance, r["last"], str(r.last_ts)) for r in E.queries()["metric_recent_6h"](spark, tmp_dir).collect())
    assert got == [("", "1", None, "2024-01-09 05:00:00"), ("click", "0", 1000.0, "2024-01-09 04:00:00"), ("error", "1", 25.0, "2024-01-09 05:00:00")]
