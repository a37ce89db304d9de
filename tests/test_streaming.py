import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from rivulet.catalog import QUERIES
from rivulet.fixtures import EVENTS_SCHEMA, metric_samples, table
from rivulet.operators import metrics as M
from rivulet.streaming.rate import counter_rate_stream, run_available_now, windowed_increase

from .conftest import SF_SMALL
from .test_metrics import dense_samples


def test_stream_equals_batch_for_closed_windows(spark):
    s = QUERIES["stream_rate"](spark, SF_SMALL)
    events = table(spark, SF_SMALL, "events")
    batch = M.counter_rate_from_increments(metric_samples(events), ["job", "instance"], "ts", "inc", "event_id",
                                           "1 day", "6 hours")
    horizon = events.select(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(horizon - dt.timedelta(minutes=10, microseconds=1)).cast("timestamp_ntz"))
    a = sorted(map(tuple, s.select(*closed.columns).collect()))
    b = sorted(map(tuple, closed.collect()))
    assert a == b and len(a) > 0


def test_late_rows_behind_watermark_are_dropped(spark):
    root = tempfile.mkdtemp(prefix="rivulet-stream-")
    src = os.path.join(root, "in")
    rows = spark.createDataFrame(
        [(1, "2024-01-01 00:00:10", 1, "a", 1.0, "{}"), (2, "2024-01-01 00:20:00", 1, "a", 1.0, "{}")],
        "event_id long, ts string, user_id long, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rows.coalesce(1).write.parquet(src + "/b1")
    mk = lambda rows: spark.createDataFrame(
        rows, "event_id long, ts string, user_id long, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)
    mk([(4, "2024-01-01 00:40:00", 1, "a", 1.0, "{}")]).write.parquet(src + "/b2")
    mk([(3, "2024-01-01 00:01:00", 1, "a", 5.0, "{}")]).write.parquet(src + "/b3")
    stream = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    out = windowed_increase(metric_samples(stream), ["job", "instance"], "ts", "inc", "event_id",
                            "5 minutes", None, "10 minutes")
    q = (out.writeStream.format("memory").queryName("late_test").outputMode("append")
            .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.window_start.strftime("%H:%M"): r.samples for r in spark.table("late_test").collect()}
    # the 00:01 row arrives two batches after the watermark passed 00:05:
    # its window was already emitted and the row is dropped
    assert got.get("00:00") == 1 and got.get("00:15") == 1  # 00:20 is the end of (00:15, 00:20]


SAMPLES = "id long, ts timestamp_ntz, series string, value double"


def streamed_rate(spark, files, window, slide, pane=None):
    """Rate of raw readings streamed file by file."""
    root = tempfile.mkdtemp(prefix="rivulet-state-")
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SAMPLES).coalesce(1).write.parquet(f"{root}/in/b{k}")
        part = next(f for f in os.listdir(f"{root}/in/b{k}") if f.startswith("part-"))
        os.utime(f"{root}/in/b{k}/{part}", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = (spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(root + "/in"))
    out = counter_rate_stream(stream, ["series"], "ts", "value", "id", window, slide, "1 minute", pane_seconds=pane)
    got = run_available_now(spark, out, root + "/out", root + "/ck")
    return sorted(map(tuple, got.select("window_start", "series", "samples", "increase", "rate").collect()))


def closed_rate(spark, rows, window, slide):
    """The same windows in batch, as far as the watermark passes them."""
    horizon = max(r[1] for r in rows if r[3] is not None) - dt.timedelta(minutes=1, microseconds=1)
    batch = M.counter_rate(spark.createDataFrame(rows, SAMPLES), ["series"], "ts", "value", "id", window, slide)
    return sorted(map(tuple, batch.filter(F.col("window_end") <= F.lit(horizon).cast("timestamp_ntz"))
                  .select("window_start", "series", "samples", "increase", "rate").collect()))


def test_counter_stream_equals_batch_whatever_the_files(spark):
    """Resets, null readings, and samples out of order within a file; one file or several."""
    rnd = random.Random(1)
    rows = [(i, t, s, None if rnd.random() < 0.2 else v) for i, t, s, v in dense_samples(n_series=2, n=250, seed=11)]
    rows.sort(key=lambda r: (r[1], r[0]))  # split by time
    want = closed_rate(spark, rows, "5 minutes", "1 minute")
    parts = [rows[k:k + 130] for k in range(0, len(rows), 130)]
    for part in parts:
        rnd.shuffle(part)
    assert streamed_rate(spark, [rows], "5 minutes", "1 minute") == want and len(want) > 100
    assert streamed_rate(spark, parts, "5 minutes", "1 minute", pane=20) == want


def test_null_reading_is_no_sample_of_a_stream(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(1, at(1), "a", 10.0), (2, at(2), "a", None), (3, at(3), "a", 30.0), (4, at(30), "a", 30.0)]
    got = streamed_rate(spark, [rows], "10 minutes", None)
    assert got[0][1:] == ("a", 2, 20.0, round(20 / 120, 6))


def test_counter_stream_window_not_multiple_of_slide(spark):
    rows = sorted(dense_samples(n_series=2, n=150, seed=4), key=lambda r: (r[1], r[0]))
    want = closed_rate(spark, rows, "10 minutes", "3 minutes")
    assert streamed_rate(spark, [rows], "10 minutes", "3 minutes") == want and len(want) > 20


def test_health_stream_tells_silence(spark):
    """Each step and job once: sums of the newest samples, Offline between, after the last sample and for a job that never reports."""
    from rivulet.streaming.health import health_stream
    rnd = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(seconds=rnd.randrange(1, 3 * 3600)), job, rnd.choice(["x", "y", None]), rnd.choice([0, 1, None]))
            for k in range(60) for job in (["api"] if k % 3 else ["api", "db"])]
    rows = [r for r in rows if r[2] == "api" or r[1] < t0 + dt.timedelta(hours=1)]
    rows += [(900, t0 + dt.timedelta(hours=4), "api", "x", 1)]
    rows = [(k, *r[1:]) for k, r in enumerate(sorted(rows, key=lambda r: r[1]))]
    schema = "id long, ts timestamp_ntz, job string, instance string, up int"
    root = tempfile.mkdtemp(prefix="rivulet-health-")
    for k in range(0, len(rows), 25):
        part = rows[k:k + 25]
        rnd.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{root}/in/b{k}")
        name = next(f for f in os.listdir(f"{root}/in/b{k}") if f.startswith("part-"))
        os.utime(f"{root}/in/b{k}/{name}", (1_700_000_000 + k,) * 2)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(root + "/in"))
    jobs = spark.createDataFrame([("api",), ("ghost",)], "job string")
    out = health_stream(stream, jobs, "job", "instance", "ts", "up", "id", 1800, "1 minute", start=t0 + dt.timedelta(seconds=1))
    got = {(r.step, r.job): (r.up, r.status) for r in run_available_now(spark, out, root + "/out", root + "/ck", rocksdb=True).collect()}
    want = {}
    for job in ("api", "db", "ghost"):
        for n in range(1, 8):  # the watermark ends at 3:59
            step = t0 + dt.timedelta(seconds=1800 * n)
            newest = {}
            for i, ts, j, instance, up in rows:
                if j == job and step - dt.timedelta(seconds=1800) < ts <= step:
                    newest[instance or ""] = max(newest.get(instance or "", (t0, -1, None)), (ts, i, up), key=lambda x: x[:2])
            ups = [x[2] for x in newest.values() if x[2] is not None]
            total = sum(ups) if ups else None
            want[(step, job)] = (total, "Offline" if total is None else "green" if total >= 1 else "red")
    assert got == want
