"""Time-series metric queries over a long sample table.

Samples are rows ``(series columns..., ts, value)``.  Series are identified by
ordinary columns (a labels map can be projected into them, and filtered with
:func:`rivulet.operators.filters.match_labels`).

Scale notes
-----------
A series can hold a large share of all samples, so nothing here partitions by
the series alone over raw samples.  Order-dependent steps (previous sample,
running sums) are split into fixed time buckets: the per-sample work runs in
``(series, bucket)`` partitions, and only one summary row per
``(series, bucket)`` crosses bucket borders.  Everything else is partial
(map-side) aggregation.  Windows and instant vectors first reduce the samples to
panes (the greatest common divisor of window and slide, or lookback and step), and
only pane rows are copied into the windows that hold them.  "Newest" and "first"
are ordered by one fixed-width key, so they stay hash aggregates.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.clean import round_half_even, uptime_seconds

MICROS = 1_000_000


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch for a TIMESTAMP or TIMESTAMP_NTZ column.

    NTZ values are read as wall-clock UTC, independent of the session zone.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col(ts))
    return F.unix_micros(F.col(ts))


def ntz_from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz())


def _floor_div(a: Column, b: int) -> Column:
    # exact integer floor division (a - pmod(a, b) is a multiple of b)
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def _ceil_div(a: Column, b: int) -> Column:
    return -_floor_div(-a, b)


def series_labels(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """A missing label is the empty label (the same series), so string series
    columns are coalesced to ''; the series joins below then never meet a null key."""
    fix = {c: F.coalesce(F.col(c), F.lit("")) for c in series
           if isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(fix) if fix else df


def order_key(us: Column, tiebreak: Column | None = None) -> Column:
    """One decimal that sorts by (time in microseconds, integer tiebreak): fits an in-place aggregation buffer."""
    if tiebreak is None:
        return us.cast("decimal(38,0)")
    shifted = tiebreak.cast("decimal(19,0)") + F.lit("9223372036854775808").cast("decimal(19,0)")
    return (us.cast("decimal(18,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)") \
        + shifted.cast("decimal(38,0)")


def _join_on_series(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join on series + bucket keys.  Series label values are never
    null (a missing label is ''), so a plain join keeps the left side's
    ``(series, bucket)`` hash partitioning: only the small right side moves."""
    return left.join(right, list(keys), "left")


BUCKET = "time_bucket"


def with_time_bucket(df: DataFrame, ts: str, bucket_seconds: int = 3600, col: str = BUCKET) -> DataFrame:
    """Add the fixed time bucket used to split order-dependent work (kept if present).

    Operators chained on the same bucket column share one hash partitioning
    ``(series..., bucket)``, so Spark plans no second shuffle of the samples.
    """
    if col in df.columns:
        return df
    return df.withColumn(col, _floor_div(epoch_micros(df, ts), bucket_seconds * MICROS))


def counter_from_increments(df: DataFrame, series: Sequence[str], ts: str, increment: str,
                            tiebreak: str, out: str = "counter", bucket_seconds: int = 3600) -> DataFrame:
    """Running sum of ``increment`` per series in ``(ts, tiebreak)`` order.

    Distributed prefix sum: bucket totals (partial aggregation, a cheap
    second scan) -> per-series prefix over buckets (one row per bucket) ->
    running sum inside each ``(series, bucket)`` partition + the bucket's
    offset.  The samples are shuffled once.  ``bucket_seconds`` bounds what
    one task sorts: choose it so that a hot series' bucket fits.
    """
    series = list(series)
    df = series_labels(df, series)
    b = with_time_bucket(df, ts, bucket_seconds).withColumn(
        "_inc0", F.coalesce(F.col(increment), F.lit(0).cast(df.schema[increment].dataType)))
    totals = b.groupBy(*series, BUCKET).agg(F.sum("_inc0").alias("_bt"))
    before = Window.partitionBy(*series).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*series, BUCKET, F.coalesce(F.sum("_bt").over(before),
                                                        F.lit(0).cast(totals.schema["_bt"].dataType)).alias("_off"))
    w = Window.partitionBy(*series, BUCKET).orderBy(F.col(ts), F.col(tiebreak))
    within = b.withColumn("_run", F.sum("_inc0").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (_join_on_series(within, offsets, [*series, BUCKET])
            .withColumn(out, F.col("_off") + F.col("_run")).drop("_off", "_run", "_inc0"))


def with_previous(df: DataFrame, series: Sequence[str], ts: str, value: str, tiebreak: str,
                  bucket_seconds: int = 3600, prev_ts: str = "prev_ts", prev_value: str = "prev_value") -> DataFrame:
    """Add the previous sample (ts, value) of the same series (null for the first).

    Inside a ``(series, bucket)`` partition this is ``lag`` of the whole
    sample, so time and value always come from one row, also where the value
    is null; the first sample of a bucket takes the last sample of the series'
    previous non-empty bucket, from a table with one row per
    ``(series, bucket)``.
    """
    series = list(series)
    df = series_labels(df, series)
    b = with_time_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(*series, BUCKET).orderBy(F.col(ts), F.col(tiebreak))
    sample = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    inner = b.withColumn("_prev", F.lag(sample).over(w))
    key = order_key(epoch_micros(b, ts), F.col(tiebreak))
    last = (b.groupBy(*series, BUCKET).agg(F.max_by(epoch_micros(b, ts), key).alias("_lt"), F.max_by(value, key).alias("_lv"))
             .withColumn("_last", F.struct(_ts_from_micros(df, ts, F.col("_lt")).alias("t"), F.col("_lv").alias("v"))))
    carry = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*series).orderBy(BUCKET)))
    return (_join_on_series(inner, carry.select(*series, BUCKET, "_carry"), [*series, BUCKET])
                 .withColumn("_prev", F.coalesce("_prev", "_carry"))
                 .withColumns({prev_ts: F.col("_prev.t"), prev_value: F.col("_prev.v")}).drop("_prev", "_carry"))


def _ts_from_micros(df: DataFrame, ts: str, us: Column) -> Column:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return ntz_from_micros(us)
    return F.timestamp_micros(us)


def counter_delta(value: Column, prev: Column) -> Column:
    """Increase between two counter samples; a drop is a reset (count from 0)."""
    return F.when(prev.isNull(), F.lit(None)).when(value < prev, value).otherwise(value - prev)


# --- counter summaries: what a window needs to know of the samples of one pane ---------------

SUMMARY = ("n", "lo", "hi", "lo_v", "hi_v", "up")


def pane_summary(samples: Column) -> Column:
    """Summary of the samples (us, tb, v) of one series and pane, in any order.

    ``n`` samples, time and value of the first (``lo``, ``lo_v``) and last (``hi``, ``hi_v``), and ``up``,
    the increase over consecutive samples with resets counted from zero.
    """
    def whole(x: Column) -> Column:
        n = F.size(x)
        steps = F.zip_with(F.slice(x, 1, n - 1), F.slice(x, 2, n), lambda a, b: counter_delta(b["v"], a["v"]).cast("double"))
        up = F.aggregate(steps, F.lit(0.0), lambda total, d: total + d)
        first, last = F.element_at(x, 1), F.element_at(x, -1)
        return F.struct(n.cast("long").alias("n"), first["us"].alias("lo"), last["us"].alias("hi"),
                        first["v"].cast("double").alias("lo_v"), last["v"].cast("double").alias("hi_v"), up.alias("up"))
    return F.get(F.transform(F.array(F.array_sort(samples)), whole), 0)


def joined_summaries(panes: Column) -> Column:
    """One summary of the summaries of a series in order of time (an array): associative, so any grouping of panes gives the same."""
    empty = F.lit(None).cast("struct<n:bigint,lo:bigint,hi:bigint,lo_v:double,hi_v:double,up:double>")

    def join(a: Column, b: Column) -> Column:
        both = F.struct((a["n"] + b["n"]).alias("n"), a["lo"].alias("lo"), b["hi"].alias("hi"), a["lo_v"].alias("lo_v"),
                        b["hi_v"].alias("hi_v"), (a["up"] + b["up"] + counter_delta(b["lo_v"], a["hi_v"])).alias("up"))
        return F.when(a.isNull(), F.struct(*[b[c].alias(c) for c in SUMMARY])).otherwise(both)
    return F.aggregate(panes, empty, join)


def rate_of(summary: Column, digits: int | None = 6, window_start: Column | None = None, window_end: Column | None = None) -> Column:
    """Increase a second of a summary; null with fewer than two samples or no time between them.

    With the window's borders (microseconds) the increase is extended to them: on each side by the way to the
    border, but by half the mean distance of samples where the border is 1.1 distances
    or more away, and at the start not beyond the moment at which the counter would have been zero; the rate
    is then a second of the whole window.
    """
    seconds = (summary["hi"] - summary["lo"]) / F.lit(float(MICROS))
    enough = (summary["n"] >= 2) & (seconds > 0)
    if window_start is None or window_end is None:
        rate = F.when(enough, F.try_divide(summary["up"], seconds))
    else:
        gap = seconds / (summary["n"] - 1)
        reach = lambda way: F.when(way >= gap * 1.1, gap / 2).otherwise(way)
        before = (summary["lo"] - window_start) / F.lit(float(MICROS))
        to_zero = F.when((summary["up"] > 0) & (summary["lo_v"] >= 0), seconds * summary["lo_v"] / summary["up"])
        before = F.least(before, to_zero)  # nulls are passed over
        after = (window_end - summary["hi"]) / F.lit(float(MICROS))
        whole = (window_end - window_start) / F.lit(float(MICROS))
        rate = F.when(enough, summary["up"] * F.try_divide(seconds + reach(before) + reach(after), seconds) / whole)
    return round_half_even(rate, digits) if digits is not None else rate


def sample_struct(df: DataFrame, ts: str, value: str, tiebreak: str) -> Column:
    return F.struct(epoch_micros(df, ts).alias("us"), F.col(tiebreak).cast("long").alias("tb"), F.col(value).alias("v"))


def pane_micros(win: int, step: int, pane_seconds: int | None) -> int:
    """Microseconds of a pane: ``pane_seconds`` where it divides window and slide, else their divisor."""
    g = gcd(win, step)
    return (pane_seconds if pane_seconds and g % pane_seconds == 0 else g) * MICROS


def counter_rate(df: DataFrame, series: Sequence[str], ts: str, value: str, tiebreak: str,
                 window: str = "5 minutes", slide: str | None = None,
                 pane_seconds: int | None = 3600, digits: int | None = 6, extrapolate: bool = False) -> DataFrame:
    """``rate(counter[window])`` of raw counter readings on (sliding) time windows ``(start, end]``.

    For each window and series: the samples inside, their increase (sum over
    consecutive pairs inside the window, resets counted from zero) and the rate
    = increase / seconds between the first and last sample (null with fewer
    than two samples); ``extrapolate`` extends it to the window's borders (see :func:`rate_of`).  Null readings
    are no samples.

    The samples are read once and reduced to one summary for each series and pane, which
    spreads a hot series over its panes; windows join the summaries of
    their panes.  ``pane_seconds`` bounds what one group holds.
    """
    series = list(series)
    win = seconds_of(window)
    step = seconds_of(slide) if slide else win
    pane = pane_micros(win, step, pane_seconds)
    win, step = win * MICROS, step * MICROS
    x = series_labels(df.filter(F.col(value).isNotNull()), series)
    us = epoch_micros(x, ts)
    panes = (x.groupBy(_ceil_div(us, pane).alias("_pane"), *series)
             .agg(pane_summary(F.collect_list(sample_struct(x, ts, value, tiebreak))).alias("_s")))
    agg = (panes.withColumn("_k", F.explode(_windows_of(F.col("_pane"), pane, win, step))).groupBy("_k", *series)
           .agg(joined_summaries(F.transform(F.array_sort(F.collect_list(F.struct("_pane", "_s"))), lambda p: p["_s"])).alias("_s")))
    start, end = F.col("_k") * step, F.col("_k") * step + F.lit(win)
    rate = rate_of(F.col("_s"), digits, *((start, end) if extrapolate else ()))
    return agg.select(ntz_from_micros(start).alias("window_start"), ntz_from_micros(end).alias("window_end"), *series,
                      F.col("_s.n").alias("samples"), F.col("_s.up").alias("increase"), rate.alias("rate"))


def _windows_of(pane: Column, size: int, win: int, step: int) -> Column:
    """Numbers of the windows (k step, k step + win] that hold the pane ((p - 1) size, p size]."""
    return F.sequence(-_floor_div(F.lit(win) - pane * size, step), _floor_div((pane - 1) * size, step))


def counter_rate_from_increments(df: DataFrame, series: Sequence[str], ts: str, increment: str,
                                 tiebreak: str, window: str = "5 minutes", slide: str | None = None,
                                 digits: int | None = 6) -> DataFrame:
    """``rate()`` of the counter whose increments are given (no resets by
    construction), on windows ``(start, end]``.  A window's increase is the sum of the increments of its
    samples but the first.  Same output as :func:`counter_rate` on the running
    counter; partial aggregation only, no window over raw samples.
    """
    series = list(series)
    df = series_labels(df, series)
    inc = F.coalesce(F.col(increment), F.lit(0).cast(df.schema[increment].dataType))
    return _windowed_rate(df, series, ts, inc, tiebreak, window, slide, digits)


def seconds_of(interval: str) -> int:
    """Whole seconds of '5 minutes', '1 day', '30 seconds', ..."""
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit.rstrip("s")]


def _windowed_rate(x: DataFrame, series: list[str], ts: str, delta: Column, tiebreak: str, window: str,
                   slide: str | None, digits: int | None) -> DataFrame:
    """Windows of ``window`` every ``slide``, from panes.

    A window's increase is the sum of its samples' deltas without that of its
    first sample, whose predecessor lies before the window.
    """
    win = seconds_of(window)
    step = seconds_of(slide) if slide else win
    pane = gcd(win, step) * MICROS
    win, step = win * MICROS, step * MICROS
    us = epoch_micros(x, ts)
    key = order_key(us, F.col(tiebreak))
    panes = (x.withColumn("_d", delta).groupBy(_ceil_div(us, pane).alias("_pane"), *series)
              .agg(F.count(F.lit(1)).alias("n"), F.sum("_d").alias("d"), F.min_by("_d", key).alias("d0"),
                   F.min(us).alias("lo"), F.max(us).alias("hi")))
    spread = panes.select(*series, "_pane", "n", "d", "d0", "lo", "hi", F.explode(_windows_of(F.col("_pane"), pane, win, step)).alias("_k"))
    agg = (spread.groupBy("_k", *series)
           .agg(F.sum("n").alias("samples"), F.sum("d").alias("_sum"), F.min_by("d0", "_pane").alias("_first"),
                ((F.max("hi") - F.min("lo")) / F.lit(float(MICROS))).alias("elapsed_s")))
    increase = F.coalesce(F.col("_sum"), F.lit(0)) - F.coalesce(F.col("_first"), F.lit(0))
    rate = F.when(F.col("samples") >= 2, F.try_divide(F.col("increase"), F.col("elapsed_s")))
    start = F.col("_k") * step
    return (agg.withColumn("increase", increase.cast("double"))
            .select(ntz_from_micros(start).alias("window_start"), ntz_from_micros(start + F.lit(win)).alias("window_end"),
                    *series, "samples", "increase",
                    (round_half_even(rate, digits) if digits is not None else rate).alias("rate")))


def sum_by(df: DataFrame, by: Sequence[str], value: str = "rate", out: str | None = None,
           digits: int | None = 6) -> DataFrame:
    """``sum(x) by (labels)`` on an evaluated vector (keeps the window columns)."""
    keep = [c for c in ("window_start", "window_end", "step") if c in df.columns]
    s = F.sum(value)
    return df.groupBy(*keep, *by).agg((round_half_even(s, digits) if digits is not None else s).alias(out or value))


def _newest(df: DataFrame, ts: str, value: str, tiebreak: str | None) -> tuple[Column, Column]:
    """(value of the newest sample, its time in microseconds) as aggregates; NaN and nulls are values like others."""
    us = epoch_micros(df, ts)
    return F.max_by(F.col(value), order_key(us, F.col(tiebreak) if tiebreak else None)), F.max(us)


def instant_range(df: DataFrame, series: Sequence[str], ts: str, value: str,
                  step_seconds: int, lookback_seconds: int = 300,
                  tiebreak: str | None = None) -> DataFrame:
    """Instant vector at every epoch-aligned step: newest sample per series in
    ``(step - lookback, step]``.

    Samples are reduced to the newest per series and pane (pane ``p`` covers
    ``((p - 1) * g, p * g]``, g the divisor of step and lookback); the panes,
    not the samples, are copied to the steps that see them.
    """
    series = list(series)
    st, lb = step_seconds * MICROS, lookback_seconds * MICROS
    g = gcd(st, lb)
    newest, at = _newest(df, ts, value, tiebreak)
    panes = (df.groupBy(_ceil_div(epoch_micros(df, ts), g).alias("_p"), *series)
               .agg(newest.alias(value), at.alias("_us")))
    k0 = _ceil_div(F.col("_p") * g, st)
    k1 = _ceil_div(F.col("_p") * g + F.lit(lb), st) - 1
    seen = panes.withColumn("_k0", k0).withColumn("_k1", k1).filter("_k0 <= _k1")  # else no step looks back on the pane
    if lb <= st:  # one step at most
        steps = seen.withColumnRenamed("_k0", "_k")
        return steps.select(ntz_from_micros(F.col("_k") * F.lit(st)).alias("step"), *series, value, "_p", "_us") \
            .groupBy("step", *series).agg(F.max_by(value, "_p").alias(value), _ts_from_micros(df, ts, F.max("_us")).alias("sample_ts"))
    spread = seen.withColumn("_k", F.explode(F.sequence("_k0", "_k1")))
    return (spread.groupBy("_k", *series).agg(F.max_by(value, "_p").alias(value), F.max("_us").alias("_us"))
            .select(ntz_from_micros(F.col("_k") * F.lit(st)).alias("step"), *series, value,
                    _ts_from_micros(df, ts, F.col("_us")).alias("sample_ts")))


def instant_at(df: DataFrame, series: Sequence[str], ts: str, value: str, at: Column,
               lookback_seconds: int = 300, tiebreak: str | None = None) -> DataFrame:
    """Instant vector at one evaluation time ``at`` (a timestamp column/literal)."""
    lo = at - F.make_interval(secs=F.lit(lookback_seconds))
    inside = df.filter((F.col(ts) > lo) & (F.col(ts) <= at))
    return inside.groupBy(*series).agg(_newest(inside, ts, value, tiebreak)[0].alias(value))


def recent(df: DataFrame, ts: str, now: _dt.datetime, seconds: int) -> DataFrame:
    """Samples in ``(now - seconds, now]``; the borders are literals of the column's own type, so the filter reaches the scan."""
    kind = df.schema[ts].dataType.simpleString()
    border = lambda t: F.lit(t.isoformat(sep=" ")).cast(kind)
    return df.filter((F.col(ts) > border(now - _dt.timedelta(seconds=seconds))) & (F.col(ts) <= border(now)))


def increase_before(df: DataFrame, series: Sequence[str], ts: str, increment: str, now: _dt.datetime, seconds: int) -> DataFrame:
    """What :func:`recent` leaves out, summed: (series, increment) of all samples up to ``now - seconds``."""
    kind = df.schema[ts].dataType.simpleString()
    border = F.lit((now - _dt.timedelta(seconds=seconds)).isoformat(sep=" ")).cast(kind)
    return df.filter(F.col(ts) <= border).groupBy(*series).agg(F.sum(increment).alias(increment))


def last_counter(recent_samples: DataFrame, before: DataFrame, series: Sequence[str], ts: str, increment: str, tiebreak: str,
                 out: str = "last") -> DataFrame:
    """The running sum of ``increment`` at each series' newest recent sample, in (ts, tiebreak) order with null tiebreaks last.

    ``before`` holds the sums of the samples before the recent ones (:func:`increase_before`).  The sum at the
    newest sample is that of all samples, but for those that share its time and have no tiebreak where it has one.
    Partial aggregation only, no window over samples; a series without a recent sample has no row.
    """
    series = list(series)
    ranked = F.col(tiebreak).isNotNull()
    inc = F.col(increment)
    moments = recent_samples.groupBy(*series, epoch_micros(recent_samples, ts).alias("_us")).agg(
        F.sum(inc).alias("_sum"), F.count(inc).alias("_n"), F.count_if(ranked).alias("_ranked"),
        F.sum(F.when(~ranked, inc)).alias("_tail"), F.count(F.when(~ranked, inc)).alias("_tail_n"))
    moments = moments.select(*series, "_us", "_sum", "_n", F.when(F.col("_ranked") > 0, F.coalesce("_tail", F.lit(0))).otherwise(0).alias("_tail"),
                             F.when(F.col("_ranked") > 0, F.col("_tail_n")).otherwise(0).alias("_tail_n"))
    past = before.select(*series, F.lit(None).cast("long").alias("_us"), F.col(increment).alias("_sum"),
                         F.when(F.col(increment).isNotNull(), 1).otherwise(0).cast("long").alias("_n"),
                         F.lit(0).cast("long").alias("_tail"), F.lit(0).cast("long").alias("_tail_n"))
    at = moments.unionByName(past).groupBy(*series).agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max("_us").alias("_us"),
        F.max_by("_tail", "_us").alias("_tail"), F.max_by("_tail_n", "_us").alias("_tail_n"))
    reading = F.when(F.col("_n") > F.col("_tail_n"), F.col("_sum") - F.col("_tail"))
    return at.filter("_us is not null").select(*series, reading.cast("double").alias(out), _ts_from_micros(recent_samples, ts, F.col("_us")).alias("last_ts"))


def health_status(vector: DataFrame, job: str, value: str, step_seconds: int, jobs: DataFrame | None = None,
                  start: Column | None = None, end: Column | None = None, out: str = "up", extra_steps: int = 0) -> DataFrame:
    """``sum(up) by (job)`` per step with a traffic-light status.

    The grid holds every step of the query range for every job: ``jobs`` (one
    column named like ``job``; default: the jobs of the vector) from ``start``
    to ``end`` (default: the vector's first step, and ``extra_steps`` behind its last one, over all jobs).  A
    job without a sample at a step, before its first, after its last or at any
    step, is ``Offline``; a sum >= 1 is ``green``, else ``red``.
    """
    st = step_seconds * MICROS
    us_of = lambda c: F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)
    sums = vector.groupBy("step", job).agg(F.sum(value).alias(out))
    # a row for each job with its sums by step; the range is taken over these rows, so the vector is evaluated once
    point = F.struct(us_of(F.col("step")).alias("us"), F.col(out).alias("up"))
    per_job = sums.groupBy(job).agg(F.sort_array(F.collect_list(point)).alias("_p"))
    if jobs is not None:
        listed = jobs.select(F.col(job)).distinct().select(job, F.lit(None).cast(per_job.schema["_p"].dataType).alias("_p"), F.lit(True).alias("_listed"))
        per_job = (per_job.withColumn("_listed", F.lit(False)).unionByName(listed).groupBy(job)
                   .agg(F.flatten(F.collect_list("_p")).alias("_p"), F.max("_listed").alias("_listed")))
    everywhere = Window.partitionBy()
    lo = us_of(start) if start is not None else F.min(F.get("_p", F.lit(0))["us"]).over(everywhere)
    hi = us_of(end) if end is not None else F.max(F.try_element_at("_p", F.lit(-1))["us"]).over(everywhere) + F.lit(extra_steps * st)
    grid = per_job.withColumns({"_lo": _ceil_div(lo, st) * st, "_hi": hi}).filter("_lo <= _hi" + (" and _listed" if jobs is not None else ""))
    inside = F.filter(F.coalesce("_p", F.array().cast(per_job.schema["_p"].dataType)), lambda p: p["us"].between(F.col("_lo"), F.col("_hi")))
    begin = F.struct(F.col("_lo").alias("us"), F.lit(None).cast(sums.schema[out].dataType).alias("up"))
    points = grid.withColumn("_p", inside).withColumn(
        "_p", F.when(F.coalesce(F.get("_p", F.lit(0))["us"] == F.col("_lo"), F.lit(False)), F.col("_p")).otherwise(F.concat(F.array(begin), "_p")))
    # each point stands for itself and the silent steps up to the next one
    last = points.select(job, "_hi", F.posexplode(F.zip_with("_p", F.slice("_p", F.lit(2), F.size("_p")), lambda p, q: F.struct(
        p["us"].alias("us"), p["up"].alias("up"), q["us"].alias("next")))).alias("_i", "_q"))
    steps = F.sequence(F.col("_q.us"), F.least(F.col("_q.next") - st, F.col("_hi")), F.lit(st))
    rows = last.select(job, "_q.up", F.posexplode(steps).alias("_n", "_us"))
    found = rows.select(ntz_from_micros(F.col("_us")).alias("step"), job, F.when(F.col("_n") == 0, F.col("up")).alias(out))
    return found.withColumn("status", health_of(F.col(out)))


def health_of(up: Column) -> Column:
    """Traffic light of a job's sum: ``Offline`` without a sample, ``green`` from 1 on, else ``red``."""
    return F.when(up.isNull(), "Offline").when(up >= 1, "green").otherwise("red")


def last_value(df: DataFrame, series: Sequence[str], ts: str, value: str,
               tiebreak: str | None = None, out: str = "last") -> DataFrame:
    """``last`` reducer: the newest value of each series."""
    newest, at = _newest(df, ts, value, tiebreak)
    return df.groupBy(*series).agg(newest.alias(out), at.alias("_us")) \
        .select(*series, out, _ts_from_micros(df, ts, F.col("_us")).alias("last_ts"))


def uptime(df: DataFrame, series: Sequence[str], ts: str, as_of: Column) -> DataFrame:
    """Seconds from each series' first sample to ``as_of`` (for sources without a start-time gauge)."""
    start = df.groupBy(*series).agg(F.min(ts).alias("start_ts"))
    return start.withColumn(
        "uptime_s",
        (F.timestamp_diff("MICROSECOND", F.col("start_ts"), as_of) / F.lit(float(MICROS))))


def gauge_uptime(df: DataFrame, series: Sequence[str], ts: str, start_seconds: str, as_of: Column, lookback_seconds: int = 300,
                 tiebreak: str | None = None) -> DataFrame:
    """``time() - start``: seconds since the start time (epoch seconds) that each series' gauge last reported.

    Evaluated at ``as_of`` with the usual lookback: a series that stopped reporting has no row.
    """
    now = instant_at(df, series, ts, start_seconds, as_of, lookback_seconds, tiebreak)
    return now.select(*series, start_seconds, uptime_seconds(start_seconds, as_of).alias("uptime_s"))


def count_series(vector: DataFrame, by: Sequence[str] = ("step",), out: str = "series") -> DataFrame:
    """``count(vector)``: number of series present per step."""
    return vector.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
