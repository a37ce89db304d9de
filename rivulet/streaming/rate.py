"""Streaming metric queries over windows with a watermark (append mode).

``rate()``: the stream carries counter *increments* (the difference between
consecutive readings, as an exporter's delta or the event value).  Then a
window's increase is the sum of its increments minus the first one (the first
pair starts before the window), which is a plain, partially aggregated
streaming aggregation: state is one row per open (window, series), never a
list of samples.  ``sum(rate()) by (labels)`` chains a second windowed
aggregation on the first one's window.  Instant vectors per step are a
tumbling-window ``max_by``.  Rows later than the watermark are dropped; a
window is emitted once the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.clean import round_half_even
from rivulet.operators.metrics import (
    MICROS, epoch_micros, joined_summaries, ntz_from_micros, order_key, pane_micros, pane_summary, rate_of, sample_struct, seconds_of, series_labels,
)


def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """TIMESTAMP column for watermarks (NTZ wall-clock read as UTC, session-zone free)."""
    return df.withColumn(out, F.timestamp_micros(epoch_micros(df, ts)))


def shifted(stream: DataFrame, ts: str, watermark: str) -> DataFrame:
    """``event_time`` and ``shifted_time``, a microsecond before it: windows [start, end) of the latter are (start, end] of the former.

    The watermark is declared on the shifted time itself (a derived column
    would lose the event-time marker), i.e. it trails by one microsecond more.
    """
    return (event_time(stream, ts).withColumn("shifted_time", F.col("event_time") - F.expr("INTERVAL 1 MICROSECOND"))
            .withWatermark("shifted_time", watermark))


def counter_rate_stream(stream: DataFrame, series: Sequence[str], ts: str, value: str, tiebreak: str, window: str, slide: str | None,
                        watermark: str, digits: int | None = 6, pane_seconds: int | None = 3600) -> DataFrame:
    """``rate()`` of raw counter readings with resets, as :func:`rivulet.operators.metrics.counter_rate`; append mode.

    Two chained windowed aggregations of built-in functions.  The first gathers the samples of a series and pane
    until the watermark has passed the pane, whatever their order and files, and reduces them to a
    summary; the second joins the summaries of a window.  A hot series is as many
    keys as it has panes.  Null readings are no samples; samples behind the watermark are dropped.
    """
    series = list(series)
    s = shifted(series_labels(stream.filter(F.col(value).isNotNull()), series), ts, watermark)
    win = seconds_of(window)
    step = seconds_of(slide) if slide else win
    pane = pane_micros(win, step, pane_seconds) // MICROS
    panes = (s.groupBy(F.window("shifted_time", f"{pane} seconds").alias("w"), *series)
             .agg(F.collect_list(sample_struct(s, ts, value, tiebreak)).alias("_x"))
             .select("w", *series, pane_summary(F.col("_x")).alias("_s")))
    wide = F.window("w", f"{win} seconds", f"{step} seconds").alias("v")
    joined = (panes.groupBy(wide, *series).agg(F.collect_list("_s").alias("_p"))
              .select("v", *series, joined_summaries(F.array_sort("_p", lambda a, b: F.when(a["lo"] < b["lo"], -1).otherwise(1))).alias("_s")))
    return joined.select(*_window_columns("v"), *series, F.col("_s.n").alias("samples"), F.col("_s.up").alias("increase"),
                         rate_of(F.col("_s"), digits).alias("rate"))


def _window_agg(stream: DataFrame, series: Sequence[str], ts: str, inc: str, tiebreak: str,
                window: str, slide: str | None, watermark: str, digits: int | None) -> DataFrame:
    """Per (window struct ``w``, series): samples, increase, rate (streaming)."""
    s = shifted(stream, ts, watermark)
    w = F.window("shifted_time", window, slide) if slide else F.window("shifted_time", window)
    us = F.unix_micros(F.col("event_time"))
    agg = (s.groupBy(w.alias("w"), *series)
            .agg(F.count(F.lit(1)).alias("samples"),
                 F.sum(inc).alias("_sum"),
                 F.min_by(F.col(inc), order_key(us, F.col(tiebreak))).alias("_first"),
                 F.min(us).alias("_lo"), F.max(us).alias("_hi")))
    increase = (F.col("_sum") - F.col("_first")).cast("double")
    elapsed = (F.col("_hi") - F.col("_lo")) / F.lit(float(MICROS))
    rate = F.when(F.col("samples") >= 2, F.try_divide(increase, elapsed))
    return agg.select("w", *series, "samples", increase.alias("increase"),
                      (round_half_even(rate, digits) if digits is not None else rate).alias("rate"))


def _window_columns(w: str = "w") -> list:
    return [ntz_from_micros(F.unix_micros(F.col(f"{w}.start"))).alias("window_start"),
            ntz_from_micros(F.unix_micros(F.col(f"{w}.end"))).alias("window_end")]


def windowed_increase(stream: DataFrame, series: Sequence[str], ts: str, inc: str, tiebreak: str,
                      window: str, slide: str | None, watermark: str, digits: int | None = 6) -> DataFrame:
    """Per (window, series): samples, increase and rate, for a streaming frame."""
    agg = _window_agg(stream, series, ts, inc, tiebreak, window, slide, watermark, digits)
    return agg.select(*_window_columns(), *series, "samples", "increase", "rate")


def windowed_rate_sum(stream: DataFrame, series: Sequence[str], by: Sequence[str], ts: str, inc: str,
                      tiebreak: str, window: str, slide: str | None, watermark: str,
                      digits: int | None = 6) -> DataFrame:
    """``sum(rate(...)) by (labels)`` as two chained windowed aggregations.

    The second aggregation groups by the first one's window column, which
    carries the event-time watermark, so both run in append mode; a window's
    sum is emitted once the watermark has passed its end.
    """
    per_series = _window_agg(stream, series, ts, inc, tiebreak, window, slide, watermark, digits)
    total = F.sum("rate")
    summed = per_series.groupBy("w", *by).agg(
        (round_half_even(total, digits) if digits is not None else total).alias("rate"))
    return summed.select(*_window_columns(), *by, "rate")


def instant_steps(stream: DataFrame, series: Sequence[str], ts: str, value: str, tiebreak: str,
                  step: str, watermark: str) -> DataFrame:
    """Streaming instant vector with lookback = step: the newest value per
    series in ``(t - step, t]`` for every step ``t``.

    A tumbling window over ``ts - 1µs`` maps a sample at ``ts`` to the step
    ``t`` with ``t - step < ts <= t``; ``max_by`` keeps the newest (partial
    aggregation, one state row per open step and series).
    """
    s = shifted(stream, ts, watermark)
    agg = (s.groupBy(F.window("shifted_time", step).alias("w"), *series)
            .agg(F.max_by(F.col(value), order_key(F.unix_micros("event_time"), F.col(tiebreak))).alias(value)))
    return agg.select(_window_columns()[1].alias("step"), *series, value)


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available_now(spark: SparkSession, out: DataFrame, path: str, checkpoint: str, rocksdb: bool = False) -> DataFrame:
    """Run a streaming frame to the end of its current input (``availableNow``)
    into a parquet table (file sink: exactly once, committed files only) and
    return that table.  ``path`` and ``checkpoint`` belong in a shared folder.
    ``rocksdb`` keeps the state in RocksDB, as typed keyed state and timers need it."""
    before = spark.conf.get(STATE_PROVIDER, None)
    if rocksdb:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        q = (out.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
        q.awaitTermination()
    finally:
        if rocksdb:
            spark.conf.unset(STATE_PROVIDER) if before is None else spark.conf.set(STATE_PROVIDER, before)
    return spark.read.schema(out.schema).parquet(path)
