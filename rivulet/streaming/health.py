"""Live health of jobs: absence is told by timers, not by samples.

Each job is a key with typed state (a map of the newest sample of each instance
and step, and the next step to tell) and one event-time timer at that step.  When the
watermark has passed a step, all its samples are in, so the timer tells the job's
sum and status, ``Offline`` where nothing came, and moves on to the next
step; it keeps firing while the watermark rises, whether or not the job still reports.  Jobs that never
report are seeded from the list of known jobs as initial state.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.metrics import epoch_micros, health_of, ntz_from_micros
from rivulet.session import ship_package
from rivulet.streaming.rate import shifted


COLUMNS = ["job", "instance", "shifted_time", "_us", "_tb", "_up"]


class Health(StatefulProcessor):
    """State of one job; ``first`` is the first step told (microseconds), ``step`` their distance."""

    def __init__(self, step: int, first: int):
        self.step, self.first = step, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getMapState("newest", "instance string, step long", "us long, tb long, up double")
        self.due = handle.getValueState("due", "step long")

    def begin(self) -> None:
        if not self.due.exists():
            self.due.update((self.first,))
            self.handle.registerTimer(self.first // 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.begin()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.begin()
        told = self.due.get()[0]
        # beside an initial state the columns come without their names, in order
        parts = [pdf.set_axis(COLUMNS[-pdf.shape[1]:], axis=1) for pdf in rows if len(pdf)]
        if parts:
            x = pd.concat(parts)
            x["_step"] = -(-x["_us"] // self.step) * self.step
            x = x[x["_step"] >= told].sort_values(["_us", "_tb"]).groupby(["instance", "_step"], sort=False).tail(1)
            for instance, step, us, tb, up in zip(x["instance"], x["_step"], x["_us"], x["_tb"], x["_up"]):
                at = (str(instance), int(step))
                old = self.newest.getValue(at) if self.newest.containsKey(at) else None
                if old is None or (us, tb) > (old[0], old[1]):
                    self.newest.updateValue(at, (int(us), int(tb), float(up)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        step = self.due.get()[0]
        sums: dict[int, float] = {}
        for at, (_, _, up) in list(self.newest.iterator()):
            if at[1] <= watermark:
                if not np.isnan(up):
                    sums[at[1]] = sums.get(at[1], 0.0) + up
                self.newest.removeKey(at)
        steps = list(range(step, watermark + 1, self.step))
        following = step + len(steps) * self.step
        self.due.update((following,))
        self.handle.registerTimer(following // 1000)
        yield pd.DataFrame({"job": [key[0]] * len(steps), "_step": np.array(steps, np.int64), "_sum": [sums.get(s) for s in steps]},
                           columns=["job", "_step", "_sum"]).astype({"_sum": "float64"})

    def close(self) -> None:
        pass


def health_stream(stream: DataFrame, jobs: DataFrame, job: str, instance: str, ts: str, value: str, tiebreak: str, step_seconds: int,
                  watermark: str, start: _dt.datetime) -> DataFrame:
    """(step, job, up, status) for every step from the first at or behind ``start``, for every job seen or listed in ``jobs``; append mode.

    ``up`` sums the newest sample of each instance in ``(step - step_seconds, step]``; without one it is null and the
    status ``Offline``.  A step is told once the watermark has reached it.  Needs the RocksDB state store
    (``run_available_now(..., rocksdb=True)``).  Null values add nothing; a null job or instance is the empty label.
    """
    spark = stream.sparkSession
    ship_package(spark)
    step = step_seconds * 1_000_000
    micros = int((start.replace(tzinfo=None) - _dt.datetime(1970, 1, 1)) / _dt.timedelta(microseconds=1))
    first = -(-micros // step) * step
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    samples = shifted(stream, ts, watermark).select(
        text(job).alias("job"), text(instance).alias("instance"), "shifted_time", epoch_micros(stream, ts).alias("_us"),
        F.col(tiebreak).cast("long").alias("_tb"), F.col(value).cast("double").alias("_up"))
    known = jobs.select(text(job).alias("job")).distinct().groupBy("job")
    told = samples.groupBy("job").transformWithStateInPandas(
        statefulProcessor=Health(step, first), outputStructType="job string, _step long, _sum double", outputMode="Append",
        timeMode="EventTime", initialState=known)
    up = F.when(~F.isnan("_sum"), F.col("_sum")).cast("bigint")
    return told.select(ntz_from_micros(F.col("_step")).alias("step"), F.col("job").alias(job), up.alias("up"), health_of(up).alias("status"))
