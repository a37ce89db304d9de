"""File sinks.  Executors write their own partitions; the driver only commits.

Row counts for audits come from a Spark ``Observation`` collected during the
write itself, so no table is scanned a second time to count it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivulet.sources.files import VERSION_COLUMN

log = logging.getLogger("rivulet")

# Fixed value: version stamps as 20240131_235959 (``functions.clean.VERSION_FORMAT`` for Spark).
VERSION_STRFTIME = "%Y%m%d_%H%M%S"
# Quotes are doubled, and white space around a value belongs to it (Spark's writer would trim it).
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Audit times are naive UTC wall clock.
AUDIT_SCHEMA = "table_name string, rows long, created_at timestamp_ntz, file_path string"
LOAD_AUDIT_SCHEMA = "table_name string, rows_loaded long, source string, file_path string, loaded_at timestamp_ntz"


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None,
                   fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = (),
                   options: Mapping[str, str] | None = None, dealt: bool = False) -> dict:
    """Write and return ``{"rows": n, **metrics}`` observed during the write
    itself (one pass; each task's update is applied once, retries included).

    A partitioned write is rebalanced by the partition columns first: small partitions end in
    one file each, and a large one is split over tasks by the advisory size, so no task holds a whole hot region.
    ``dealt`` says that the caller has dealt the rows to tasks that way already.
    """
    obs = Observation("write")
    if partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    exprs = [F.count(F.lit(1)).alias("rows")] + [e.alias(k) for k, e in (metrics or {}).items()]
    w = df.observe(obs, *exprs).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return dict(obs.get)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None,
          skip_empty: bool = False, dealt: bool = False) -> int:
    """Write and return the number of rows written (observed during the write).

    ``skip_empty`` leaves the target untouched when the input has no row
    (checked by reading at most one row).
    """
    if skip_empty and df.isEmpty():
        log.warning("no rows for %s: nothing written", path)
        return 0
    return int(write_observed(df, path, None, fmt, mode, partition_by, options, dealt).get("rows", 0))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return write(df, path, "csv", mode, options=CSV_OPTIONS)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return write(df, path, "json", mode)


def write_text(df: DataFrame, path: str, col: str, mode: str = "overwrite") -> int:
    return write(df.select(F.col(col).cast("string").alias("value")), path, "text", mode)


def version_of(ts: _dt.datetime) -> str:
    return ts.strftime(VERSION_STRFTIME)


def write_versioned(df: DataFrame, root: str, stamp: str | _dt.datetime | None = None,
                    fmt: str = "parquet") -> tuple[str, int]:
    """Write a new immutable version ``root/version=<stamp>/`` and return (path, rows).

    Readers pick the newest version (:func:`rivulet.sources.files.read_latest_version`),
    so a version becomes visible only once its folder is complete.  The
    version folder is written in overwrite mode so that a retried job
    replaces the leftovers of a failed attempt of the same version.
    """
    if stamp is None:
        stamp = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(stamp, _dt.datetime):
        stamp = version_of(stamp)
    path = f"{root.rstrip('/')}/{VERSION_COLUMN}={stamp}"
    return path, write(df, path, fmt, "overwrite")


def _one_row(spark: SparkSession, schema: str, values: tuple) -> DataFrame:
    """A one-row frame of literals (planned JVM-side, no Python worker)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    return spark.range(1).select(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(fields, values)])


def _now_utc() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def audit_row(spark: SparkSession, table_name: str, rows: int, file_path: str,
              created_at: _dt.datetime | None = None) -> DataFrame:
    """File audit row (table_name, rows, created_at, file_path); times are UTC wall clock."""
    created = (created_at or _now_utc()).strftime("%Y-%m-%d %H:%M:%S.%f")
    return _one_row(spark, AUDIT_SCHEMA, (table_name, int(rows), created, file_path))


def append_audit(spark: SparkSession, audit_path: str, table_name: str, rows: int,
                 file_path: str, created_at: _dt.datetime | None = None) -> None:
    """Append one audit row (table, rows, created_at, path) to an audit table."""
    write(audit_row(spark, table_name, rows, file_path, created_at), audit_path, "parquet", "append")


def load_audit_row(spark: SparkSession, table_name: str, rows: int, file_path: str, source: str | None = None,
                   loaded_at: _dt.datetime | None = None) -> DataFrame:
    """Load audit row (table_name, rows_loaded, source, file_path, loaded_at); ``source`` may be null."""
    loaded = (loaded_at or _now_utc()).strftime("%Y-%m-%d %H:%M:%S.%f")
    return _one_row(spark, LOAD_AUDIT_SCHEMA, (table_name, int(rows), source, file_path, loaded))


def publish(df: DataFrame, lake_root: str, layer: str, table: str, fmt: str = "parquet",
            partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """Write a table to ``<lake_root>/<layer>/<table>`` (bronze/silver/gold layout)."""
    if layer not in ("bronze", "silver", "gold", "raw", "audit"):
        raise ValueError(f"unknown layer {layer!r}")
    path = f"{lake_root.rstrip('/')}/{layer}/{table}"
    return path, write(df, path, fmt, "overwrite", partition_by)


STREAM_AUDIT_SCHEMA = "table_name string, batch_id long, rows long, created_at timestamp_ntz"


def audited_batches(path: str, audit_path: str, table_name: str, fmt: str = "parquet"):
    """A ``foreachBatch`` function: each micro-batch becomes ``path/batch_id=<n>`` and one audit row, counted during the write.

    A batch that is run again after a failure replaces its own folder and audit row.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        rows = write_observed(batch, f"{path.rstrip('/')}/batch_id={batch_id}", None, fmt)["rows"]
        row = _one_row(batch.sparkSession, STREAM_AUDIT_SCHEMA, (table_name, batch_id, int(rows), _now_utc().strftime("%Y-%m-%d %H:%M:%S.%f")))
        write(row.drop("batch_id"), f"{audit_path.rstrip('/')}/batch_id={batch_id}")
    return put


def write_stream_audited(stream: DataFrame, path: str, audit_path: str, table_name: str, checkpoint: str) -> DataFrame:
    """Run a stream to the end of its present input into ``path`` with an audit row a micro-batch; the audit rows."""
    q = (stream.writeStream.foreachBatch(audited_batches(path, audit_path, table_name))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(STREAM_AUDIT_SCHEMA).parquet(audit_path)
