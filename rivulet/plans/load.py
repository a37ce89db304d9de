"""Load step: upsert a batch into a versioned table, with audit rows."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.dedup import dedup_first_spread, tasks_for
from rivulet.operators.upsert import upsert
from rivulet.session import delete_path
from rivulet.sinks.files import LOAD_AUDIT_SCHEMA, load_audit_row, write, write_versioned
from rivulet.sources.files import _exists, has_files, latest_version_path, newest_dataset, read_latest_version

# --- fixed values: key and updated columns of the population table --------
POPULATION_KEYS = ("country_iso2", "year")
POPULATION_UPDATE_COLUMNS = ("population", "ingestion_timestamp")
# ---------------------------------------------------------------------------


def batch_size_checked(batch: DataFrame, keys) -> int:
    """Rows of an upsert batch, refusing null and duplicate keys - one aggregation job."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    r = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.max("_n").alias("dup"),
                    F.count_if(some_null).alias("nulls")).first()
    if r["nulls"]:
        raise ValueError(f"null key in the batch on {list(keys)}")
    if r["dup"] is not None and r["dup"] > 1:
        raise ValueError(f"duplicate key in the batch ({r['dup']} rows share a key on {list(keys)})")
    return int(r["rows"])


def upsert_versioned(spark: SparkSession, batch: DataFrame, table_root: str, audit_root: str,
                     table_name: str, keys=POPULATION_KEYS, update_cols=POPULATION_UPDATE_COLUMNS,
                     source: str = "local", stamp: str | _dt.datetime | None = None,
                     source_path: str | None = None) -> tuple[str, int]:
    """For small tables (see :func:`upsert_partitions` for large ones): merge ``batch`` into the newest version of ``table_root`` and publish the
    result as a new version, then append a load audit row
    (table_name, rows_loaded = batch rows, source, file_path = ``source_path``
    of the batch, loaded_at).  Returns (new version path, rows in the table).

    Duplicate keys in the batch are refused (as a primary key would).  The new
    version is a complete table written next to the old ones, so readers never
    see a half-merged state; it also cuts the lineage for the next merge.  A
    table folder without a complete version (a first load that failed) is
    loaded as a new table.
    """
    # staged once: the check and the merge read the same rows
    staging = f"{table_root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    write(batch, staging)
    batch = spark.read.schema(batch.schema).parquet(staging)
    loaded = batch_size_checked(batch, list(keys))
    if latest_version_path(spark, table_root) is not None:
        current = read_latest_version(spark, table_root).drop("version")
        merged = upsert(current, batch, keys, update_cols)
    else:
        merged = batch
    path, rows = write_versioned(merged, table_root, stamp)
    write(load_audit_row(spark, table_name, loaded, source_path or path, source), audit_root, mode="append")
    delete_path(spark, staging)
    return path, rows


def load_newest(spark: SparkSession, source_root: str, table_root: str, audit_root: str, table_name: str,
                keys=POPULATION_KEYS, update_cols=POPULATION_UPDATE_COLUMNS, source: str = "local",
                stamp: str | _dt.datetime | None = None, fmt: str = "parquet") -> tuple[str, int]:
    """The load step: newest dataset under ``source_root`` -> upsert -> audit row.

    ``source`` names where the files lie (a local folder or an object store);
    the path's scheme picks the file system.  An empty newest dataset is
    refused, not replaced by an older one.
    """
    batch, path = newest_dataset(spark, source_root, fmt)
    if batch is None:
        raise FileNotFoundError(f"no dataset under {source_root}")
    if batch.isEmpty():  # reads one row at most
        raise ValueError(f"the newest dataset {path} has no rows")
    return upsert_versioned(spark, batch, table_root, audit_root, table_name, keys, update_cols, source, stamp, path)


# --- tables partitioned by a hash of the key: a load rewrites the partitions it touches -------

PART = "key_part"


def _partitions(spark: SparkSession, root: str) -> int | None:
    """How many key partitions the table has: the number in its partition column's name."""
    if not _exists(spark, root):
        return None
    names = [f.name for f in spark.read.parquet(root).schema if f.name.startswith(f"{PART}_of_")] if has_files(spark, root) else []
    return int(names[0].rsplit("_", 1)[1]) if names else None


def read_partitions(spark: SparkSession, root: str) -> DataFrame:
    """The table without its partition column."""
    df = spark.read.parquet(root)
    return df.drop(*[c for c in df.columns if c.startswith(f"{PART}_of_")])


def upsert_partitions(spark: SparkSession, batch: DataFrame, root: str, keys: Sequence[str], update_cols: Sequence[str], staging: str,
                      parts: int = 64, audit_root: str | None = None, table_name: str = "", source: str = "local",
                      source_path: str | None = None) -> list[int]:
    """Merge ``batch`` into the table at ``root`` and return the key partitions that were written again.

    The table is a Parquet folder partitioned by a hash of the key.  The batch is evaluated once, into the folder ``staging``
    (of this load alone); null and duplicate keys and unknown columns are refused before the table is touched.
    Rows of the touched partitions are read (partition pruning), merged, and written back with
    dynamic partition overwrite: new files are made aside and take the partitions' place when
    all tasks are done, so a load that fails leaves the table as it was, and the files of other
    partitions are not touched.  ``parts`` is fixed by the first load.  An empty batch writes nothing.
    """
    keys = list(keys)
    n = _partitions(spark, root) or parts
    column = f"{PART}_of_{n}"
    part = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    rows = write(batch.withColumn(column, part), staging)
    staged = spark.read.parquet(staging)
    # dealt by key before grouping: the split of a well compressed file may hold any number of rows
    batch_size_checked(staged.repartition(tasks_for(rows), *keys), keys)
    touched = sorted(r[0] for r in staged.select(column).distinct().collect())  # ``parts`` at most
    total = rows
    if _partitions(spark, root) is None:
        merged = staged
    else:
        current = spark.read.parquet(root).filter(F.col(column).isin(touched))
        total += current.count()  # from the files' footers
        merged = upsert(current.drop(column).repartition(tasks_for(total), *keys), staged.drop(column), keys, update_cols).withColumn(column, part)
    if touched:
        # a task writes about one piece of one partition, and a partition has more pieces the more rows there are
        pieces = -(-tasks_for(total) // len(touched))
        piece = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(pieces))
        write(merged.repartition(len(touched) * pieces, column, piece), root, partition_by=[column], options={"partitionOverwriteMode": "dynamic"}, dealt=True)
    if audit_root:
        write(load_audit_row(spark, table_name, rows, source_path or staging, source), audit_root, mode="append")
    delete_path(spark, staging)
    return touched


def load_incremental(spark: SparkSession, source_root: str, schema: T.StructType | str, table_root: str, audit_root: str, checkpoint: str,
                     table_name: str, keys: Sequence[str], update_cols: Sequence[str], parts: int = 64, files_per_batch: int = 1000,
                     fmt: str = "parquet") -> DataFrame:
    """Load every file under ``source_root`` that no earlier call has loaded, then stop; the audit rows (one a batch) are returned.

    A file-source stream remembers in ``checkpoint`` which files are done.  Each micro-batch is merged by
    :func:`upsert_partitions`; of rows that share a key the one in the newest file counts (by
    modification time, then path and place).  Merging a batch again changes nothing, and its audit row
    replaces itself, so a batch that is repeated after a failure counts once.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        staging = f"{checkpoint.rstrip('/')}-staging/batch_id={batch_id}"
        # the batch is read once, into a table of numbered rows; a micro-batch's own session plans without adaptive
        # execution, so the caller's session goes on from there
        rows = write(batch.withColumn("_row", F.monotonically_increasing_id()), f"{staging}-rows")
        numbered = spark.read.parquet(f"{staging}-rows")
        order = [F.desc("_modified"), F.desc("_file"), F.desc("_row")]
        last = dedup_first_spread(numbered, keys, order, F.col("_row"), rows).drop("_modified", "_file", "_row")
        upsert_partitions(spark, last, table_root, keys, update_cols, staging, parts)
        delete_path(spark, f"{staging}-rows")
        row = load_audit_row(spark, table_name, rows, source_root, f"batch {batch_id}")
        write(row, f"{audit_root.rstrip('/')}/batch_id={batch_id}")

    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(source_root)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("_modified"), F.col("_metadata.file_path").alias("_file"))
    q = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if not _exists(spark, audit_root):
        return spark.createDataFrame([], f"{LOAD_AUDIT_SCHEMA}, batch_id int")
    return spark.read.schema(f"{LOAD_AUDIT_SCHEMA}, batch_id int").parquet(audit_root)
