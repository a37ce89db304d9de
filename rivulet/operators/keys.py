"""Surrogate keys for a name dimension (SERIAL-like ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import ensure_checkpoint_dir


def dense_ids(df: DataFrame, name_col: str, id_col: str = "id", checkpoint: bool = True) -> DataFrame:
    """Distinct non-null names numbered 1..n in name order.

    Distributed: distinct (shuffle) -> range-partitioned sort -> per-partition
    row counts (one row per partition) -> prefix offsets -> id = offset + index
    within the partition.  No global single-partition window; the only
    broadcast is the offsets table, bounded by the number of partitions.  The
    sorted frame is checkpointed to the session's checkpoint folder so both
    uses read the same rows.
    """
    names = (df.select(F.col(name_col)).filter(F.col(name_col).isNotNull()).distinct()
               .orderBy(name_col)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        names = names.checkpoint(eager=True)
    # monotonically_increasing_id = partition index << 33 | row index in partition
    names = names.withColumn("_idx", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = names.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (names.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
                 .select((F.col("_off") + F.col("_idx") + 1).alias(id_col), F.col(name_col)))


def hashed_ids(df: DataFrame, name_col: str, id_col: str = "id") -> DataFrame:
    """Stable 64-bit ids from the name alone (no ordering, no extra job); two names of one hash fail the job."""
    per_id = (df.select(name_col).filter(F.col(name_col).isNotNull()).distinct()
              .groupBy(F.xxhash64(name_col).alias(id_col)).agg(F.min(name_col).alias(name_col), F.max(name_col).alias("_other")))
    clash = F.concat(F.lit("hash collision: "), F.col(name_col), F.lit(" / "), F.col("_other"))
    return per_id.select(id_col, F.when(F.col(name_col) == F.col("_other"), F.col(name_col)).otherwise(F.raise_error(clash)).alias(name_col))


def extend_ids(existing: DataFrame, df: DataFrame, name_col: str, id_col: str = "id") -> DataFrame:
    """``existing`` (id, name) plus the names it lacks, numbered on from its greatest id in name order.

    Stored ids never change, so foreign keys that point at them stay valid
    across loads, as with a SERIAL column.
    """
    known = existing.select(F.col(name_col).alias("_known"))
    new = df.select(name_col).join(known, F.col(name_col) == F.col("_known"), "left_anti")
    top = F.coalesce(existing.select(F.max(id_col)).scalar(), F.lit(0))
    return existing.select(id_col, name_col).union(
        dense_ids(new, name_col, id_col).select((F.col(id_col) + top).alias(id_col), name_col))
