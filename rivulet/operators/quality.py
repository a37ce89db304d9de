"""Table constraints re-expressed as data checks returning violating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], nulls_distinct: bool = False) -> DataFrame:
    """Key values present more than once, with their count.

    PRIMARY KEY (default): a null key value repeats like any other.  UNIQUE
    (``nulls_distinct=True``): rows with a null in the key never repeat.
    """
    src = df
    if nulls_distinct:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > 1))


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NOT NULL: rows with a null in any of ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """FOREIGN KEY: child rows whose non-null key has no parent.

    A left-anti join; AQE splits a hot child key across tasks.
    """
    p = parent.select(F.col(parent_key).alias("_pk"))
    return (child.filter(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("_pk"), "left_anti"))


def fk_summary(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """One pass over the child: rows with a non-null key checked, and orphans.

    The parent's distinct keys are hash-partitioned once; the left join reuses
    that partitioning.  AQE splits a hot child key.
    """
    p = parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    c = child.select(F.col(child_key)).filter(F.col(child_key).isNotNull())
    j = c.join(p, F.col(child_key) == F.col("_pk"), "left")
    return j.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("_hit").isNull()).alias("orphans"))


def too_long(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """VARCHAR(n): rows whose text is longer than ``max_len`` characters."""
    return df.filter(F.length(F.col(col)) > max_len)


def violation_counts(df: DataFrame, not_null: Sequence[str] = (),
                     max_lengths: dict[str, int] | None = None) -> DataFrame:
    """All row-local checks counted in one scan (one row)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    aggs += [F.count_if(F.length(F.col(c)) > n).alias(f"too_long_{c}")
             for c, n in (max_lengths or {}).items()]
    return df.agg(*aggs)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` are not unique (an action; only the first duplicate is fetched)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict((k, dup[0][k]) for k in keys)} ({dup[0]['n']} rows)")
