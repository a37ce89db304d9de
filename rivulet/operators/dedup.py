"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.sources.files import FILE_ORDER, with_file_order


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under an explicit order (deterministic keep-first).

    ``row_number() = 1`` plans a partial ``WindowGroupLimit`` before the shuffle,
    so only each map task's first row per key is shuffled (hot keys included).
    Null keys form their own group, as a plain dropDuplicates does.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


#: About as many rows a task sorts or hashes at once; a split of a well compressed file may hold many times as many.
ROWS_PER_TASK = 500_000


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def dedup_first_spread(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], place: Column, rows: int) -> DataFrame:
    """:func:`dedup_first` of ``rows`` rows, with about ``ROWS_PER_TASK`` of them in a task, however they were read.

    Up to that many rows it is the same.  More are dealt to tasks by a hash of ``place``, which tells rows
    apart; each task keeps its first row per key, so a key that most rows share is spread like
    any other, and those rows are then dealt by key.
    """
    n = tasks_for(rows)
    if n == 1:
        return dedup_first(df, keys, order)
    # more groups than tasks, so that the tasks get about the same number of them
    dealt = df.withColumn("_group", F.pmod(F.xxhash64(place), F.lit(64 * n))).repartition(n, "_group")
    some = dedup_first(dealt, [*keys, "_group"], order).drop("_group")
    return dedup_first(some.repartition(n, *keys), keys, order)


def dedup_file_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the first row per key in the order of the files it was read from (as a reader of one file would).

    ``df`` reads files and has not been shuffled; see :func:`rivulet.sources.files.with_file_order`.  The rows are
    counted first (for Parquet in the files' footers), so that the number of tasks follows them.
    """
    return dedup_first_spread(with_file_order(df), keys, [FILE_ORDER], F.col(FILE_ORDER), df.count()).drop(FILE_ORDER)


def first_in_file_order(df: DataFrame) -> DataFrame:
    """The first row of the files read, one partial aggregate."""
    placed = with_file_order(df)
    row = placed.agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), FILE_ORDER).alias("r"))
    return row.filter("r is not null").select("r.*")


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one arbitrary row per key (cheapest: partial aggregation)."""
    return df.dropDuplicates(list(keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
