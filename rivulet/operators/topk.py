"""Sorting and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_desc(df: DataFrame, col: str, tie_break: Sequence[str] = (), nulls_first: bool = True) -> DataFrame:
    """ORDER BY col DESC with the SQL-database null placement (nulls first) by default."""
    c = F.col(col)
    key = c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return df.orderBy(key, *[F.col(t).asc() for t in tie_break])


def top_k(df: DataFrame, col: str, k: int, tie_break: Sequence[str] = (), nulls_first: bool = True) -> DataFrame:
    """Top-k rows by ``col`` descending; a tie-break makes the cut deterministic.

    Plans as ``TakeOrderedAndProject``: each task keeps k rows, only those move.
    """
    return order_desc(df, col, tie_break, nulls_first).limit(k)


def top_k_of_group_max(df: DataFrame, group: str, value: str, k: int, out: str | None = None) -> DataFrame:
    """Top-k groups by their MAX(value) (partial aggregation, then a bounded top-k)."""
    out = out or f"max_{value}"
    g = df.groupBy(group).agg(F.max(value).alias(out))
    return top_k(g, out, k, tie_break=[group])
