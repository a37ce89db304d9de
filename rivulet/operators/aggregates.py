"""Grouped aggregates.  All use partial (map-side) aggregation, so a hot key
costs one partial row per map task, never a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.clean import finite, round_half_even


def category_stats(df: DataFrame, category: str, price: str, stock: str, rating: str,
                   names: dict[str, str] | None = None, digits: int = 2) -> DataFrame:
    """Per-category count, mean/min/max price, total stock, mean rating.

    Null categories are dropped (as a dataframe groupby does); null and NaN
    values are skipped by the aggregates; the stock total of a group without
    any is 0.
    ``names`` renames the outputs (keys: category, count, avg_price, min_price,
    max_price, total_stock, avg_rating).
    """
    n = {"category": category, "count": "count", "avg_price": "avg_price", "min_price": "min_price",
         "max_price": "max_price", "total_stock": "total_stock", "avg_rating": "avg_rating",
         **(names or {})}
    price, rating = finite(F.col(price)), finite(F.col(rating))
    return (df.filter(F.col(category).isNotNull())
              .groupBy(F.col(category).alias(n["category"]))
              .agg(F.count(F.lit(1)).alias(n["count"]),
                   round_half_even(F.avg(price), digits).alias(n["avg_price"]),
                   round_half_even(F.min(price), digits).alias(n["min_price"]),
                   round_half_even(F.max(price), digits).alias(n["max_price"]),
                   F.coalesce(F.sum(stock), F.lit(0)).cast("long").alias(n["total_stock"]),
                   round_half_even(F.avg(rating), digits).alias(n["avg_rating"])))


def count_by(df: DataFrame, group: str | Sequence[str], out: str = "n") -> DataFrame:
    """COUNT(*) per group; a null group is kept (SQL semantics)."""
    g = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*g).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    return df.groupBy(group).agg(F.sum(value).alias(out))


def avg_by(df: DataFrame, group: str, value: str, out: str, where: Column | None = None) -> DataFrame:
    src = df if where is None else df.filter(where)
    return src.groupBy(group).agg(F.avg(value).alias(out))


def share_of_total(df: DataFrame, group: str, value: str, out_sum: str = "total",
                   out_share: str = "share", total: str = "window") -> DataFrame:
    """SUM(value) per group and its share of the grand total.

    ``total="window"`` (default, for chart-sized groupings): one scan and one
    partially aggregated shuffle; the grand total is a window over the
    *grouped* rows, so only one row per group reaches the single window
    partition.  ``total="subquery"`` for high-cardinality groupings: the
    grand total is a scalar subquery (a second, fully distributed partial
    aggregation of the grouped sums), so no task ever holds all groups.
    """
    g = df.groupBy(group).agg(F.sum(value).alias(out_sum))
    if total == "subquery":
        grand = g.select(F.sum(out_sum)).scalar()
    else:
        grand = F.sum(out_sum).over(Window.partitionBy())
    return g.withColumn(out_share, F.try_divide(F.col(out_sum), grand))


def totals(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Global aggregates (big numbers): one row."""
    return df.agg(*[e.alias(k) for k, e in exprs.items()])
