"""Row filters and label matchers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, col: str) -> Column:
    """Not null, and not NaN where the column is a fraction."""
    c = F.col(col)
    fraction = df.schema[col].dataType.simpleString() in ("double", "float")
    return c.isNotNull() & ~F.isnan(c) if fraction else c.isNotNull()


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows with a value in every column; NaN is no value."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & present(df, c)
    return df.filter(cond)


def positive(df: DataFrame, col: str) -> DataFrame:
    """``col > 0``; NaN is excluded (Spark orders NaN above every number)."""
    c = F.col(col)
    return df.filter((c > 0) & ~F.isnan(c.cast("double")))


def label_match(value: Column, op: str, operand: str) -> Column:
    """Label matcher: ``=``, ``!=``, ``=~``, ``!~``.

    Regexes are fully anchored and a missing label counts as the empty string,
    as in the metric query language the dashboards use.
    """
    v = F.coalesce(value, F.lit(""))
    if op == "=":
        return v == F.lit(operand)
    if op == "!=":
        return v != F.lit(operand)
    anchored = f"^(?:{operand})$"
    if op == "=~":
        return v.rlike(anchored)
    if op == "!~":
        return ~v.rlike(anchored)
    raise ValueError(f"unknown matcher {op!r}")


def match_labels(df: DataFrame, matchers: Iterable[tuple[str, str, str]],
                 labels_col: str = "labels") -> DataFrame:
    """Filter a metric table on ``(label, op, value)`` matchers over a labels map."""
    cond = F.lit(True)
    for name, op, operand in matchers:
        cond = cond & label_match(F.col(labels_col).getItem(name), op, operand)
    return df.filter(cond)


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard before a write (reads at most one row)."""
    return df.isEmpty()
