"""Enrichment joins.

Broadcasts are only used for sides whose size is bounded: either by
construction (one rate row, one row per rate column) or by an explicit,
bounded row check (:func:`broadcast_if_small`).  Everything else is left to
a shuffle join, which AQE may still turn into a broadcast from measured sizes
and whose skewed partitions AQE splits.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.clean import round_half_even

# Default bounds for an explicit broadcast; larger sides are joined by shuffle.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


_FIXED_WIDTH = ((T.BooleanType, 1), (T.ByteType, 1), (T.ShortType, 2), (T.IntegerType, 4), (T.DateType, 4),
                (T.FloatType, 4), (T.LongType, 8), (T.DoubleType, 8), (T.TimestampType, 8),
                (T.TimestampNTZType, 8), (T.DecimalType, 16))


def _row_bytes(df: DataFrame):
    """Per-row size: fixed widths plus the actual bytes of text/binary values
    (nested values counted by their JSON length)."""
    fixed, var = 0, []
    for f in df.schema.fields:
        dt = f.dataType
        width = next((w for t, w in _FIXED_WIDTH if isinstance(dt, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(dt, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            var.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    expr = F.lit(fixed + 8)
    for v in var:
        expr = expr + v
    return expr


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after checking it has at most ``max_rows``
    rows and ``max_bytes`` bytes (fixed widths plus actual text lengths).

    One job over at most ``max_rows + 1`` rows.  It is meant for stored
    dimensions: a side that is itself joined, grouped or sorted is returned
    without a hint (counting it would run its shuffles twice) and is left to
    the adaptive planner, which measures it anyway.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if re.search(r"\b(Join|Aggregate|Distinct|Sort|Window|Repartition\w*|Generate)\b", plan):
        return df
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    if r["n"] <= max_rows and (r["b"] or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   strategy: str = "window") -> DataFrame:
    """Rows holding the greatest ``order_col`` per key; ties are all kept.

    Rows with a null key or a null order value are dropped (as a grouped max
    followed by an inner join would do).

    ``strategy="window"`` (default) plans ``rank() = 1``: Spark inserts a
    partial ``WindowGroupLimit`` before the shuffle, so each map task forwards
    only its local latest rows per key; a hot key costs a few rows per task.
    ``strategy="join"`` is the grouped max joined back on (key, value): use it
    when one key may have a huge number of rows *tied* at its latest value,
    because AQE's skew join then splits that group across tasks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cond = F.col(order_col).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    if strategy == "join":
        src = df.filter(cond)
        latest = src.groupBy(*keys).agg(F.max(order_col).alias(order_col))
        return src.join(latest, [*keys, order_col], "inner").select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return (df.filter(cond)
              .withColumn("_rk", F.rank().over(w))
              .filter(F.col("_rk") == 1)
              .drop("_rk"))


def left_enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                drop_right_key: bool = True, broadcast_max_rows: int | None = None) -> DataFrame:
    """Left outer equi-join with different key names; the right key is dropped.

    Several right rows per key fan out (as a merge does).  ``broadcast_max_rows``
    enables a checked broadcast of the right side.
    """
    r = right
    if broadcast_max_rows is not None:
        r = broadcast_if_small(right, broadcast_max_rows)
    out = left.join(r, left[left_key] == r[right_key], "left")
    return out.drop(r[right_key]) if drop_right_key else out


# Columns of a rate table that are never rates.
NON_RATE_COLUMNS = ("processed_at",)


def rates_first_row(rates: DataFrame, date_col: str = "date") -> DataFrame:
    """The rate row to use: the newest ``date`` (nulls last); among rows of one
    date, or without a date column, the first by all columns' text.  The same
    row whatever the partitioning."""
    text = [F.col(f"`{c}`").cast("string").asc_nulls_last() for c in sorted(rates.columns)]
    newest = [F.col(date_col).desc_nulls_last()] if date_col in rates.columns else []
    return rates.orderBy(*newest, *text).limit(1)


def rates_long(rates_wide: DataFrame, code_col: str = "currency", rate_col: str = "rate") -> DataFrame:
    """First row of a wide rate table -> ``(currency, rate)`` rows.

    Every column whose first-row value reads as a number is a rate (numeric
    columns, or text such as "1.17"); ``base``/``date`` and timestamps are
    skipped.  At most one row per column, so it is safe to broadcast.
    """
    cols = [c for c in rates_wide.columns if c not in NON_RATE_COLUMNS]
    first = rates_first_row(rates_wide).select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = first.unpivot([], cols, code_col, "_text")
    return (long.select(code_col, F.col("_text").try_cast("double").alias(rate_col))
                .filter(F.col(rate_col).isNotNull()))


def rate_lookup(df: DataFrame, code_col: str, rates_wide: DataFrame, out_col: str) -> DataFrame:
    """Map a currency code column to its rate; unknown or null codes give null."""
    lut = rates_long(rates_wide, "_code", out_col)
    return (df.join(F.broadcast(lut), df[code_col] == lut["_code"], "left")
              .drop("_code"))


def first_row_values(rates: DataFrame, cols: Sequence[str]) -> Column:
    """The rate row's values of ``cols`` as one struct-valued scalar subquery.

    Catalyst runs the one-row subquery once and ships the struct with the
    plan: no cross join, no driver round trip while building the plan, and all
    rates come from the same row.
    """
    row = F.struct(*[F.col(c).cast("double").alias(c) for c in cols])
    return rates_first_row(rates).select(row).scalar()


def scalar_enrich(df: DataFrame, rates: DataFrame | None, outputs: dict[str, tuple[str, str]],
                  digits: int | None = None) -> DataFrame:
    """``out = source_col * rates.first()[rate_col]`` for each output.

    ``outputs`` maps an output column to ``(source column, rate column)``.
    Rate columns absent from ``rates`` (or no rates at all) leave the output
    out, as the conditional enrichment does.
    """
    if rates is None:
        return df
    found = {out: pair for out, pair in outputs.items() if pair[1] in rates.columns}
    if not found:
        return df
    row = first_row_values(rates, sorted({rate for _, rate in found.values()}))
    new = {}
    for out, (src, rate) in found.items():
        v = F.col(src) * row[rate]
        new[out] = v if digits is None else round_half_even(v, digits)
    return df.withColumns(new)
