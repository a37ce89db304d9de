"""Silver cleaning of population, exchange-rate and wine tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.clean import (
    concat_year_month, processing_time, safe_ratio, strip_whitespace, to_number,
)
from rivulet.operators.dedup import dedup_any, dedup_first
from rivulet.operators.filters import not_null, positive


def population_silver(raw: DataFrame, as_of=None) -> DataFrame:
    """Distinct rows with population > 0 (NaN excluded), typed, + year_month 'YYYY-01'."""
    df = positive(raw.distinct(), "population")
    return df.withColumns({
        "year": F.col("year").try_cast("int"),
        "population": F.col("population").cast("double"),
    }).withColumns({
        "ingestion_timestamp": processing_time(as_of),
        "year_month": concat_year_month("year"),
    })


def rates_silver(raw: DataFrame, as_of=None) -> DataFrame:
    return raw.withColumn("processed_at", processing_time(as_of))


def wine_silver(raw: DataFrame, as_of=None, order_by: list[Column | str] | None = None) -> DataFrame:
    """One row per title; price/points numeric; rows without price or country
    dropped; country/variety stripped; price per point (null for 0 points)."""
    df = dedup_first(raw, ["title"], order_by) if order_by else dedup_any(raw, ["title"])
    df = df.withColumns({"price": to_number("price"), "points": to_number("points")})
    df = not_null(df, "price", "country")
    return df.withColumns({
        "country": strip_whitespace("country"),
        "variety": strip_whitespace("variety"),
        "price_per_point": safe_ratio("price", "points"),
        "processed_at": processing_time(as_of),
    })
