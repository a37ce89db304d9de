"""End-to-end steps with their reads and writes (bronze -> silver -> gold -> load).

Each step is one lazy plan materialised once by its sink; row counts come
from the write itself.  Optional sources (rates, population) that are absent
are passed as ``None`` and the plans add typed null columns.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.plans.books import books_silver, gold_books_analytics, gold_books_details, typed_books_silver
from rivulet.plans.countries import countries_silver, gold_countries_enriched
from rivulet.plans.silver import population_silver, rates_silver, wine_silver
from rivulet.sinks.files import CSV_OPTIONS, append_audit, write, write_observed, write_versioned
from rivulet.sinks.jdbc import load_plan
from rivulet.sources.files import FILE_ORDER, _exists, read_first_available, whole_rows, with_file_order


log = logging.getLogger("rivulet")


def optional_parquet(spark: SparkSession, path: str | None) -> DataFrame | None:
    return spark.read.parquet(path) if path and _exists(spark, path) else None


def first_by(raw: DataFrame, order_by: list[str] | None) -> tuple[DataFrame, list[str]]:
    """The frame and the columns that say which row comes first: those given, or the place in the files."""
    return (raw, order_by) if order_by else (with_file_order(raw), [FILE_ORDER])


def books_silver_step(spark: SparkSession, raw_csv: str, out_path: str, rates_path: str | None = None,
                      fmt: str = "csv") -> int:
    """Raw scraped CSV -> cleaned silver.  ``fmt="parquet"`` is the better
    choice at scale (splittable, typed, column-pruned); CSV mirrors the
    reference's silver file."""
    silver = books_silver(whole_rows(spark, raw_csv), optional_parquet(spark, rates_path))
    opts = CSV_OPTIONS if fmt == "csv" else None
    m = write_observed(silver, out_path, {"null_titles": F.count_if(F.col("titre").isNull())}, fmt, options=opts)
    if m["null_titles"]:
        log.warning("%d of %d books have no title", m["null_titles"], m["rows"])
    return int(m["rows"])


def countries_silver_step(spark: SparkSession, raw_path: str, out_path: str, order_by: list[str] | None = None, as_of=None) -> int:
    """The first of an iso3's duplicates stays: by the columns of ``order_by``, else as the raw files hold them."""
    raw, order = first_by(spark.read.parquet(raw_path), order_by)
    return write(countries_silver(raw, as_of, order).drop(FILE_ORDER), out_path, partition_by=["region"], skip_empty=True)


def population_silver_step(spark: SparkSession, raw_path: str, silver_root: str, audit_root: str,
                           stamp: str | _dt.datetime | None = None, as_of=None) -> tuple[str | None, int]:
    """Clean, write a new version, append an audit row (table, rows, created_at, path).

    An empty cleaned batch writes nothing (no empty version hides the last
    good one) and returns ``(None, 0)``.
    """
    silver = population_silver(spark.read.parquet(raw_path), as_of)
    if silver.isEmpty():
        log.warning("population batch %s has no valid rows: nothing written", raw_path)
        return None, 0
    path, rows = write_versioned(silver, silver_root, stamp)
    append_audit(spark, audit_root, "population_silver", rows, path)
    return path, rows


def rates_silver_step(spark: SparkSession, raw_path: str, out_path: str, as_of=None) -> int:
    return write(rates_silver(spark.read.parquet(raw_path), as_of), out_path, skip_empty=True)


def wine_silver_step(spark: SparkSession, raw_path: str, out_path: str, order_by: list[str] | None = None, as_of=None) -> int:
    """The first of a title's duplicates stays: by the columns of ``order_by``, else as the raw files hold them."""
    raw, order = first_by(spark.read.parquet(raw_path), order_by)
    return write(wine_silver(raw, as_of, order).drop(FILE_ORDER), out_path, partition_by=["country"])


def gold_books_step(spark: SparkSession, silver_path: str, gold_root: str, rates_path: str | None = None,
                    as_of=None, fmt: str = "csv") -> dict[str, int]:
    silver = (typed_books_silver(whole_rows(spark, silver_path)) if fmt == "csv"
              else spark.read.format(fmt).load(silver_path))
    rates = optional_parquet(spark, rates_path)
    root = gold_root.rstrip("/")
    return {
        "books_details": write(gold_books_details(silver, rates, as_of), f"{root}/books_details"),
        "books_analytics": write(gold_books_analytics(silver, rates, as_of), f"{root}/books_analytics"),
    }


def gold_countries_step(spark: SparkSession, countries_path: str, gold_root: str,
                        population_path: str | None = None, rates_path: str | None = None, as_of=None) -> int:
    df = gold_countries_enriched(spark.read.parquet(countries_path), optional_parquet(spark, population_path),
                                 optional_parquet(spark, rates_path), as_of)
    return write(df, f"{gold_root.rstrip('/')}/countries_enriched")


def gold_tables(spark: SparkSession, gold_root: str, silver_books_csv: str | None = None) -> dict[str, DataFrame | None]:
    """The gold tables to load; book details fall back to the silver CSV where the gold table is missing."""
    root = gold_root.rstrip("/")
    tables = {name: optional_parquet(spark, f"{root}/{name}")
              for name in ("books_details", "books_analytics", "countries_enriched")}
    if tables["books_details"] is None and silver_books_csv and _exists(spark, silver_books_csv):
        tables["books_details"] = typed_books_silver(read_first_available(
            spark, [(f"{root}/books_details", "parquet"), (silver_books_csv, "csv")]))
    return tables


def load_gold_step(spark: SparkSession, gold_root: str, url: str, properties: dict | None = None,
                   schema: str = "analytics", silver_books_csv: str | None = None) -> list[str]:
    """Replace the gold tables in the database (empty or missing tables skipped)."""
    tables = gold_tables(spark, gold_root, silver_books_csv)
    return load_plan({f"gold_{k}": v for k, v in tables.items() if v is not None}, url, schema, properties)
