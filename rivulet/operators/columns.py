"""Projection helpers: ordered / tolerant selection, renames, typed constants."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order (missing ones skipped)."""
    have = set(df.columns)
    return df.select([c for c in wanted if c in have])


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; keys that are not columns are ignored."""
    have = set(df.columns)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in have and k != v})


def with_typed_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add typed null columns (``{'name': 'double'}``) unless they already exist."""
    add = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(add) if add else df
