"""Upsert (INSERT ... ON CONFLICT DO UPDATE) as a pure DataFrame rewrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str]) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``keys``.

    - key only in target: target row unchanged;
    - key only in updates: the update row is inserted;
    - key in both: ``update_cols`` take the update's values (even null), all
      other columns keep the target's values.

    One full outer join on the keys (both sides hash-partitioned once).  Keys
    are unique per side (see :func:`rivulet.operators.quality.assert_unique`),
    so no key can be hot.  The result has the target's columns and order.  As
    the database would, a batch column that the target lacks is refused, and
    so is a null key (a row with one fails the job when it is read).
    """
    keys = list(keys)
    upd = set(update_cols)
    unknown = [c for c in [*updates.columns, *update_cols, *keys] if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {unknown}")
    for k in keys:
        updates = updates.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k} in the batch")))
                                     .otherwise(F.col(k)))
    t = target.withColumn("_in_t", F.lit(True))
    u = updates.select(*[F.col(c).alias(f"_u_{c}") for c in updates.columns]).withColumn("_in_u", F.lit(True))
    cond = None
    for k in keys:
        c = t[k] == u[f"_u_{k}"]
        cond = c if cond is None else cond & c
    j = t.join(u, cond, "full_outer")
    in_t = F.col("_in_t").isNotNull()
    in_u = F.col("_in_u").isNotNull()
    out = []
    for c in target.columns:
        uc = f"_u_{c}" if c in updates.columns else None
        if c in keys:
            e = F.coalesce(F.col(c), F.col(uc))
        elif uc is None:
            e = F.col(c)
        elif c in upd:
            e = F.when(in_u, F.col(uc)).otherwise(F.col(c))
        else:
            e = F.when(in_t, F.col(c)).otherwise(F.col(uc))
        out.append(e.alias(c))
    return j.select(*out)


def append(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Union-all by column name (audit append); a missing table is just ``rows``."""
    return rows if existing is None else existing.unionByName(rows, allowMissingColumns=True)
