"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches and are handled in slices of bounded size,
so a worker's memory does not depend on the partition or on the batch setting.
Texts are handed over as UTF-8 ``bytes``: ``bytes.lower`` folds A-Z alone and
``bytes.split`` cuts at the six ASCII white-space characters alone, which is
what the word rules of the operators ask for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import delete_path, own_folder, ship_package

SLICE_BYTES = 4 << 20

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
         "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string())}

#: Bytes of words made of [0-9a-z] and of all non-ASCII characters, A-Z lower-cased; the rest become spaces.
WORD_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
                   for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return text.translate(WORD_TABLE).split() if text else []


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` on executors that have this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``max_bytes`` of text (one row at least)."""
    start = total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
        if total and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def append_columns(df: DataFrame, text_col: str, make: Callable[[], Callable[[list[bytes | None]], list]],
                   fields: list[tuple[str, str]], keep: list[str] | None = None,
                   max_bytes: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from the text, row by row, without a shuffle.

    ``make()`` runs once per task and returns a function from a list of texts
    to one sequence per field.  ``keep`` names the input columns of the result
    (default: all).  An input column named like a result column (in any case)
    gives way to the result.
    """
    taken = {n.lower() for n, _ in fields}
    names = [n for n in (df.columns if keep is None else keep) if n.lower() not in taken]
    # columns pass the Python side under plain names, so that any name of the caller's works
    source = df.select(col(text_col).cast("string").alias("__text"), *[col(n).alias(f"c{k}") for k, n in enumerate(names)])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema.fields[1:]]
                          + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in fields])
    types, out_names = [ARROW[t] for _, t in fields], [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in slices(batch, 0, max_bytes):
                texts = piece.column(0).cast(pa.binary()).to_pylist()
                new = [pa.array(v, type=t) for v, t in zip(work(texts), types)]
                yield pa.RecordBatch.from_arrays(piece.columns[1:] + new, names=out_names)

    return map_batches(source, run, schema).toDF(*names, *[n for n, _ in fields])


def save_and_reread(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Write to the cluster's shared checkpoint folder as Parquet and read it back: cuts lineage, computes once.

    ``by`` names columns that become folders, so that a filter on them reads those folders alone.
    """
    path = f"{own_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._rivulet_path = path
    return saved


def drop_saved(saved: DataFrame) -> None:
    """Delete what :func:`save_and_reread` wrote; no later job may read it."""
    delete_path(saved.sparkSession, saved._rivulet_path)


def crc_part(id_col: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
