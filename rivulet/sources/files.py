"""File sources: CSV, parquet, text, versioned folders, fallbacks, gates."""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.clean import strip_whitespace

log = logging.getLogger("rivulet")

VERSION_COLUMN = "version"


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             multiline: bool = False, **options) -> DataFrame:
    """CSV with a header.  Without a schema every column is read as text
    (cleaning casts with try_cast later).

    Records with too few or too many fields are kept and marked: their text is
    in ``_corrupt_record`` (see :func:`csv_rejects`), which is null for whole
    rows.

    By default files are split between tasks and a record is a line.  A line that leaves a quote open is a
    part of a record that spans lines; it is marked too, with the file's other such lines, never cut to what stands before the
    break.  Pass ``multiline=True`` where quoted fields may span lines: they are read whole, by one task a file, as
    are files in another encoding than UTF-8.
    """
    multiline = multiline or str(options.get("encoding", "UTF-8")).upper() not in ("UTF-8", "UTF8")
    opts = {"header": "true", "escape": '"', "encoding": "UTF-8", "multiLine": str(multiline).lower(), **options}
    if schema is None:
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in spark.read.options(**opts).csv(path).schema])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not multiline:
        return _lines_as_csv(spark, path, schema, opts)
    return spark.read.options(**opts, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(path)


def _lines_as_csv(spark: SparkSession, path: str, schema: T.StructType, opts: dict) -> DataFrame:
    """Each line parsed as a record of its own; blank lines and repetitions of the header line are passed over."""
    lines = spark.read.text(path)
    if opts.pop("header") == "true":
        first = lines.first()  # one line of the first file
        head = "" if first is None else first["value"].removeprefix("\ufeff")
        lines = lines.filter(F.regexp_replace("value", "^\ufeff", "") != F.lit(head))
    quote = opts.get("quote", '"')
    parser = {k: v for k, v in opts.items() if k not in ("encoding", "multiLine")} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    rows = lines.filter(F.trim("value") != "").select("value", F.from_csv("value", ddl, parser).alias("r"), (quotes % 2 == 1).alias("open"))
    cell = lambda f: F.when(~F.col("open"), F.col("r")[f.name]).alias(f.name)
    mark = F.when(F.col("open"), F.col("value")).otherwise(F.col("r")[CORRUPT]).alias(CORRUPT)
    return rows.select(*[mark if f.name == CORRUPT else cell(f) for f in schema.fields])


def csv_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(whole rows without the marker column, rejected rows)`` of :func:`read_csv`."""
    bad = F.col(CORRUPT)
    # the marker is right only where all columns are parsed, so the filter names them all: pruned scans miss bad
    # lines, and Spark refuses a scan of the marker alone
    texts = [F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in df.columns if c != CORRUPT]
    read = F.aggregate(F.array(*texts), F.lit(0), lambda x, y: x + y) >= 0
    return df.filter(bad.isNull() & read).drop(CORRUPT), df.filter(bad.isNotNull() & read)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_lines(spark: SparkSession, path: str, col: str = "line") -> DataFrame:
    """Text lines, stripped, blank lines skipped."""
    t = strip_whitespace(F.col("value"))
    return spark.read.text(path).select(t.alias(col)).filter(F.col(col) != "")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def whole_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file's whole rows, line breaks in quoted fields kept; records of another number of fields are logged, not padded.

    Book descriptions hold line breaks, so a file is read by one task; use
    parquet between the steps where the catalogue is large.
    """
    good, bad = csv_rejects(read_csv(spark, path, multiline=True))
    n = bad.count()
    if n:
        log.warning("%d records of %s have another number of fields: left out", n, path)
    return good


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether there is a data file under the folder."""
    return not file_listing(spark, folder).isEmpty()


def read_first_available(spark: SparkSession, candidates: Sequence[tuple[str, str]]) -> DataFrame:
    """First ``(path, format)`` that exists (e.g. gold parquet, else silver CSV, whose texts are read whole)."""
    for path, fmt in candidates:
        if _exists(spark, path):
            return whole_rows(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    raise FileNotFoundError(f"none of {[p for p, _ in candidates]} exists")


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def latest_version_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest *complete* version under ``root``.

    Lists one directory level (not the files of every version) and skips
    versions without a ``_SUCCESS`` marker, i.e. writes that failed or are
    still running.  Version stamps sort as text.
    """
    fs, p = _fs_and_path(spark, root)
    if not fs.exists(p):
        return None
    prefix = f"{VERSION_COLUMN}="
    dirs = sorted((st.getPath() for st in fs.listStatus(p)
                   if st.isDirectory() and st.getPath().getName().startswith(prefix)),
                  key=lambda q: q.getName(), reverse=True)
    for d in dirs:
        if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d, "_SUCCESS")):
            return d.toString()
    return None


def read_latest_version(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Newest complete version of a versioned table ``root/version=<yyyyMMdd_HHmmss>/``.

    Only that version's folder is read; ``basePath`` keeps ``version`` as a
    column.
    """
    path = latest_version_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.format(fmt).option("basePath", root).load(path)


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Data files under ``folder`` (recursive): (path, bytes, modified); a scan of the files' metadata alone.

    Spark lists the folders (in a job of its own where there are many) and tasks hand out the rows; no content is read and the
    driver is not asked file by file.  Names starting with '_' or '.' (``_temporary``,
    ``_SUCCESS``, checksums) are skipped.  A missing folder has no files.
    """
    if not _exists(spark, folder):
        return spark.createDataFrame([], "path string, bytes long, modified timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def newest_dataset(spark: SparkSession, root: str, fmt: str = "parquet") -> tuple[DataFrame | None, str | None]:
    """``(rows, path)`` of the most recently modified dataset of a folder or object-store prefix.

    A dataset is a folder of part files that belong together (complete when it
    has a ``_SUCCESS`` marker; the root itself may be one), or a single file
    that is no part file.  Its time is that of its newest file, ties go to the
    greater path.  An empty newest dataset is returned as it is, never
    replaced by an older one.  Files are grouped into datasets by tasks; the driver asks for the
    marker of the newest folders only, until it finds a complete one.
    """
    name, folder = F.element_at(F.split("path", "/"), -1), F.regexp_replace("path", "/[^/]*$", "")
    part = name.startswith("part-")
    datasets = (file_listing(spark, root).select("modified", F.when(part, folder).otherwise(F.col("path")).alias("dataset"), part.alias("parts"))
                .groupBy("dataset", "parts").agg(F.max("modified").alias("modified")).orderBy(F.desc("modified"), F.desc("dataset")))
    for r in datasets.toLocalIterator():
        fs, p = _fs_and_path(spark, r["dataset"])
        is_root = p.equals(fs.makeQualified(_fs_and_path(spark, root)[1]))
        if not r["parts"] or is_root or fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
            return spark.read.format(fmt).load(r["dataset"]), r["dataset"]
    return None, None


def read_newest_dataset(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Rows of the most recently modified dataset (max modification time)."""
    df, path = newest_dataset(spark, root, fmt)
    if df is None:
        raise FileNotFoundError(f"no dataset under {root}")
    return df


def is_fresh_path(spark: SparkSession, folder: str, day: _dt.date | str) -> bool:
    """True when the newest data file under ``folder`` was modified on ``day`` (UTC); one row reaches the driver."""
    newest = file_listing(spark, folder).agg(utc_date(F.max("modified")).alias("d"))
    return str(newest.first()["d"]) == str(day)


def is_complete_path(spark: SparkSession, folder: str, min_bytes: int) -> bool:
    """True when ``folder`` holds more than ``min_bytes`` (one call to the file system)."""
    fs, p = _fs_and_path(spark, folder)
    return bool(fs.exists(p)) and int(fs.getContentSummary(p).getLength()) > min_bytes


def file_facts(df: DataFrame) -> DataFrame:
    """Per input file: path, size, modification time, rows (from ``_metadata``)."""
    m = F.col("_metadata")
    return (df.select(m.file_path.alias("file_path"), m.file_size.alias("file_size"),
                      m.file_modification_time.alias("modified_at"))
              .groupBy("file_path", "file_size", "modified_at").agg(F.count(F.lit(1)).alias("rows")))


def utc_date(ts: Column) -> Column:
    """UTC calendar date of a TIMESTAMP, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


def is_fresh(df: DataFrame, day: _dt.date | str | Column) -> bool:
    """True when the newest input file of ``df`` was modified on ``day`` (UTC date).

    Works on any file-based frame but reads ``_metadata`` of every row; for a
    folder, :func:`is_fresh_path` only lists files.
    """
    d = day if isinstance(day, Column) else F.lit(str(day)).cast("date")
    newest = df.select(utc_date(F.max("_metadata.file_modification_time")).alias("d"))
    return bool(newest.select((F.col("d") == d).alias("ok")).first()["ok"])


def is_complete(df: DataFrame, min_rows: int | None = None, min_bytes: int | None = None) -> bool:
    """Completeness gate: enough rows (bounded read) or enough bytes on disk.

    The byte test reads ``_metadata`` of every row; for a folder,
    :func:`is_complete_path` only lists files.
    """
    if min_rows is not None and df.limit(min_rows).count() >= min_rows:
        return True
    if min_bytes is not None:
        size = (df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
                  .dropDuplicates(["p"]).agg(F.sum("s")).first()[0]) or 0
        return size > min_bytes
    return False


FILE_ORDER = "_file_order"


def with_file_order(df: DataFrame, col: str = FILE_ORDER) -> DataFrame:
    """Rows of files with their place: (file, where its split starts, number within the task), which sorts as the files are written.

    Only for a frame read from files (its ``_metadata`` is asked), before any shuffle.  Part files are ordered by path.
    """
    m = F.col("_metadata")
    place = F.struct(m["file_path"].alias("file"), m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("row"))
    return df.withColumn(col, place)
