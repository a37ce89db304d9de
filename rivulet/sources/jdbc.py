"""JDBC source (e.g. a PostgreSQL analytics schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """``SELECT * FROM table`` as a DataFrame; column pruning and simple filters
    are pushed into the database by Spark.  With a numeric ``partition_column``
    and bounds the read is split into ``num_partitions`` parallel range queries.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()
