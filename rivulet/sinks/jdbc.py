"""JDBC sinks: schema, table replace, append (audit), batched inserts from executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.sinks.files import load_audit_row

# --- fixed value: name of the load audit table -----------------------------
LOAD_AUDIT_TABLE = "audit_postgres"


def ensure_schema(spark: SparkSession, url: str, schema: str, properties: dict | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` over one driver-side connection (metadata only, no rows)."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        info.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.createStatement().execute('CREATE SCHEMA IF NOT EXISTS "' + schema.replace('"', '""') + '"')
    finally:
        connection.close()


def write_table(df: DataFrame, url: str, table: str, mode: str = "overwrite",
                properties: dict | None = None, batch_size: int = 10_000,
                num_partitions: int | None = None) -> None:
    """Replace (or append to) a database table.  Each executor task inserts its
    partition in batches; ``num_partitions`` caps concurrent connections with a
    repartition (a coalesce would also shrink the upstream stage's parallelism)."""
    out = df.repartition(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
           .option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def append_load_audit(spark: SparkSession, url: str, table_name: str, rows: int, file_path: str, source: str,
                      properties: dict | None = None) -> None:
    """Append the load audit row (table, rows, source, path, time) to the database's audit table, created if missing."""
    write_table(load_audit_row(spark, table_name, rows, file_path, source), url, LOAD_AUDIT_TABLE, "append", properties)


def load_plan(tables: dict[str, DataFrame], url: str, schema: str = "analytics",
              properties: dict | None = None) -> list[str]:
    """Load several gold tables (``{name: frame}``) into ``schema`` (created if missing), skipping empty ones."""
    loaded = []
    for name, df in tables.items():
        if df is None or df.isEmpty():
            continue
        if not loaded:
            ensure_schema(df.sparkSession, url, schema, properties)
        write_table(df, url, f"{schema}.{name}", "overwrite", properties)
        loaded.append(name)
    return loaded
