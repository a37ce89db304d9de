"""Spark session helpers.

The library never relies on a session it did not get from the caller, except
for tests and the benchmark, which build one with :func:`local_session`.
"""

from __future__ import annotations

import atexit
import io
import logging
import os
import shutil
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

log = logging.getLogger("rivulet")

# Settings the operators are written against.  ANSI stays on (Spark 4 default):
# text -> number goes through try_cast, division through try_divide.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcasts are decided by the operators after a size check; keep the
    # planner's own threshold conservative.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("RIVULET_DRIVER_MEM", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a local-mode session without it (tests) gets a scratch folder;
    a cluster session without it is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. hdfs:// or s3a://)")
    path = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path


def own_folder(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder, for tables between steps; deleted when the driver's process ends."""
    context = spark.sparkContext
    folder = getattr(context, "_rivulet_folder", None)
    if folder is None:
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivulet/{context.applicationId}-{uuid.uuid4().hex}"
        atexit.register(_delete, context._jvm, context._jsc.hadoopConfiguration(), folder)
        context._rivulet_folder = folder
    return folder


def _delete(jvm, conf, path: str) -> None:
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    except (Py4JError, OSError) as e:  # the JVM may have ended before the driver's Python
        log.warning("%s was not deleted: %s", path, e)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system; a missing one is no error."""
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per context, as ``--py-files`` would.

    The archive goes through the shared checkpoint folder, so a task on any
    machine can import the operators however the driver came to know them.
    """
    context = spark.sparkContext
    if getattr(context, "_rivulet_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = f"{own_folder(spark)}/code-{uuid.uuid4().hex}/rivulet.zip"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(data.getvalue())
    out.close()
    context.addPyFile(path)
    context._rivulet_shipped = True


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 ** 2,
               broadcast_bytes: int = 64 * 1024 ** 2) -> dict[str, str]:
    """Session settings sized for an input volume (e.g. 100 TB on a large cluster).

    - scans split into ``partition_bytes`` pieces; shuffles start with about
      one partition per ``partition_bytes`` of input (AQE then coalesces small
      ones and splits skewed ones), so a task's data fits executor memory and
      spills rather than failing;
    - broadcasts chosen by the planner stay below ``broadcast_bytes``;
    - skewed partitions (5x the median and above the advisory size) are split.
    """
    shuffle_partitions = max(200, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
