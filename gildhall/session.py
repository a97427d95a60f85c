"""Session construction and the shared checkpoint folder.

Operators never create sessions; they take DataFrames. This module is for
tests, the bench and the demo entry point.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (so a
# dimension is broadcast only when its measured size is under the threshold),
# coalesces small shuffle partitions and splits skewed sort-merge partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2560k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Largest side, in bytes of its files as Spark estimates them, that is broadcast before any of it has run.
ESTIMATED_BROADCAST = 256 << 10
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
MEASURED_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"

# Shuffle files are deleted when the statement that made them ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "gildhall", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset in a local session (tests) a scratch
    folder is created and registered; on a cluster that is an error, since
    no executor could read a folder of the driver's.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="gildhall-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``256k``, ``10MB``, ``10485760b``, ``-1``."""
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".find(unit) if unit in tuple("kmgtp") else int(number)


def measured_broadcasts(spark: SparkSession) -> None:
    """Let ``spark`` broadcast by measured size; by file size only what stays small whatever the files hide.

    Before a side has run Spark takes its size from the files: compressed, and a column's share of them by its
    type. Sorted keys beside empty columns take a few hundredths of the room of their rows, so sides of millions of
    rows pass the threshold and are gathered on the driver. That estimate is therefore held to
    ``ESTIMATED_BROADCAST``. Sides that AQE has measured are held to a quarter of the session's threshold: in the driver
    a relation takes up to four times the bytes of its rows, and a plan has many. A session that broadcasts less
    stays as it is, and so does a threshold for measured sides that the session sets itself.
    """
    limit = spark.conf.get(BROADCAST)
    if _bytes(limit) > ESTIMATED_BROADCAST:
        if spark.conf.get(MEASURED_BROADCAST, None) is None:
            spark.conf.set(MEASURED_BROADCAST, str(max(_bytes(limit) // 4, ESTIMATED_BROADCAST)))
        spark.conf.set(BROADCAST, str(ESTIMATED_BROADCAST))


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the statements run inside go when each of them ends."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as Parquet below the shared checkpoint folder and read back.

    Like an eager checkpoint it fixes the rows and cuts the lineage, but the
    files are compressed, a reader takes only the columns it uses, and the
    size is known when the next query is planned: a small table is broadcast
    instead of sending the other side to a few hot keys. The shuffle files of
    the write go when it ends, so a chain of stored tables needs the disk of
    its largest step, not of all of them.
    """
    spark = df.sparkSession
    measured_broadcasts(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
