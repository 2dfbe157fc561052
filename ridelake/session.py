"""Session settings, the shared work folder and shuffle sizing."""

from __future__ import annotations

import logging
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

MIB = 1024 * 1024
# What Spark takes for the size of rows it knows nothing about is of this order (2 to the power of 63).
UNKNOWN_BYTES = 2**62

# Parquet grows to about this many times its size as rows; a shuffle partition is sized by the latter.
DECODED_TIMES = 4
DECODED_BYTES_PER_PARTITION = 1024 * MIB

# A distinct keeps the rows of its split in a table, where they may take thirty times their Parquet size, so splits are
# small. They grow to the usual one beyond ``FEW_SCAN_TASKS`` and beyond it where there would be too many to schedule.
SMALLEST_SPLIT, USUAL_SPLIT, LARGEST_SPLIT = 8 * MIB, 32 * MIB, 1024 * MIB
FEW_SCAN_TASKS, MAX_SCAN_TASKS = 2_000, 200_000

# Shuffles start with a partition for each so many bytes while there are few: small inputs must not spill either, and AQE
# merges what is too small.
FINE_BYTES, FINE_PARTITIONS = 8 * MIB, 2000

# What a write task is given, and hence the size of a file: larger when there would be very many.
SMALLEST_WRITE, LARGEST_WRITE = 128 * MIB, 1024 * MIB
FILES_WANTED = 100_000

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Up to so many folders of a partitioned write a task keeps a file open in each instead of sorting its rows first.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "32"}
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "ridelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Epoch seconds and calendar parts of zone-less timestamps must not depend on the host."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir`` or has set as checkpoint folder.
    There is no default: a folder that only one machine sees would lose data on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{checkpoint_root(spark)}/ridelake-{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table made at a ``work_path``."""
    if not path.startswith(f"{checkpoint_root(spark)}/ridelake-"):
        raise ValueError(f"not an intermediate table: {path}")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def work_table(df: DataFrame, name: str):
    """``df`` written to the shared folder, as a table that is deleted at the end of the block."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def input_bytes(df: DataFrame) -> int:
    """Size of a scan or a union of scans as Catalyst estimates it from file lengths; 0 where it cannot tell."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else 0


def split_bytes(bytes_in: int) -> int:
    usual = min(max(SMALLEST_SPLIT, -(-bytes_in // FEW_SCAN_TASKS)), USUAL_SPLIT)
    return min(max(usual, -(-bytes_in // MAX_SCAN_TASKS)), LARGEST_SPLIT)


def shuffle_partitions(bytes_in: int, floor: int, most: int | None = None) -> int:
    """Partitions of about ``DECODED_BYTES_PER_PARTITION`` as rows. ``most`` is for clusters whose shuffle
    service cannot hold so many blocks; partitions then spill instead."""
    wanted = max(floor, -(-bytes_in * DECODED_TIMES // DECODED_BYTES_PER_PARTITION))
    return wanted if most is None else min(wanted, max(floor, most))


def write_bytes(bytes_in: int) -> int:
    return min(max(SMALLEST_WRITE, -(-bytes_in // FILES_WANTED)), LARGEST_WRITE)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs started inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def sized_for(spark: SparkSession, bytes_in: int, most_partitions: int | None = None):
    """Task sizes for jobs over ``bytes_in``: larger scan and write tasks when there are very many, and
    enough shuffle partitions to start with. AQE merges what proves small."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = int(spark.conf.get(INITIAL_PARTITIONS, None) or 0)
    fine = min(bytes_in // FINE_BYTES, FINE_PARTITIONS)
    wanted = max(shuffle_partitions(bytes_in, max(floor, fine), most_partitions), asked)
    values = {INITIAL_PARTITIONS: str(wanted), SPLIT_BYTES: str(split_bytes(bytes_in))}
    if write_bytes(bytes_in) > SMALLEST_WRITE:
        values[ADVISORY_BYTES] = str(write_bytes(bytes_in))
    log.info("shuffles start with %d partitions for %d bytes", wanted, bytes_in)
    with settings(spark, values):
        yield
