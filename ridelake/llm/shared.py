"""What the operators have in common: tables, words, work files and ordered prefix sums.

Operators take the columns they name and ignore all others, so extra columns of any name do no harm.
A null text counts as empty unless an operator says otherwise.
"""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.session import discard, work_path

# Fixed by the contract of the queries: what separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of text in one Arrow batch. A batch is the unit of memory of a Python worker.
BATCH_ROWS = 1000

_made: dict[str, list[str]] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_in(text: Column) -> Column:
    """Number of words: one more than the gaps between them, in a text without outer white space."""
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def free_names(taken: list[str], *names: str) -> list[str]:
    """Column names like these that ``taken`` does not have; upper and lower case are the same."""
    used, out = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def work(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names in ``spark.checkpoint.dir``. Only a
    local session that names none, such as a test's, gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ridelake-"))
    path = work_path(spark, name)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = work(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables ``stored`` has made in this application. Results read them, so write those first."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        discard(spark, path)


def python_tasks(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Before Python runs in tasks: bound what a worker holds of the texts at a time, and send this package's
    functions themselves, so that executors need no copy of it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


def in_ranges(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` sorted into ranges of ``order``, stored, with the number of each row's range in ``_part``.

    Ranges are cut by sampled keys, so a group with most of the rows has many of them.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("_part", F.spark_partition_id()), name)


def running_sum(ranged: DataFrame, group: str | None, order: list[str], value: str, name: str) -> DataFrame:
    """Adds column ``name``: the sum of ``value`` over the rows before this one in its group.

    ``ranged`` comes from ``in_ranges`` with ``group`` first in its order. Sums run within each range;
    what the ranges before it hold comes from one row per range and group, so no task gets a whole group.
    Null is a group as well. Rows that tie in ``order`` follow each other in any order.
    """
    keys = [group] if group else []
    parts = ranged.groupBy(*keys, "_part").agg(F.sum(value).alias("_own"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(key).alias("_group") for key in keys], F.col("_part").alias("_of"),
        F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_of")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    within = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(parts, same)
            .withColumn(name, (F.col("_before") + F.col("_within")).cast("long"))
            .drop("_within", "_before", "_of", "_group"))
