"""Landing raw files in the lake, each once.

Each landing writes a version folder of its own, ``version=…/source_file=…``, beside what is there. Then it writes what
it landed, one row for each file: name, length, version, rows, schema and the part files with their lengths. Last it
creates the next numbered commit, a tiny file that names those rows. That creation is the commit: it fails if the
number is taken, so of two landings at a time one goes first, and the other looks again and takes the next number.
Readers take only the versions that the latest commit of a file names, so a landing that dies before its commit has
changed nothing, and one that dies after it is complete. Versions that it replaced are deleted last.

A file is skipped if the manifest has its name and length *and* a listing of the lake shows all its part files at their
lengths. So a landing opens no file of the old lake, and notices parts that were removed or cut.
"""

from __future__ import annotations

import json
import logging
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.session import OPEN_FILES, input_bytes, settings, sized_for, work_table
from ridelake.sources.files import (
    SOURCE_FILE, common_schema, existing, file_name, list_files, literal_path, scan_files, union_tolerant,
    widen_ints, widened, with_source_file)

log = logging.getLogger(__name__)

SKIP, REPLACE, NEW = "skip", "replace", "new"
VERSION = "version"
# A leading underscore hides the manifest from readers of the lake folder.
MANIFEST = "_manifest"
PART = "array<struct<file: string, length: long>>"
MANIFEST_SCHEMA = ("name string, length long, version string, rows long, schema string, landed_at timestamp,"
                   f" parts {PART}, body string")
# How often a landing looks again when another one has committed first.
ATTEMPTS = 50
_PLACE = [StructField(VERSION, StringType()), StructField(SOURCE_FILE, StringType())]


def landing_actions(source: DataFrame, lake: DataFrame) -> DataFrame:
    """What to do with each source file: ``(name, length)`` twice → ``(name, length, action)``."""
    present = lake.select("name", F.col("length").alias("landed"))
    return source.join(present, "name", "left").select(
        "name", "length",
        F.when(F.col("landed").isNull(), NEW)
        .when(F.col("landed") == F.col("length"), SKIP)
        .otherwise(REPLACE).alias("action"))


def _files_of(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def last_commit(spark: SparkSession, lake: str) -> int:
    """The greatest commit number, 0 before the first landing."""
    at, files = _files_of(spark, f"{lake}/{MANIFEST}/commits")
    if not files.exists(at):
        return 0
    return max((int(found.getPath().getName()) for found in files.listStatus(at)), default=0)


def try_commit(spark: SparkSession, lake: str, number: int, body: str) -> bool:
    """Create the commit of this number; False if another landing has it. The store must create a file only if it is
    absent, as HDFS does."""
    at, files = _files_of(spark, f"{lake}/{MANIFEST}/commits/{number:020d}")
    try:
        out = files.create(at, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or files.exists(at):
            return False
        raise
    out.write(bytearray(body.encode()))
    out.close()
    return True


def history(spark: SparkSession, lake: str) -> DataFrame:
    """Every committed landing of every name, with the number of its commit."""
    commits = existing(lambda: spark.read.text(f"{lake}/{MANIFEST}/commits", wholetext=True))
    bodies = existing(lambda: spark.read.schema(MANIFEST_SCHEMA).parquet(f"{lake}/{MANIFEST}/bodies"))
    if commits is None or bodies is None:
        return spark.createDataFrame([], f"{MANIFEST_SCHEMA}, number long")
    numbered = commits.select(
        F.col("value").alias("body"), F.col("_metadata.file_name").cast("long").alias("number"))
    return bodies.join(numbered, "body")


def manifest(spark: SparkSession, lake: str) -> DataFrame:
    """The latest landing of each name."""
    latest = F.max_by(F.struct("length", "version", "rows", "schema", "parts", "number"), "number")
    return history(spark, lake).groupBy("name").agg(latest.alias("last")).select("name", "last.*")


def _stored(spark: SparkSession, lake: str, schema: StructType | None = None) -> DataFrame | None:
    """Everything in the lake folder, committed or not; without a schema only where rows are."""
    fields = [*(schema.fields if schema else []), *_PLACE]
    return existing(lambda: (
        spark.read.schema(StructType(fields)).option("basePath", lake).parquet(f"{lake}/{VERSION}=*")))


def listed_parts(spark: SparkSession, lake: str, version: str = "*") -> DataFrame:
    """(version, name, file, length) of the files in the lake folder, from a listing: nothing is opened."""
    as_text = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
    with settings(spark, as_text):
        found = existing(lambda: (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", lake)
            .load(f"{lake}/{VERSION}={version}")))
    if found is None or SOURCE_FILE not in found.columns:
        return spark.createDataFrame([], "version string, name string, file string, length long")
    return found.select(VERSION, F.col(SOURCE_FILE).alias("name"), file_name(F.col("path")).alias("file"), "length")


def landed_files(spark: SparkSession, lake: str) -> DataFrame:
    """``(name, length)`` of the files that the lake holds as the manifest says, part by part."""
    named = manifest(spark, lake)
    parts = named.select("name", VERSION, F.explode("parts").alias("part")).select("name", VERSION, "part.*")
    held = parts.join(listed_parts(spark, lake), ["name", VERSION, "file", "length"]).groupBy("name").agg(
        F.count(F.lit(1)).alias("held"))
    return named.join(held, "name", "left").where(
        F.coalesce("held", F.lit(0)) == F.size("parts")).select("name", "length")


def _delete(spark: SparkSession, lake: str, replaced: DataFrame) -> None:
    """Remove the folders of (version, name), and of versions of which nothing is left."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names: dict[str, set[str]] = {}
    for row in replaced.select(VERSION, "name").toLocalIterator():
        names.setdefault(row[VERSION], set()).add(row["name"])
    for version, gone in names.items():
        at, files = _files_of(spark, f"{lake}/{VERSION}={version}")
        if not files.exists(at):
            continue
        left = 0
        for held in files.listStatus(at):
            key, _, name = held.getPath().getName().partition("=")
            if key == SOURCE_FILE and unescape(name) in gone:
                files.delete(held.getPath(), True)
            else:
                left += key == SOURCE_FILE
        if not left:
            files.delete(at, True)


def vacuum(spark: SparkSession, lake: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete versions that no file has as its latest and that are older than a landing may take: what landings
    left that died. Returns their names."""
    named = {row[VERSION] for row in manifest(spark, lake).select(VERSION).distinct().toLocalIterator()}
    at, files = _files_of(spark, lake)
    limit = (time.time() - 3600 * older_than_hours) * 1000
    gone = []
    for found in files.listStatus(at):
        key, _, version = found.getPath().getName().partition("=")
        if key == VERSION and version not in named and found.getModificationTime() < limit:
            files.delete(found.getPath(), True)
            gone.append(version)
    return gone


def land_raw(spark: SparkSession, source_dir: str, lake: str, glob: str = "*.parquet") -> DataFrame:
    """Bring the lake up to date with a folder of files; returns ``(name, action)`` of all of them.

    Every task reads splits of source files and writes them to those files' folders, so nothing is shuffled.
    Running it again skips everything. Several landings may run at a time; readers of a replaced version should be done.
    """
    files = list_files(spark, source_dir, glob).select("path", file_name(F.col("path")).alias("name"), "length")
    base = last_commit(spark, lake)
    decided = landing_actions(files.select("name", "length"), landed_files(spark, lake))
    with work_table(decided.join(files.select("name", "path"), "name"), "actions") as actions:
        todo = actions.where(F.col("action") != SKIP).orderBy("name").collect()
        if todo:
            _land(spark, lake, [row["path"] for row in todo], actions.where(F.col("action") != SKIP), base)
        done = spark.createDataFrame(actions.select("name", "action").collect(), "name string, action string")
    log.info("%d file(s) landed", len(todo))
    return done


def _land(spark: SparkSession, lake: str, paths: list[str], todo: DataFrame, base: int) -> None:
    """Write the files as a new version and commit it after commit ``base`` and whatever has followed it."""
    version = f"v{uuid.uuid4().hex}"
    incoming = scan_files(spark, [literal_path(path) for path in paths], prepare=with_source_file)
    with sized_for(spark, input_bytes(incoming)), settings(spark, OPEN_FILES):
        incoming.write.partitionBy(SOURCE_FILE).parquet(f"{lake}/{VERSION}={version}")
    schema = StructType([f for f in incoming.schema.fields if f.name != SOURCE_FILE])
    counted = spark.read.schema(StructType([_PLACE[1]])).parquet(f"{lake}/{VERSION}={version}").groupBy(
        F.col(SOURCE_FILE).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    parts = listed_parts(spark, lake, version).groupBy("name").agg(
        F.collect_list(F.struct("file", "length")).alias("parts"))
    rows = todo.join(counted, "name", "left").join(parts, "name", "left").select(
        "name", "length", F.lit(version).alias(VERSION), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.lit(schema.json()).alias("schema"), F.current_timestamp().alias("landed_at"),
        F.coalesce("parts", F.expr(f"cast(array() AS {PART})")).alias("parts"))
    for _ in range(ATTEMPTS):
        before = last_commit(spark, lake)
        # What another landing has committed meanwhile at the same length need not be committed again.
        done = manifest(spark, lake).where(F.col("number") > base).select("name", "length")
        body = uuid.uuid4().hex
        rows.join(done, ["name", "length"], "left_anti").withColumn("body", F.lit(body)).coalesce(1).write.mode(
            "append").parquet(f"{lake}/{MANIFEST}/bodies")
        with work_table(history(spark, lake).where(F.col("number") <= before).select("name", VERSION), "known") as known:
            if try_commit(spark, lake, before + 1, body):
                current = manifest(spark, lake).select("name", VERSION)
                ours = rows.select("name", VERSION)
                replaced = known.join(rows.select("name"), "name", "left_semi").union(ours).distinct()
                _delete(spark, lake, replaced.join(current, ["name", VERSION], "left_anti"))
                return
        log.info("commit %d was taken by another landing", before + 1)
    raise RuntimeError(f"{ATTEMPTS} other landings went first in {lake}")


# Names up to which a read of some files says which, so that the folders of others are never listed or opened.
MOST_NAMED = 10_000


def read_lake(spark: SparkSession, lake: str, only: DataFrame | None = None, keep_place: bool = False) -> DataFrame:
    """All raw trips of the lake, or those of the files in ``only`` (name, version). ``keep_place`` keeps version and
    source_file of each.

    One scan of the folder with the schema that the manifest knows; no footer is merged and no path listed
    by us. Only where landings disagree on a type beyond integer width is there one scan for each schema.
    """
    named = manifest(spark, lake)
    if only is not None:
        named = named.join(only.select("name", VERSION), ["name", VERSION], "left_semi")
    schemas = [row["schema"] for row in named.select("schema").distinct().orderBy("schema").collect()]
    if not schemas:
        raise FileNotFoundError(f"nothing has landed in {lake}")
    parsed = [StructType.fromJson(json.loads(text)) for text in schemas]
    target = common_schema([widened(schema) for schema in parsed])
    chosen = F.lit(True)
    if only is not None:
        places = only.select("name", VERSION).limit(MOST_NAMED + 1).collect()
        if len(places) <= MOST_NAMED:
            chosen = F.col(SOURCE_FILE).isin([p["name"] for p in places]) & F.col(VERSION).isin(
                sorted({p[VERSION] for p in places}))

    def scan(schema: StructType, current: DataFrame) -> DataFrame:
        wanted = current.select(VERSION, F.col("name").alias(SOURCE_FILE))
        held = _stored(spark, lake, schema)
        if held is None:  # all files are empty
            held = spark.createDataFrame([], StructType([*schema.fields, *_PLACE]))
        held = held.where(chosen).join(wanted, [VERSION, SOURCE_FILE], "left_semi")
        return held if keep_place else held.drop(VERSION, SOURCE_FILE)

    if target is not None:
        return scan(target, named)
    return union_tolerant([
        widen_ints(scan(schema, named.where(F.col("schema") == text))) for text, schema in zip(schemas, parsed)])


# Names of the samples that are complete; a leading underscore hides it from readers of the samples.
LEDGER = "_complete"


def write_sample(df: DataFrame, path: str) -> DataFrame:
    """Write the samples of files that ``path`` has none of yet; returns the names written.

    ``df`` carries ``source_file``. A sample counts once the ledger beside the samples has its name, which is
    written after its rows; one that was left half written is replaced. Samples are small: they are computed
    once, into the shared folder, and go on from there.
    """
    spark = df.sparkSession
    fresh = df
    known = existing(lambda: spark.read.schema(f"{SOURCE_FILE} string").parquet(f"{path}/{LEDGER}"))
    if known is not None:
        fresh = df.join(known, SOURCE_FILE, "left_anti")
    with work_table(fresh, "sample") as sampled:
        names = sampled.select(SOURCE_FILE).distinct().orderBy(SOURCE_FILE).collect()
        done = spark.createDataFrame(names, f"{SOURCE_FILE} string")
        if names:
            # Only the folders of these names are replaced.
            sampled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SOURCE_FILE).parquet(path)
            done.coalesce(1).write.mode("append").parquet(f"{path}/{LEDGER}")
    return done
