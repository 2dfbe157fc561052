"""Exact duplicates by an extendible-hash index on shared files (DataFrame functions only).

Texts are equal when they are after each run of white space became one space; null counts as empty.
The row with the smallest ``doc_id`` of a group stays (null ids come last). Of rows that share both id and
text exactly one stays.

1. *Directory.* Every row is hashed to a 64-bit key, and a slot is a prefix of the key. While a slot holds more
   keys than a bucket may, the directory doubles. Slots whose common prefix still fits one bucket share it, so
   a bucket is a range of keys. This reads no more than the keys.
2. *Owners.* Rows go to the bucket of their key, and each key has one owner task. It chains the different texts
   of a key, comparing bytes, and takes the staying id and the number of copies from the chain. Map tasks chain
   what they have before, so a group with a third of all rows sends one row per task. Where a chain has several
   texts, their copies are counted by text.
3. *Index files.* Entries are written by key ranges of their buckets; those of a key alone hold no text.
4. *Look-up.* Each row finds its entry by bucket and key; in a chain of several texts also by its bytes. Digests
   are only reported, they decide nothing.

Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.shared import SPACE, stored, whole

BUCKET_ENTRIES = 1_000_000
# 1,048,576 slots of 24 bytes: up to this depth the directory takes no more than 25 MB and is sent to all tasks.
# Beyond, Spark joins as it sees fit.
BROADCAST_DEPTH = 20
# A slot must leave a bit of the key.
MAX_DEPTH = 63


@dataclass
class Index:
    entries: DataFrame
    """bucket, key, chain, body (null if the key has no other text), keep_id, group_size, text_sha256; one row
    per different text."""
    directory: DataFrame
    """slot, bucket (the first of the slots that share it), local_depth, bucket_entries."""
    depth: int


def probes(docs: DataFrame) -> DataFrame:
    text = F.regexp_replace(whole("text"), SPACE, " ")
    return docs.select("doc_id", text.alias("body")).select("doc_id", "body", F.xxhash64("body").alias("key"))


def slot_of(depth: int):
    return F.shiftrightunsigned("key", 64 - depth)


def grow_directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Double while a slot is overfull and holds more than one key."""
    depth = 1
    while True:
        slots = keys.groupBy(slot_of(depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        most = slots.agg(F.max("n")).first()[0] or 0
        if most <= capacity or depth == MAX_DEPTH:
            break
        # A bucket of `most` entries needs about this many further bits; fewer would take a pass each.
        depth = min(MAX_DEPTH, depth + max(1, (most // capacity).bit_length() - 1))
    slots = stored(slots, "slots")
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth"))
    first = F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - local_depth), {depth} - local_depth)")
    levels = levels.withColumn("bucket", first)
    fits = (levels.groupBy("local_depth", "bucket").agg(F.sum("n").alias("bucket_entries"))
            .where((F.col("bucket_entries") <= capacity) | (F.col("local_depth") == depth)))
    directory = levels.join(fits, ["local_depth", "bucket"]).groupBy("slot").agg(
        F.min(F.struct("local_depth", "bucket", "bucket_entries")).alias("b")).select("slot", "b.*")
    return stored(directory, "directory"), depth


def in_buckets(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    place = directory.select("slot", "bucket")
    return rows.withColumn("slot", slot_of(depth)).join(
        F.broadcast(place) if depth <= BROADCAST_DEPTH else place, "slot").drop("slot")


def build_index(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> Index:
    keys = stored(probes(docs).select("key").distinct(), "keys")
    directory, depth = grow_directory(keys, capacity)
    placed = in_buckets(probes(docs), directory, depth)
    copies = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    # A set of texts is one text for all copies; it is longer only where different texts share a 64-bit key.
    owned = placed.groupBy("bucket", "key").agg(F.collect_set("body").alias("texts"), *copies)
    owned = stored(owned.select(
        "bucket", "key", F.when(F.size("texts") > 1, F.col("texts")).alias("texts"), "keep_id", "group_size",
        F.sha2(F.col("texts")[0], 256).alias("text_sha256")), "owned")
    alone = owned.where(F.col("texts").isNull()).select(
        "bucket", "key", F.lit(1).alias("chain"), F.lit(None).cast("string").alias("body"), "keep_id", "group_size",
        "text_sha256")
    shared = owned.where(F.col("texts").isNotNull())
    if not shared.isEmpty():
        chained = placed.join(shared.select("bucket", "key"), ["bucket", "key"], "left_semi").groupBy(
            "bucket", "key", "body").agg(*copies)
        # As short as collisions of 64-bit keys are rare.
        order = Window.partitionBy("bucket", "key").orderBy(F.col("keep_id").asc_nulls_last(), "body")
        alone = alone.unionByName(chained.withColumn("chain", F.row_number().over(order)).withColumn(
            "text_sha256", F.sha2("body", 256)))
    entries = alone.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return Index(stored(entries, "index"), directory, depth)


def look_up(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id with the entry of its text."""
    rows, place = in_buckets(probes(docs), index.directory, index.depth), ["bucket", "key"]
    alone, chained = (index.entries.where(c) for c in (F.col("body").isNull(), F.col("body").isNotNull()))
    found = rows.drop("body").join(alone.drop("body"), place)
    if chained.isEmpty():
        return found
    return found.unionByName(rows.join(chained, [*place, "body"]).drop("body"))


def deduplicate(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, chain (1 unless a
    different text has the same key)."""
    found = stored(look_up(docs, build_index(docs, capacity)).withColumn(
        "row", F.monotonically_increasing_id()), "found")
    # Rows may repeat id and text: of those with the staying id the first of each entry stays.
    first = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("bucket", "key", "chain").agg(
        F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    return found.join(first, "row", "left").select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.coalesce("first", F.lit(False)).alias("kept"), "text_sha256", "chain")
