"""What five filters remove, alone and in each order, with exact copies found by radix tries.

Failure conditions of a text (null: empty; words are divided by ASCII white space): A: fewer than 50 words; B: under 65 %
of its words are different; C: more than 5 % of its characters are A-Z; D: it holds any of ``#$%&*|``; E: a row with a
smaller id has an identical text, removed or not.

*Copies (E).*

1. *Adaptive prefixes.* The bytes of different texts are summed by their first ``FIRST_PREFIX`` characters; prefixes with
   more than ``RANGE_BYTES`` are cut again by four times as many characters, until none is too full or it is one
   text. In order, they are cut into ranges of about ``RANGE_BYTES``; the driver gets one prefix for each range.
2. *Tries.* Tasks find a text's range by binary search; copies within a task are merged before they are sent. A range's
   full texts are inserted into a compressed trie: edges hold byte strings, terminals the least and the greatest
   id of their text. Equal texts meet in one terminal, so the comparison is of whole texts.
3. *Flags.* A traversal carries a hash down the edges and reports digest and least id of terminals with several ids.
   Rows of a larger id and that digest fail. So a text that a third of all rows have goes to its trie once for each task, and
   its rows are joined to one entry, which Spark splits.

*Audit.* Each row is five bits. Rows are counted by part and bits (at most 32 counts a part); all 120 orders and 5 steps
follow from these counts. A part is a source, null being the empty string.

A row without id never fails E and makes none fail; rows that repeat with their id do not fail each other. A document is
good (toxic) if any label row of its id says so. An empty table has no parts and gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import in_ranges, python_tasks, running_sum, stored, whole

# Fixed by the contract of the query.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_VARIETY, MOST_CAPITALS = 50, 65, 5
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no character

# Bytes of different texts in one trie; a range can have twice as many. What a map task holds to merge copies.
RANGE_BYTES = 64 * 2**20
HELD_BYTES = 8 * 2**20
FIRST_PREFIX = 8
# Ranges are tasks of their own up to this number; beyond, a task works through several, one trie after the other.
MOST_PARTITIONS = 100_000


def digest_of(text: bytes) -> bytes:
    return blake2b(text, digest_size=16).digest()


def text_bits(text: bytes) -> int:
    """Bits 1, 2, 4 and 8 for failing A, B, C and D."""
    words = text.split()  # of bytes: at ASCII white space only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    characters = len(text.translate(None, _FOLLOWING))
    return ((len(words) < LEAST_WORDS) + 2 * (100 * len(set(words)) < LEAST_VARIETY * len(words))
            + 4 * (100 * capitals > MOST_CAPITALS * characters) + 8 * (len(text.translate(None, SYMBOLS)) < len(text)))


class Trie:
    """A compressed trie of byte strings with the least and the greatest id of each."""

    def __init__(self):
        self.edge: list[bytes] = [b""]
        self.children: list[dict[int, int]] = [{}]
        self.ids: list[tuple | None] = [None]

    def _node(self, edge: bytes, children: dict[int, int], ids: tuple | None) -> int:
        self.edge.append(edge)
        self.children.append(children)
        self.ids.append(ids)
        return len(self.edge) - 1

    def insert(self, text: bytes, least, greatest) -> None:
        node, at = 0, 0
        while at < len(text):
            below = self.children[node].get(text[at])
            if below is None:
                self.children[node][text[at]] = self._node(text[at:], {}, (least, greatest))
                return
            edge = self.edge[below]
            if not text.startswith(edge, at):
                same = _common(edge, text, at)
                middle = self._node(edge[:same], {edge[same]: below}, None)
                self.edge[below] = edge[same:]
                self.children[node][text[at]] = below = middle
                edge = self.edge[middle]
            node, at = below, at + len(edge)
        known = self.ids[node]
        self.ids[node] = (least, greatest) if known is None else (min(known[0], least), max(known[1], greatest))

    def copies(self) -> Iterator[tuple[bytes, object]]:
        """Digest and least id of the texts that have several ids."""
        waiting = [(0, blake2b(digest_size=16))]
        while waiting:
            node, above = waiting.pop()
            said = above.copy()
            said.update(self.edge[node])
            ids = self.ids[node]
            if ids and ids[0] < ids[1]:
                yield said.digest(), ids[0]
            waiting += [(below, said) for below in self.children[node].values()]


def _common(edge: bytes, text: bytes, at: int) -> int:
    """Length of what ``edge`` and ``text`` from ``at`` on have in common."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if text.startswith(edge[:middle], at) else (low, middle - 1)
    return low


def prefix_ranges(texts: DataFrame, range_bytes: int = RANGE_BYTES, first_prefix: int = FIRST_PREFIX) -> list[bytes]:
    """The least prefix of each range of ``body`` but the first, in order: about one for ``range_bytes`` of text."""
    leaves, crowded, length = None, None, first_prefix
    while True:
        rows = texts if crowded is None else texts.join(
            crowded, F.substring("body", 1, length // 4) == F.col("prefix"), "left_semi")
        weighed = stored(rows.groupBy(F.xxhash64("body").alias("text"), F.substring("body", 1, length).alias("prefix")).agg(
            F.max(F.octet_length("body")).alias("bytes")).groupBy("prefix").agg(
                F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "prefixes")
        full = (F.col("bytes") > range_bytes) & (F.col("n") > 1)
        fitting = weighed.where(~full).select("prefix", "bytes")
        leaves = fitting if leaves is None else leaves.union(fitting)
        crowded = weighed.where(full).select("prefix")
        if crowded.isEmpty():
            break
        length *= 4
    summed = running_sum(in_ranges(leaves, ["prefix"], "leaves"), None, ["prefix"], "bytes", "before")
    first = summed.groupBy(F.floor(F.col("before") / range_bytes)).agg(F.min("prefix").alias("prefix")).collect()
    return sorted(row["prefix"].encode() for row in first)[1:]


def _merger(starts, held_bytes: int):
    """Range, text, least and greatest id; copies within a task are one row, or one for each time memory was short."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, held, size = starts.value, {}, 0

        def sent(texts: list[bytes]) -> pa.RecordBatch:
            ids = [held.pop(text) for text in texts]
            return pa.RecordBatch.from_arrays(
                [pa.array([bisect_right(bounds, text) for text in texts], pa.int32()), pa.array(texts, pa.binary()),
                 *[pa.array([x[i] for x in ids], kind) for i in (0, 1)]], ["range", "body", "least", "greatest"])

        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            for text, number in zip(batch.column("body").to_pylist(), batch.column("doc_id").to_pylist()):
                known = held.get(text)
                if known is None:
                    held[text] = (number, number, 1)
                    size += len(text)
                else:
                    held[text] = (min(known[0], number), max(known[1], number), known[2] + 1)
                if size > held_bytes:
                    single = [t for t, x in held.items() if x[2] == 1]  # what repeats stays, so that it is sent once
                    yield sent(single)
                    size = sum(map(len, held))
                    if size > held_bytes // 2:
                        yield sent(list(held))
                        size = 0
        if held:
            yield sent(list(held))
    return merged


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one range after the other, each range in a trie of its own."""
    kind = pa.int64()

    def reported(trie: Trie) -> pa.RecordBatch:
        found = list(trie.copies())
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in found], pa.binary()), pa.array([i for _, i in found], kind)], ["digest", "least_id"])

    trie, current = Trie(), None
    for batch in batches:
        kind = batch.column("least").type
        for number, *row in zip(*[batch.column(c).to_pylist() for c in ("range", "body", "least", "greatest")]):
            if number != current:
                if current is not None:
                    yield reported(trie)
                trie, current = Trie(), number
            trie.insert(*row)
    yield reported(trie)


def copies(docs: DataFrame, range_bytes: int = RANGE_BYTES, held_bytes: int = HELD_BYTES,
           most_partitions: int = MOST_PARTITIONS, first_prefix: int = FIRST_PREFIX) -> DataFrame:
    """digest and least_id of every text that rows with different ids have."""
    spark = docs.sparkSession
    python_tasks(spark)
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", whole("text").alias("body"))
    starts = prefix_ranges(texts, range_bytes, first_prefix)
    ranges = len(starts) + 1
    partitions = min(ranges, most_partitions)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", F.col("body").cast("binary").alias("body")).mapInArrow(
        _merger(spark.sparkContext.broadcast(starts), held_bytes), f"range int, body binary, least {kind}, greatest {kind}")
    dealt = rows.repartitionById(partitions, (F.col("range").cast("long") * partitions / ranges).cast("int"))
    if partitions < ranges:
        dealt = dealt.sortWithinPartitions("range")
    return stored(dealt.mapInArrow(_copies, f"digest binary, least_id {kind}"), "copies")


def _row_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("body").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(map(text_bits, texts), pa.int32()),
             pa.array(map(digest_of, texts), pa.binary())], ["doc_id", "part", "bits", "digest"])


def failures(docs: DataFrame, **ranges) -> DataFrame:
    """doc_id, part and bits (1 to 16 for A to E) of every row."""
    found = copies(docs, **ranges)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       whole("text").cast("binary").alias("body")).mapInArrow(
        _row_bits, f"doc_id {kind}, part string, bits int, digest binary")
    later = F.coalesce(F.col("doc_id") > F.col("least_id"), F.lit(False))
    return rows.join(found, "digest", "left").select(
        "doc_id", "part", (F.col("bits") + F.when(later, 16).otherwise(0)).alias("bits"))


_BITS = np.arange(32)
_STEPS = [(order, step, 1 << FILTERS.index(order[step - 1]), sum(1 << FILTERS.index(c) for c in order[:step - 1]))
          for order in map("".join, permutations(FILTERS)) for step in range(1, 6)]
_OWN, _EARLIER = (np.array([row[i] for row in _STEPS]) for i in (2, 3))


def _audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    fails, before = (_BITS & _OWN[:, None]) > 0, (_BITS & _EARLIER[:, None]) > 0
    for batch in batches:
        for part, counts in zip(batch["part"], batch["counts"]):
            n, good, toxic = np.zeros((3, 32), np.int64)
            for row in counts:
                n[row["bits"]], good[row["bits"]], toxic[row["bits"]] = row["n"], row["good"], row["toxic"]
            removed = (fails & ~before) @ n
            yield pd.DataFrame({
                "part": part, "filter_order": [s[0] for s in _STEPS], "step": [s[1] for s in _STEPS],
                "kept": (~fails & ~before) @ n, "removed": removed, "redundant": (fails & before) @ n,
                "unique_fails": n[_OWN], "good_lost": (fails & ~before) @ good, "toxic_lost": (fails & ~before) @ toxic,
                "shapley": [int(removed[_OWN == own].sum()) for own in _OWN]})


def audit(docs: DataFrame, labels: DataFrame, **ranges) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley: 600 rows a
    part."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")).where("good OR toxic")
    counts = failures(docs, **ranges).join(marks, "doc_id", "left").groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    return counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("counts")).mapInPandas(
        _audited, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long,"
                  " good_lost long, toxic_lost long, shapley long")
