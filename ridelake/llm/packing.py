"""Documents packed into sequences of at most ``CAPACITY`` tokens, by linear grouping and best fit.

A document is its token ids and an end mark (id 0). One that is longer than a sequence is cut into pieces of
``CAPACITY`` tokens, of which the first may be shorter; whole pieces are sequences by themselves. All other pieces are
packed by their lengths alone, of which there are fewer than ``CAPACITY`` different ones, however many documents:

1. *Histogram.* Tasks number their pieces of each length; counts of (task, length), summed over the tasks before,
   make these numbers ranks among all pieces of the length. The driver gets one count for each length.
2. *Linear grouping* (de la Vega, Lueker). Lengths above ``SMALL`` are put in descending order, split into ``GROUPS``
   groups of equally many pieces and rounded up to the greatest of their group.
3. *Configurations.* Of these few sizes, the linear programme over all ways to fill a sequence is solved by column
   generation: a knapsack over the dual prices finds the next configuration. Whole uses of each are kept.
4. *Substitution.* Pieces take the places of their group in descending order. Lengths are a step function of the
   rank, so a configuration's sequences fall into runs that are filled alike; true lengths give the offsets.
5. *Best fit.* The rest, pieces of at most ``SMALL`` tokens and what rounding down left, go in descending order
   to the sequences with the least room that suffices, as many as fit at a time; new ones are opened last.

Steps 2 to 5 see the histogram only; their plan (``Plan``) is some ten thousand runs (length, first rank, number, first
sequence, offset) at any size of the corpus, and tasks look pieces up in it by binary search.

Null texts count as empty and are one end mark. Rows that repeat, ids included, are documents of their own. Null
ids are carried along. Pieces of equal length are interchangeable; which one gets which place depends on the tasks.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.chat_format import MOST_TOKENIZER_BYTES, TOKENIZER
from ridelake.llm.shared import python_tasks, stored

CAPACITY = 2048
END = 0
# With up to three large pieces to a sequence, rounding up costs little: on document-like lengths the result is within 0.1 %
# of the sum of all lengths over the capacity (256 small tokens and 48 groups: 2 %).
SMALL, GROUPS = CAPACITY // 3, 256
# Simplex steps; each basis on the way is a solution, so stopping early is only a little worse.
MOST_STEPS = 3000

# Fixed value: how the vocabulary's pre-tokenizer splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str = TOKENIZER) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of the byte strings of a byte-level vocabulary, and of its special tokens."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MOST_TOKENIZER_BYTES + 1)
    if len(text) > MOST_TOKENIZER_BYTES:
        raise ValueError(f"{path} is too large to send to the executors")
    described = json.loads(text)
    # Such vocabularies write a byte as the character of its number if that is visible, else as one from 256 on.
    visible = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    return {bytes(byte_of[c] for c in token): number for token, number in described["model"]["vocab"].items()
            if token not in special}, special


def _cutter(sent, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        ranks, special = sent.value
        encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        allowed, part, numbers = set(special), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row, piece, start, length, place, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = np.append(np.array(encoding.encode(text or "", allowed_special=allowed), "<u4"), np.uint32(END))
                first = len(found) % capacity or capacity
                for number, at in enumerate([0, *range(first, len(found), capacity)]):
                    own = found[at:at + capacity if number else first].astype("<u4")
                    row.append(i)
                    piece.append(number)
                    start.append(at)
                    length.append(len(own))
                    place.append(numbers[len(own)])
                    numbers[len(own)] += 1
                    ids.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length)], pa.array(ids, pa.binary()),
                 pa.array([part] * len(row), pa.int32()), pa.array(place, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids", "part", "place"])
    return cut


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids (little-endian unsigned 32-bit numbers), part and place: one row for
    each piece. ``place`` numbers the pieces of one length within their task, ``part``."""
    spark = docs.sparkSession
    python_tasks(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cutter(spark.sparkContext.broadcast(vocabulary(tokenizer)), capacity),
        f"doc_id {kind}, piece int, start long, length long, ids binary, part int, place long")


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is in the most valuable filling of one sequence."""
    useful = np.flatnonzero(worth > 1e-12)
    value, choices = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        better, choice = value.copy(), np.full(capacity + 1, -1)
        for i in useful:
            offered = value[:capacity + 1 - sizes[i]] + worth[i]
            gain = offered > better[sizes[i]:] + 1e-12
            better[sizes[i]:][gain] = offered[gain]
            choice[sizes[i]:][gain] = i
        value = better
        choices.append(choice)
    held, room = np.zeros(len(sizes)), capacity
    for choice in reversed(choices):
        if choice[room] >= 0:
            held[choice[room]] += 1
            room -= sizes[choice[room]]
    return held


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Fillings of few sizes and how often to use each: the linear programme's solution, rounded down."""
    if not len(sizes):
        return []
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(MOST_STEPS):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        held = best_configuration(sizes, worth, capacity)
        if worth @ held <= 1 + 1e-9:
            break
        times, change = np.linalg.solve(basis, np.stack([demand.astype(float), held], axis=1)).T
        ratio = np.where(change > 1e-9, np.maximum(times, 0) / np.maximum(change, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = held
    times = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-9).astype(np.int64)
    used, left = [], demand.copy()
    for column, n in zip(basis.T.round().astype(np.int64), times):
        n = min([int(n), *(left[column > 0] // column[column > 0]).tolist()])
        if n > 0:
            used.append((column, n))
            left -= column * n
    return used


@dataclass
class Plan:
    """Runs of pieces: those of ``length`` with ranks from ``rank`` on go to the sequences from ``sequence`` on, one to
    each, all at ``offset``. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.length << 48 | self.rank, length << 48 | rank, "right") - 1
        return self.sequence[run] + rank - self.rank[run], self.offset[run]


class _Filling:
    """Sequences under way: runs of them with equal room, and where pieces were put."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int]] = []
        self.rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, number)

    def opened(self, number: int) -> int:
        self.sequences += number
        return self.sequences - number

    def put(self, length: int, rank: int, number: int, sequence: int, room: int, times: int) -> int:
        """``times`` pieces into each of ``number`` sequences; the next rank."""
        for i in range(times):
            self.rows.append((length, rank + i * number, sequence, self.capacity - room + i * length))
        return rank + times * number

    def best_fit(self, length: int, rank: int, number: int) -> None:
        """``number`` pieces of one length, each where the least room is left."""
        while number:
            room = min((r for r, runs in self.rooms.items() if r >= length and runs), default=None)
            if room is None:
                room = self.capacity
                count = -(-number // (room // length))
                self.rooms[room].append((self.opened(count), count))
            first, count = self.rooms[room].pop()
            times = min(room // length, number)
            filled = min(count, number // times)
            rank = self.put(length, rank, filled, first, room, times)
            number -= filled * times
            self.rooms[room - times * length].append((first, filled))
            if filled < count:
                self.rooms[room].append((first + filled, count - filled))


def plan(counts: np.ndarray, small: int = SMALL, groups: int = GROUPS) -> Plan:
    """Where the pieces go of which there are ``counts[length]``."""
    counts = np.asarray(counts, np.int64)
    capacity = len(counts) - 1
    filling = _Filling(capacity)
    # Positions of the large pieces in descending order, and the position at which each length begins.
    lengths = np.array([n for n in range(capacity, small, -1) if counts[n]], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts[lengths])]).astype(np.int64)
    total = int(starts[-1])

    def runs(low: int, high: int) -> list[tuple[int, int, int]]:
        """(position, number, length) of the stretches of one length in a range of positions."""
        inner = starts[(starts > low) & (starts < high)].tolist()
        bounds = [low, *inner, high]
        return [(a, b - a, int(lengths[np.searchsorted(starts, a, "right") - 1])) for a, b in zip(bounds, bounds[1:]) if b > a]

    def rank_of(position: int) -> int:
        return position - int(starts[np.searchsorted(starts, position, "right") - 1])

    cuts = sorted({total * i // groups for i in range(groups + 1)})
    sizes, bounds = [], []
    for low, high in zip(cuts, cuts[1:]):
        size = runs(low, low + 1)[0][2]
        if sizes and sizes[-1] == size:
            bounds[-1][1] = high
        else:
            sizes.append(size)
            bounds.append([low, high])
    sizes = np.array(sizes, np.int64)
    taken = [low for low, _ in bounds]
    for held, times in configurations(sizes, np.array([b - a for a, b in bounds], np.int64), capacity):
        first, slots = filling.opened(times), []
        for group in np.flatnonzero(held):
            for _ in range(held[group]):
                slots.append(taken[group])
                taken[group] += times
        steps = sorted({0, times, *(p - at for at in slots for p, _, _ in runs(at, at + times))})
        for low, high in zip(steps, steps[1:]):
            room = capacity
            for at in slots:
                length = runs(at + low, at + low + 1)[0][2]
                filling.put(length, rank_of(at + low), high - low, first + low, room, 1)
                room -= length
            filling.rooms[room].append((first + low, high - low))
    rest = [run for at, (_, high) in zip(taken, bounds) for run in runs(at, high)]
    for position, number, length in rest:
        filling.best_fit(length, rank_of(position), number)
    for length in range(small, 0, -1):
        filling.best_fit(length, 0, int(counts[length]))
    rows = np.array(sorted(filling.rows), np.int64).reshape(-1, 4)
    return Plan(*rows.T, filling.sequences)


def pack(docs: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda cut: cut, tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """The pieces with sequence_id and offset, one row each. ``keep`` may replace the ids by what is wanted of them, so
    that these are not stored. Sequences of several pieces count from 0, whole pieces get negative numbers."""
    cut = stored(keep(pieces(docs, tokenizer, capacity)), "pieces")
    counts = cut.where(F.col("length") < capacity).groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for each length
        histogram[row["length"]] = row["n"]
    where = plan(histogram, small, groups)

    @pandas_udf("struct<sequence_id: long, offset: long>")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = where.places(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    columns = [c for c in cut.columns if c not in ("part", "place")]
    whole = cut.where(F.col("length") == capacity).select(
        *columns, (-1 - (F.shiftleft(F.col("part").cast("long"), 33) + F.col("place"))).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    ranked = cut.where(F.col("length") < capacity).join(counts.drop("n"), ["part", "length"]).withColumn(
        "at", placed("length", F.col("before") + F.col("place")))
    return whole.unionByName(ranked.select(*columns, "at.sequence_id", "at.offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (of all its pieces, in their order) and lengths, one row for each sequence. No group has more
    than a sequence's tokens."""
    held = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    ids = F.aggregate("held", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", ids.alias("ids"), F.col("held.length").alias("lengths"))


def report(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The packing with a checksum in place of the ids."""
    return pack(docs, lambda cut: cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), tokenizer).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
