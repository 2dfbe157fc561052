"""Benchmark items in documents, found through an embedding of edit distance into Hamming distance.

Words are runs of letters and digits in lower case. An item of n words is found where some stretch of a document
is at most ``MAX_EDITS`` x n word edits (rounded down) away from it. Items of under ten words allow no edit and are
found as they are; items without words are nowhere.

0. *Pieces.* An item of more than ``PIECE_WORDS`` words is cut into pieces of equal size. Of its edits, one piece has no more
   than its share (the pigeonhole principle again), so finding each piece at its share of edits finds the item. The walks
   below thus always work on windows of few words, where few edits change few places.
1. *Windows.* Of so few edits one run of ``SEED_WORDS`` words of the piece is left untouched, however they fall (the
   pigeonhole principle: n / (edits + 1) >= 5 from five words on). So only stretches that hold such a run can match.
   For each run a document shares with some piece, a window of that piece's size is laid over it, at all
   shifts that the edits allow. No other window can match; nothing is lost.
2. *Embedding* (Chakraborty, Goldenberg, Koucký). A walk copies the window's words to its output; at each step a
   random bit of step and word tells whether it moves on. Walks over equal words move alike, and after an edit they
   fall into step again soon, so few edits change few places of the output.
3. *Bit sampling.* ``SAMPLED`` random places of an output form a key; ``WALKS`` x ``SAMPLES`` keys for each window are looked
   up among those of the items. Windows with the edits allowed at most share a key with their item in over 95 %
   of cases at any one shift (``tests/llm`` measures it), those with fewer edits nearly always.
4. *Verification.* The whole item and the stretch around the window are compared exactly (bit-parallel edit distance).

The items are the stated query set. They are handled in blocks of ``BLOCK_WORDS`` words, which bounds what a task
gets of them; each block is sent to executors once and kept by Spark on disk where memory is short. Documents are not
shuffled, and are read once for each block. Null and empty texts hold nothing. Rows of documents that repeat, ids included,
are answered each; items that repeat give a row each. Null ids are carried along. Of several closest places the
first is told. Empty tables give an empty result (no items: all documents stay). Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.shared import in_ranges, python_tasks, running_sum, whole, words_in
from ridelake.llm.shingles import WordNumbers, mixed, tokens

MAX_EDITS = 0.1
SEED_WORDS = 5
PIECE_WORDS = 60
# For the decision to drop a document.
PROVING_WORDS = 5
WALKS, SAMPLES, SAMPLED = 12, 4, 3
BLOCK_WORDS = 500_000
# Windows embedded at a time: their walks take at most 2 x PIECE_WORDS x WINDOWS x WALKS numbers.
WINDOWS = 256
SEED = 11
_PAD = np.uint64(0)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` words."""
    n = len(words) - width + 1
    folded = np.full(max(n, 0), width, np.uint64)
    for i in range(width if n > 0 else 0):
        folded = mixed(folded * _STEP + words[i:n + i])
    return folded


def embedded_keys(windows: np.ndarray) -> np.ndarray:
    """Keys (one row for each window) of windows of one size."""
    count, n = windows.shape
    draw = np.random.default_rng([SEED, n])
    multiply = draw.integers(0, 2**63, (2 * n, WALKS), np.uint64) * np.uint64(2) + np.uint64(1)
    places = draw.integers(0, 2 * n, (SAMPLED, WALKS, SAMPLES))
    padded = np.concatenate([windows, np.full((count, 1), _PAD)], axis=1)
    at = np.zeros((count, WALKS), np.int64)
    rows = np.arange(count)[:, None]
    output = np.empty((2 * n, count, WALKS), np.uint64)
    for step in range(2 * n):
        word = padded[rows, at]
        output[step] = word
        at = np.minimum(at + ((mixed(word) * multiply[step]) >> np.uint64(63)).astype(np.int64), n)
    keys = np.broadcast_to(
        mixed(np.arange(1, WALKS * SAMPLES + 1, dtype=np.uint64) * np.uint64(n)).reshape(1, WALKS, SAMPLES),
        (count, WALKS, SAMPLES))
    walk = np.arange(WALKS)[:, None]
    for place in places:
        keys = mixed(keys * _STEP + output[place, :, walk].transpose(2, 0, 1))
    return keys.reshape(count, -1)


def edit_search(item: list[int], stretch: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``stretch``, and where the first such part ends."""
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    of = defaultdict(int)
    for i, word in enumerate(item):
        of[word] |= 1 << i
    up, down, score = full, 0, n
    best, end = n, 0
    for j, word in enumerate(stretch):
        equal = of.get(word, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1, fall << 1
        up, down = (fall | ~(diagonal | rise)) & full, rise & diagonal & full
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """A block of items, ready to be searched for."""

    def __init__(self, ids: list[int], texts: list[str], max_edits: float = MAX_EDITS, least_words: int = 1):
        numbers = WordNumbers()
        self.ids, self.words, self.edits = [], [], []
        # A piece: number of its item, where in it the piece begins, edits allowed in it.
        self.pieces: list[tuple[int, int, int]] = []
        self.seeds: dict[int, set[tuple[int, int, int]]] = defaultdict(set)
        self.keys: dict[int, set[int]] = defaultdict(set)
        widths = set()
        for item_id, text in zip(ids, texts):
            words = numbers.of(tokens(text))
            n, allowed = len(words), int(len(words) * max_edits + 1e-9)
            if n < least_words or not n:
                continue
            count = -(-n // PIECE_WORDS)
            share = allowed // count
            for at in range(count):
                start, end = n * at // count, n * (at + 1) // count
                piece, width = words[start:end], min(SEED_WORDS, (end - start) // (share + 1))
                widths.add(width)
                for place, run in enumerate(runs(piece, width).tolist()):
                    self.seeds[run].add((place, end - start, share))
                for key in embedded_keys(piece[None, :])[0].tolist():
                    self.keys[key].add(len(self.pieces))
                self.pieces.append((len(self.ids), start, share))
            self.ids.append(item_id)
            self.words.append(words.tolist())
            self.edits.append(allowed)
        self.widths = sorted(widths)
        self.seed_runs = np.array(sorted(self.seeds), np.uint64)
        self.sorted_keys = np.array(sorted(self.keys), np.uint64)

    def windows(self, words: np.ndarray) -> dict[int, set[int]]:
        """Window starts for each size."""
        found: dict[int, set[int]] = defaultdict(set)
        for width in self.widths:
            present = runs(words, width)
            for at in np.flatnonzero(_contained(present, self.seed_runs)).tolist():
                for place, n, allowed in self.seeds[int(present[at])]:
                    found[n].update(range(max(at - place - allowed, 0), max(at - place + allowed, 0) + 1))
        return found

    def candidates(self, words: np.ndarray) -> dict[int, set[int]]:
        """Where each item may start of which a window shares a key of a piece."""
        found: dict[int, set[int]] = defaultdict(set)
        for n, starts in self.windows(words).items():
            padded = np.concatenate([words, np.full(n, _PAD)])
            ordered = np.array(sorted(s for s in starts if s < len(words)), np.int64)
            for chunk in np.array_split(ordered, len(ordered) // WINDOWS + 1):
                if not len(chunk):
                    continue
                keys = embedded_keys(padded[chunk[:, None] + np.arange(n)])
                for row, column in zip(*np.nonzero(_contained(keys, self.sorted_keys))):
                    for piece in self.keys[int(keys[row, column])]:
                        number, start, _ = self.pieces[piece]
                        found[number].add(int(chunk[row]) - start)
        return found

    def matches(self, text: str | None, numbers: WordNumbers) -> list[tuple[int, int, int, int]]:
        """(item id, edits, first word, end word) of the closest place of each item, the first if several."""
        words = numbers.of(tokens(text))
        listed: list[int] | None = None
        out = []
        for number, starts in sorted(self.candidates(words).items()):
            listed = words.tolist() if listed is None else listed
            item, allowed = self.words[number], self.edits[number]
            best, checked = None, -1
            for start in sorted(starts):
                if start <= checked:
                    continue
                # A piece says where the item starts but for the edits in it and before it.
                low = max(start - 3 * allowed, 0)
                distance, end = edit_search(item, listed[low:max(start + len(item) + 4 * allowed, 0)])
                checked = start + allowed
                if distance <= allowed and (best is None or distance < best[0]):
                    back, length = edit_search(item[::-1], listed[max(low + end - len(item) - allowed, 0):low + end][::-1])
                    best = (distance, low + end - length, low + end)
            if best:
                out.append((self.ids[number], *best))
        return out


def _contained(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(values.shape, bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def item_blocks(benchmark: DataFrame, max_edits: float = MAX_EDITS, block_words: int = BLOCK_WORDS,
                least_words: int = 1) -> Iterator:
    """The items in blocks of about ``block_words`` words each, as broadcast ``Items``."""
    rows = benchmark.select("item_id", whole("text").alias("text")).withColumn("n", words_in(F.col("text")))
    dealt = running_sum(in_ranges(rows, ["item_id", "text"], "items"), None, ["item_id", "text"], "n", "before")
    dealt = dealt.withColumn("block", F.floor(F.col("before") / block_words))
    last = dealt.agg(F.max("block")).first()[0]
    for block in range(0 if last is None else last + 1):
        held = dealt.where(F.col("block") == block).select("item_id", "text").collect()
        held.sort(key=lambda row: (row["item_id"] is None, row["item_id"], row["text"]))
        yield benchmark.sparkSession.sparkContext.broadcast(
            Items([row["item_id"] for row in held], [row["text"] for row in held], max_edits, least_words))


def find(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, least_words: int = 1,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, edits, first_word, end_word: a row for each row of ``docs`` and each item it holds."""
    spark = docs.sparkSession
    python_tasks(spark)
    kind, item_kind = (frame.schema[c].dataType.simpleString() for frame, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, edits int, first_word int, end_word int"

    def searched(sent):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, items = WordNumbers(), sent.value
            for batch in batches:
                rows, hits = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for hit in items.matches(text, numbers):
                        rows.append(i)
                        hits.append(hit)
                ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                columns = list(zip(*hits)) if hits else [()] * 4
                kinds = [item_type, pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    ["doc_id", "item_id", "edits", "first_word", "end_word"])
        return found

    item_type = pa.int32() if item_kind == "int" else pa.string() if item_kind == "string" else pa.int64()
    result = spark.createDataFrame([], schema)
    for items in item_blocks(benchmark, max_edits, block_words, least_words):
        result = result.union(docs.select("doc_id", "text").mapInArrow(
            searched(items), schema))
    return result


def without_items(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS,
                  least_words: int = PROVING_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``least_words`` words or more. Shorter ones, such as a lone yes or
    no, are found by ``find`` as well, but that a document holds one does not prove that it holds the benchmark."""
    python_tasks(docs.sparkSession)
    for items in item_blocks(benchmark, max_edits, least_words=least_words):
        docs = docs.where(_holds_none(items)("text"))
    return docs


def _holds_none(sent):
    @pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        numbers, items = WordNumbers(), sent.value
        return pd.Series([not items.matches(text, numbers) for text in texts], dtype=bool)

    return clean
