"""Words and word shingles as 64-bit numbers, and groups of sorted Arrow batches. Runs inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

TOKEN = re.compile(r"[^\W_]+")


class WordNumbers(dict):
    """64-bit number of a word; forgets all words when it has become large."""

    LIMIT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter((self[word] for word in words), np.uint64, len(words))


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return TOKEN.findall((text or "").lower())


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """The different shingles of ``width`` words, sorted. A shorter text is one shingle, an empty one none."""
    if len(numbers) == 0:
        return numbers
    width = min(width, len(numbers))
    folded = np.full(len(numbers) - width + 1, width, np.uint64)
    for i in range(width):
        folded = mixed(folded * np.uint64(0x9E3779B97F4A7C15) + numbers[i:len(numbers) - width + 1 + i])
    return np.unique(folded)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal integer keys out of batches that are sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not len(table):
            continue
        changed = np.zeros(len(table) - 1, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changed |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(changed) + 1).tolist()]
        if len(starts) > 1:
            table = table.combine_chunks()
        for start, end in zip(starts, starts[1:]):
            yield table.slice(start, end - start)
        rest = table.slice(starts[-1])
    if rest is not None and len(rest):
        yield rest.combine_chunks()


def stars(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` points the smallest point it is connected to by the given links."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label
