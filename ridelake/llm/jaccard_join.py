"""Documents whose sets of five-word shingles overlap by 0.8 or more (Jaccard), with Bayesian pruning.

Words are runs of letters and digits in lower case. Documents with the same words are copies: they collapse
to one text before anything is compared, and count as linked to each other. Texts without words are copies
if they are equal, and linked to nothing else.

1. *Signatures.* 128 MinHash values for each text: half of them in ``BANDS`` bands, whose values are bucket
   keys, half as single bytes for inference.
2. *Pruning.* Texts of one bucket are compared byte by byte in rounds. After each round the pairs go whose
   posterior probability of reaching the threshold, given the matches so far and a uniform prior, is below
   ``TOLERANCE``. Survivors link a bucket's texts to groups; a bucket reports a spanning forest, not pairs.
3. *Verification.* Connected groups of survivors are compared exactly on their shingle sets (64-bit
   numbers of the shingles), all pairs of a group, and the links counted.

Buckets and groups larger than a block are cut into blocks and compared block by block, each pair of blocks
a work item of its own; what leaves a work item is one row per text. No bucket is dropped or capped.
A pair of similarity exactly 0.8 shares no bucket with probability ``(1 - 0.8**4)**16`` = 2.2e-4, more
similar pairs with less; pruning loses about ``TOLERANCE`` of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.components import components
from ridelake.llm.shared import free_names, python_tasks, stored
from ridelake.llm.shingles import WordNumbers, groups, mixed, shingles, stars, tokens

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 16, 4
INFERENCE = 64
ROUND = 8
TOLERANCE = 1e-4
# Texts, and shingles, of one block. A work item holds two blocks: some 64 MB.
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 2_000_000

_draw = np.random.default_rng(20240601)
_HASHES = BANDS * BAND_ROWS + INFERENCE
_MULTIPLY = _draw.integers(0, 2**63, _HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _draw.integers(0, 2**63, _HASHES, np.uint64)


def least_matches(threshold: float, tolerance: float, hashes: int = INFERENCE, step: int = ROUND) -> list[int]:
    """For each round the fewest matches with which a pair goes on."""
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256  # bytes of different values agree once in 256
    fewest = []
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() / weight.sum() >= tolerance:
                break
        fewest.append(m)
    return fewest


def minhash(values: np.ndarray) -> np.ndarray:
    least = np.full(_HASHES, np.iinfo(np.uint64).max)
    for start in range(0, len(values), 512):
        least = np.minimum(least, (values[start:start + 512, None] * _MULTIPLY + _ADD).min(axis=0))
    return least


def text_node(text: str | None, words: list[str]) -> bytes:
    """Digest of the words, or of the whole text where it has none."""
    said = " ".join(words) if words else "\n" + (text or "")
    return hashlib.md5(said.encode("utf-8", "surrogatepass")).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = WordNumbers()
    seeds = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        nodes, counts, bands, bytes_ = [], [], [], []
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            nodes.append(text_node(text, words))
            found = shingles(numbers.of(words), SHINGLE_WORDS)
            counts.append(len(found))
            if len(found) == 0:
                bands.append([])
                bytes_.append(b"")
                continue
            least = mixed(minhash(found))
            keys = seeds
            for row in least[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).T:
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
            bands.append(keys.view(np.int64))
            bytes_.append((least[BANDS * BAND_ROWS:] >> np.uint64(56)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())],
            ["doc_id", "node", "n_shingles", "bands", "bytes"])


def _pruner(fewest: list[int], step: int):
    """Pairs of a bucket's block pair that survive all rounds, as links to the least of what they connect."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["bucket", "first", "second"]):
            nodes = group.column("node").to_pylist()
            own = group.column("own").to_numpy()
            rows = np.frombuffer(b"".join(group.column("bytes").to_pylist()), np.uint8).reshape(len(nodes), -1)
            left, right = np.triu_indices(len(nodes), 1)
            if group.column("first")[0].as_py() != group.column("second")[0].as_py():
                across = own[left] != own[right]
                left, right = left[across], right[across]
            matches = np.zeros(len(left), np.int64)
            for i, least in enumerate(fewest):
                at = slice(i * step, (i + 1) * step)
                matches += (rows[left, at] == rows[right, at]).sum(axis=1)
                alive = matches >= least
                left, right, matches = left[alive], right[alive], matches[alive]
                if not len(left):
                    break
            label = stars(len(nodes), left, right)
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            if len(moved):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in moved], pa.binary()),
                     pa.array([nodes[i] for i in label[moved]], pa.binary())], ["u", "v"])
    return links


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the texts that are asked for; rows that only share the id of one are left out."""
    numbers = WordNumbers()
    for batch in batches:
        sets, rows = [], []
        for i, (text, node) in enumerate(zip(batch.column("text").to_pylist(), batch.column("node").to_pylist())):
            words = tokens(text)
            if text_node(text, words) == node:
                sets.append(shingles(numbers.of(words), SHINGLE_WORDS).view(np.int64))
                rows.append(i)
        kept = batch.select(["node", "group", "blocks", "copies"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(sets, pa.list_(pa.int64()))], [*kept.schema.names, "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets, by products of 0/1 matrices over slices of columns."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float64)
    width = max(64, 2**21 // n)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        low, high = np.searchsorted(column, [start, start + width])
        matrix = np.zeros((n, width), np.float32)
        matrix[owner[low:high], column[low:high] - start] = 1
        total += matrix @ matrix.T
    return total.astype(np.int64)


def _verifier(threshold: Fraction):
    """Exact links within each block pair: their number for each text, and what they connect."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["group", "first", "second"]):
            nodes, order = np.unique(np.array(group.column("node").to_pylist(), object), return_index=True)
            group = group.take(pa.array(order))  # repeated rows of the same document
            sets = [np.asarray(values, np.int64) for values in group.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            linked = overlaps(sets) * (threshold.denominator + threshold.numerator) >= (
                threshold.numerator * (sizes[:, None] + sizes[None, :]))
            np.fill_diagonal(linked, False)
            if group.column("first")[0].as_py() != group.column("second")[0].as_py():
                own = group.column("own").to_numpy()
                linked &= own[:, None] != own[None, :]
            texts = linked.sum(axis=1)
            documents = linked @ group.column("copies").to_numpy()
            label = stars(len(nodes), *np.nonzero(np.triu(linked)))
            rows = np.flatnonzero(texts)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in rows], pa.binary()),
                     pa.array([nodes[i] for i in label[rows]], pa.binary()),
                     pa.array(texts[rows], pa.int64()), pa.array(documents[rows], pa.int64())],
                    ["u", "v", "texts", "documents"])
    return links


def _by_block_pairs(members: DataFrame, group: str) -> DataFrame:
    """Deal members to block pairs (``first``, ``second``) of their group; ``own`` is a member's block."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (dealt.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
            .drop("other", "blocks").repartition(group, "first", "second")
            .sortWithinPartitions(group, "first", "second"))


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
         block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of ``docs``:

    - ``class_id``: least id among the documents that chains of links connect to this one,
    - ``copy_id``: least id among documents with the same words, ``copies``: their number,
    - ``n_links``: other documents with similarity of ``threshold`` or more, copies included,
    - ``n_text_links``: different texts among them,
    - ``text_node``: digest of the words, ``class_node``: that of one text of the class. They tell apart texts
      and classes of rows that share an id.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    signed = stored(docs.select("doc_id", "text").mapInArrow(
        _sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, n_shingles long,"
               " bands array<long>, bytes binary"), "signed")
    texts = stored(signed.groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("bytes").alias("bytes")), "texts")

    in_buckets = texts.select("node", F.explode("bands").alias("bucket"))
    full = in_buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block_texts)).cast("int").alias("blocks")
    members = in_buckets.join(full, "bucket").select("node", "bucket", blocks)
    members = members.join(texts.select("node", "bytes"), "node")
    survivors = _by_block_pairs(members, "bucket").mapInArrow(
        _pruner(least_matches(threshold, tolerance), ROUND), "u binary, v binary")
    grouped = components(survivors)

    found = grouped.join(texts.select("node", "copy_id", "copies", "n_shingles"), "node").withColumn(
        "group", F.xxhash64("root"))
    sizes = found.groupBy("group").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(block_texts)), F.ceil(F.sum("n_shingles") / F.lit(block_shingles))
    ).cast("int").alias("blocks"))
    wanted = found.join(sizes, "group").select("node", "group", "blocks", "copies", "copy_id")
    read = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("copy_id")))
    sets = read.select("text", "node", "group", "blocks", "copies").mapInArrow(
        _shingle_sets, "node binary, group long, blocks int, copies long, shingles array<long>")
    verified = stored(_by_block_pairs(sets, "group").mapInArrow(
        _verifier(Fraction(str(threshold))), "u binary, v binary, texts long, documents long"), "verified")

    classes = components(verified.select("u", "v"))
    counts = verified.groupBy(F.col("u").alias("node")).agg(
        F.sum("texts").alias("n_text_links"), F.sum("documents").alias("others"))
    linked = counts.join(classes, "node").join(texts.select("node", "copy_id"), "node")
    named = linked.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    linked = linked.join(named, "root").select("node", "root", "class_id", "n_text_links", "others")
    per_text = texts.select("node", "copy_id", "copies").join(linked, "node", "left").select(
        "node", "copy_id", "copies", F.lower(F.hex(F.coalesce("root", "node"))).alias("class_node"),
        F.when(F.col("root").isNull(), F.col("copy_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "node").join(per_text, "node").select(
        "doc_id", "class_id", "copy_id", "copies", "n_links", "n_text_links", F.lower(F.hex("node")).alias("text_node"),
        "class_node")


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that represent their class: the smallest id, the smallest digest of the words where an
    id has several texts of the class, and one row of those that repeat. Rows meet by id and digest.
    """
    number, node = free_names(docs.columns, "_id", "_node")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_node")).alias("first")
    kept = join(docs, **options).groupBy("class_node").agg(first).select(
        F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias(number),
        F.unhex("first.text_node").alias(node))
    named = docs.withColumns({number: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), node: node_of("text")})
    return named.join(kept, [number, node], "left_semi").dropDuplicates([number, node]).drop(number, node)


def node_of(column: str):
    @pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([text_node(text, tokens(text)) for text in texts], dtype=object)

    return digest(column)
