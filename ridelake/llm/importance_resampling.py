"""Documents resampled towards a target distribution, by importance weights and parallel sorting by regular sampling.

*Weights.* Features are runs of 1 to ``LONGEST_RUN`` words (letters A-Z in lower case; ASCII letters and digits and all
characters beyond ASCII make words), hashed to ``BUCKETS`` buckets by the CRC-32 of their bytes. All documents and all
target texts are counted; the log ratio of a bucket's smoothed shares, in thousandths and rounded down, is its gain. A
document's weight is the mean gain of its features, rounded down; repeats count, and no features weigh 0. Gains are one
array of ``BUCKETS`` numbers, so a batch of texts is scored by array look-ups.

*Draw.* Weight plus Gumbel noise of the id's digest is the score: the highest ones are a sample without replacement
in proportion to the weights. Of the N documents with ``LEAST_WORDS`` words or more, floor(``SHARE`` % of N) are drawn.

*Ranks*, by sorting in parallel with regular samples (Shi, Schaeffer). The key is score (high first), id (null last)
and place, which tells equal rows apart, so no key is ever heavy.

1. Each task sorts its rows: a run, stored.
2. Every ``n / MOST_SAMPLES``-th row of each run is a sample; sorted, they give regular splitters.
3. The runs' segments between splitters are exchanged and merged, a segment in one task. A segment has at most
   rows / segments + runs x (distance of samples) rows, whatever the distribution.
4. Counts of the segments before, added up, turn places in a segment into exact ranks. Segments beyond the draw are
   neither exchanged nor sorted.

Null texts have no features. Null ids take part with the digest of the bare seed. Repeated rows are documents of their
own, each with its rank. Ids are integers. An empty table gives an empty result; without target texts the gains still
are defined (t = T = 0). Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.shared import python_tasks, stored

# Fixed by the contract of the query.
LONGEST_RUN = 1
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 10
SEED = 2024

# Samples on the driver (25 bytes each), and rows meant for one segment.
MOST_SAMPLES = 200_000
SEGMENT_ROWS = 4_000_000
LEAST_SEGMENTS = 16
_PLACE_BITS = 33  # of monotonically_increasing_id, below the number of the task

# Fixed by the contract: all ASCII but letters and digits separates words.
_APART = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_APART).lower().split()


class Buckets(dict):
    """Bucket of a feature; forgets all when it has become large."""

    LIMIT = 200_000

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def features_of(text: str | None, longest: int) -> list[bytes]:
    words = words_of(text)
    found = list(words)
    for width in range(2, longest + 1):
        found += [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    return found


def _count(longest: int, buckets: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                numbers = np.fromiter(map(of.__getitem__, found := features_of(text, longest)), np.int64, len(found))
                total += np.bincount(numbers, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])
    return counted


def bucket_counts(texts: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket. A task sends one row for each bucket it has, and so does Spark to the driver."""
    python_tasks(texts.sparkSession)
    counts = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(_count(longest, buckets), "bucket int, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = source.astype(float), target.astype(float)
    buckets = float(len(s))
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(gain: np.ndarray, longest: int):
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Buckets(len(gain))
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column("text").to_pylist():
                found = features_of(text, longest)
                numbers = np.fromiter(map(of.__getitem__, found), np.int64, len(found))
                # n words make n + (n - 1) + ... features.
                words.append(len(found) if longest == 1 else len(words_of(text)))
                features.append(len(found))
                weights.append(int(gain[numbers].sum()) // len(found) if found else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (words, features, weights)]],
                ["doc_id", "n_words", "n_features", "weight"])
    return weighed


def noise(seed: int) -> Column:
    """Gumbel noise of a document, in thousandths, from the first 32 bits of a digest of its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, target: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _weigh(gain, longest), f"doc_id {kind}, n_words long, n_features long, weight long").withColumn(
        "score", (F.col("weight") + noise(seed)).cast("long"))


def _keys(score: np.ndarray, ids: np.ndarray, lost: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Sort keys as bytes: score descending, ids ascending with nulls last, place."""
    out = np.empty(len(score), [("s", ">u8"), ("l", "u1"), ("i", ">u8"), ("p", ">u8")])
    flip = np.uint64(1 << 63)
    out["s"] = ~(score.astype(np.int64).view(np.uint64) ^ flip)
    out["l"], out["i"] = lost, ids.astype(np.int64).view(np.uint64) ^ flip
    out["p"] = place
    return out.view("S25")


def _id() -> tuple[Column, Column]:
    """No null may reach numpy, which would turn ids into floats."""
    return F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("lost")


def regular_splitters(runs: DataFrame, rows: int, segments: int, most_samples: int = MOST_SAMPLES) -> np.ndarray:
    """Keys that cut the sorted runs into segments of about equal size."""
    every = max(1, -(-rows // most_samples))
    at = F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    sampled = runs.where(at % every == every // 2).select("score", *_id(), "place").toPandas()
    keys = np.sort(_keys(*[sampled[c].to_numpy() for c in ("score", "id", "lost", "place")]))
    return keys[[len(keys) * i // segments for i in range(1, segments)]] if len(keys) else keys


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, share: int = SHARE, segments: int | None = None,
         most_samples: int = MOST_SAMPLES) -> DataFrame:
    """The rows of ``scored`` with rank: 1, 2, 3... by descending score for those drawn, null for all others."""
    python_tasks(scored.sparkSession)
    scored = scored.select("doc_id", "n_words", "n_features", "weight", "score")
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    runs = stored(scored.withColumn("able", able).sortWithinPartitions(
        "able", F.col("score").desc(), F.col("doc_id").asc_nulls_last()).withColumn(
            "place", F.monotonically_increasing_id()), "runs")
    rows = runs.where("able").count()
    wanted = rows * share // 100
    columns = scored.columns
    if not wanted:
        return runs.select(*columns, F.lit(None).cast("long").alias("rank"))
    segments = segments or max(LEAST_SEGMENTS, -(-rows // SEGMENT_ROWS))
    splitters = regular_splitters(runs.where("able"), rows, segments, most_samples)

    @pandas_udf("int")
    def segment(score: pd.Series, ids: pd.Series, lost: pd.Series, place: pd.Series) -> pd.Series:
        keys = _keys(*[x.to_numpy() for x in (score, ids, lost, place)])
        return pd.Series(np.searchsorted(splitters, keys, "right")).astype("int32")

    cut = stored(runs.withColumn("segment", F.when(F.col("able"), segment("score", *_id(), "place"))), "segments")
    sizes = Counter({row["segment"]: row["n"] for row in cut.where("able").groupBy("segment").agg(
        F.count(F.lit(1)).alias("n")).collect()})  # one row for each segment
    before = list(accumulate((sizes[i] for i in range(segments)), initial=0))
    needed = sum(n < wanted for n in before[:segments])  # the first segments hold all that is drawn
    asked = F.col("able") & (F.col("segment") < needed)
    merged = Window.partitionBy("segment").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "place")
    rank = F.element_at(F.array(*[F.lit(n) for n in before[:needed]]), F.col("segment") + 1) + F.row_number().over(merged)
    ranked = cut.where(asked).select(*columns, rank.cast("long").alias("rank"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).unionByName(
        cut.where(~asked).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``."""
    return draw(scores(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")
