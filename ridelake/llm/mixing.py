"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

*Targets.* Sources in code-point order (null last) weigh 3, 1, 2, repeating, and share ``SHARE`` times all
words. No source gives more than ``MOST_PASSES`` times its words: what is above that is shared again by
weight until none is above. Each round reads the table of sources and hands two numbers to the driver.

*Curriculum.* Training time runs from 0 to 1. A source with slope ``a`` is drawn at time t with density
``1 + a (1 - 2t)``, early for positive slopes, late for negative ones. Its integral
``D(t) = target (t + a (t - t²))`` is the source's cumulative demand for words. Documents of a source queue
in the order of a keyed digest; a document that starts after c words of its source's queue stands at the time
``t`` with ``D(t) = c``, the root of that quadratic. A queue that ends before its demand starts again
(second pass); where the demand ends within a document, only that many of its words are taken.

*Range-sort.* Documents are sorted by position over range partitions; no task sees a whole source.
Repeated rows are separate documents that queue one behind the other. Sizes of 0 take nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import free_names, in_ranges, running_sum, stored, whole, words_in

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
SLOPES = (0.5, 0.0, -0.5)
SEED = "mix-1"
# Names that ``mix`` gives on the way.
_INNER = ("size", "source_size", "target", "taken", "position", "second_position", "slope", "_queue", "_part", "_start", "_name")


def _cycled(rank, values) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, share: float = SHARE,
                   most_passes: int = MOST_PASSES) -> DataFrame:
    """source, source_size, target, slope from rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).alias("_one"))
    ranged = in_ranges(totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "sources")
    ranked = running_sum(ranged, None, ["_last", "source"], "_one", "rank")
    ranked = stored(ranked.select(
        "source", "source_size", _cycled(F.col("rank"), weights).cast("double").alias("weight"),
        _cycled(F.col("rank"), slopes).cast("double").alias("slope"),
        (F.col("source_size") * most_passes).alias("most")), "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        n, given, weight = ranked.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not weight:
            break
        capped, level = n, (share * total - (given or 0)) / weight
    full = F.col("most") <= F.lit(level) * F.col("weight")
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"), "slope")


def position(consumed, target, slope) -> F.Column:
    """The time at which a source's cumulative demand reaches ``consumed`` words."""
    q = consumed / target
    rise = F.lit(1.0) + slope
    root = (rise - F.sqrt(rise * rise - F.lit(4.0) * slope * q)) / (F.lit(2.0) * slope)
    return F.when(slope == 0, q).otherwise(root + F.lit(0.0))  # no negative zero


def mix(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), seed: str = SEED, **targets) -> DataFrame:
    """``keys`` and size, source_size, target, taken, position, second_position of every row.

    ``position`` and ``second_position`` are null for passes in which the document gives no word.
    """
    sizes = stored(docs.select(
        *keys, "source", words_in(whole("text")).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("_queue")), "sizes")
    sources = stored(source_targets(sizes, **targets), "targets").withColumnRenamed("source", "_name")
    order = ["source", "_queue", *keys, "size"]
    queued = running_sum(in_ranges(sizes, order, "queues"), "source", order, "size", "_start")
    # One row for each source, joined by null-safe equality; Spark broadcasts it only while it is small.
    joined = queued.join(sources, F.col("source").eqNullSafe(F.col("_name")))
    demand = F.round("target").cast("long")
    start = [F.col("_start"), F.col("_start") + F.col("source_size")]
    given = [F.greatest(F.lit(0), F.least(demand - s, F.col("size"))) for s in start]
    at = [F.when(g > 0, position(s.cast("double"), F.col("target"), F.col("slope"))) for s, g in zip(start, given)]
    return joined.select(
        *keys, "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (given[0] + given[1]).cast("long").alias("taken"), at[0].alias("position"),
        at[1].alias("second_position"))


def curriculum(docs: DataFrame, **targets) -> DataFrame:
    """The rows of ``docs`` in training order, once for each pass that takes words of them, with
    train_position, train_pass (1 or 2). Rows equal in all columns are one document to train on, at all
    positions they get. Columns of the table that have these two names are replaced; all others are carried."""
    docs = docs.drop("train_position", "train_pass")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one, two, at = free_names([*docs.columns, *_INNER], "_h1", "_h2", "_at")
    keyed = docs.withColumns({one: F.xxhash64(*columns), two: F.hash(F.lit("row"), *columns)})
    places = mix(keyed, keys=("doc_id", one, two), **targets).select(
        one, two, F.explode(F.array(
            F.struct(F.lit(1).alias("train_pass"), F.col("position").alias("train_position")),
            F.struct(F.lit(2).alias("train_pass"), F.col("second_position").alias("train_position"))
        )).alias(at)).where(F.col(f"{at}.train_position").isNotNull()).select(one, two, f"{at}.*")
    return keyed.dropDuplicates().join(places, [one, two]).select(
        *columns, "train_position", "train_pass").orderBy("train_position", "doc_id", "train_pass")
