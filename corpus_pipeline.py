"""From raw documents to a training mix, stage by stage.

Each stage reads what the one before has written, and the rows it returns have the columns of documents; the last
adds the training position. Stages see all rows: repeated rows, shared or null ids and null texts included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import decontamination, jaccard_join, line_dedup, mixing, quality
from ridelake.llm.shared import benchmark, documents, free_names, labels, stored


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on the labels outside the held-out third, does not reject.
    Rows are judged one by one: repeated ones stay or go together. Null and empty texts are judged as they are. A score of
    exactly 0.5 stays, as all rows do without labels."""
    model = quality.train(docs, labels(spark, sf_dir))
    return docs.where(quality.scorer(model)("text") >= 0.5)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources have. ``n_chars`` follows the text where it changes.
    Repeated rows are cut alike, null and empty texts stay."""
    counts = free_names(docs.columns, *line_dedup.COUNTS)
    done = line_dedup.dedup_lines(docs, counts=tuple(counts))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(
            F.col(counts[2]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that chains of similar ones connect, the one with the smallest id (see ``jaccard_join``). Repeated
    rows are one document, of which one row stays; null ids come last; texts without words are alike if equal."""
    return jaccard_join.one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Repeated rows stay or go together; null and empty texts stay."""
    return decontamination.without_items(docs, benchmark(spark, sf_dir))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as often as its source's target asks. Rows equal in all columns are one
    document at several positions; texts without words are not drawn; null is a source of its own."""
    return mixing.curriculum(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", cut_boilerplate),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

# Trained models and random walks take part in the decisions, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
