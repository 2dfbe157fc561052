"""Toxic text by non-negative positive-unlabelled learning.

Known are some toxic documents and very many without a verdict, toxic ones among them. With the class prior
``p`` (the share of toxic documents), the risk of a classifier g over all text can be written without negative
examples: ``p E⁺[l(g)] + (Eᵘ[l(-g)] - p E⁺[l(-g)])``. The bracket estimates the risk on negatives and cannot
truly be below zero; when a batch makes it so, the step goes the other way instead of fitting the positives by heart.

*Evidence.* A text shows its words and their stems (the first 3 to 9 letters, so that inflected forms count). How
many toxic and how many unlabelled training documents show a stem is counted; by the prior this gives the chance that a
document with the stem is toxic, of which the lower confidence bound is the stem's evidence. Stems are used from
``LEAST_EVIDENCE`` on; they must be in ``LEAST_DOCUMENTS`` positives and in a share ``LEAST_SHARE`` of them, which bounds their
number at any size of the corpus. There is no other limit.

*Counting.* All positives are counted first. A stem that enough of them have is a candidate unless its evidence is out of
reach: the bound falls with the number of unlabelled documents, and a random pilot of about ``PILOT`` documents tells at least
how many these are, by six standard deviations (a stem is passed over wrongly once in a thousand millions). That takes
out the common words. All documents are read once and leave the numbers of the candidates that they show; of those of the
training documents the candidates are counted exactly, each task adding up an array of one number for each. What then has evidence is final;
the folds, the fit and the scores work on the numbers of these few stems.

*Classifier.* Linear over a few numbers of a text: how many of its stems have how much evidence, and the largest.
Its training documents were counted as well, so each gets the evidence counted in the other ``FOLDS - 1`` folds. The risk
is taken over all training documents: those with similar counts are added up to one cell (mean and number), of which
there are at most ``CELLS``, so what the driver fits on does not grow with the corpus.

Positives are documents marked toxic outside the held-out fifth; unlabelled are all documents outside it, marked or
not. The prior is the share of toxic marks among all marks of the training fold unless it is given. Scoring covers every
whole text. Null and empty texts show nothing. Rows that share an id share its mark, each a document of its own; an
id marked several times is toxic if any mark says so. Null ids are never positive. Without positives, or with empty
tables, all scores are 0 (less than 1e-200). Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.shared import python_tasks, stored
from ridelake.llm.shingles import tokens

PILOT, DEVIATIONS = 20_000, 6
STEMS = range(3, 10)
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_EVIDENCE = 3, 1e-5, 0.25
FOLDS = 5
SEED = 11
# Ids up to this number are sent to all tasks, so that texts need not be shuffled to find those of the ids; beyond,
# Spark joins as it sees fit.
MAX_BROADCAST = 1_000_000
LEVELS = np.array([0.25, 0.35, 0.45, 0.55, 0.65, 0.75])
# Classes of a count (0, 1, 2 to 3, more) for each level, and of the number of words (by powers of two).
COUNT_CLASSES, WORD_CLASSES = 4, 24
CELLS = COUNT_CLASSES ** len(LEVELS) * WORD_CLASSES
# Counts of so many candidates go in one row; tasks' rows are first added up in so many parts.
BLOCK, PARTS = 4096, 64
STEPS, RATE, DECAY = 800, 0.05, 3e-3
# What a beginning of a word is if it is not itself a known stem.
ON_THE_WAY, UNKNOWN = -1, -2
# What goes with the numbers of a document's stems.
ROW = ("doc_id", "held_out", "fold")


class Stems(dict):
    """What a word shows. Remembers words."""

    LIMIT = 100_000

    def __missing__(self, word: str) -> tuple:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = (f"={word}", *(word[:k] for k in STEMS if k <= len(word)))
        return found

    def of(self, words) -> set:
        found: set = set()
        for word in words:
            found.update(self[word])
        return found


class Known:
    """Which of some stems texts show, by their numbers. Each word of a batch of texts is looked up once, and no
    further than known stems begin like it; the texts' numbers are then put together in arrays."""

    def __init__(self, stems: list[str]):
        self.size = len(stems)
        self.words, self.starts = {}, {}
        for number, stem in enumerate(stems):
            if stem[0] == "=":
                self.words[stem[1:]] = number
                continue
            for k in range(STEMS[0], len(stem)):
                self.starts.setdefault(stem[:k], ON_THE_WAY)
            self.starts[stem] = number

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that show a stem, and its number: a pair for each."""
        def pairs(numbers: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return place[numbers >= 0], numbers[numbers >= 0]

        place = np.arange(len(words))
        found = [pairs(np.fromiter(map(self.words.get, words, repeat(UNKNOWN)), np.int64, len(words)), place)]
        for k in STEMS:
            starts = [word[:k] for word in words]
            numbers = np.fromiter(map(self.starts.get, starts, repeat(UNKNOWN)), np.int64, len(words))
            found.append(pairs(numbers, place))
            on = [number != UNKNOWN and len(word) > k for number, word in zip(numbers.tolist(), words)]
            words, place = list(compress(words, on)), place[on]
        return tuple(np.concatenate(x) for x in zip(*found))

    def of(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text its number of different words, and where its stems' numbers start in the third array."""
        said = [set(tokens(text)) for text in texts]
        n_words = np.fromiter(map(len, said), np.int64, len(said))
        words = list(set().union(*said))
        code = dict(zip(words, range(len(words))))
        word = np.fromiter(map(code.__getitem__, chain.from_iterable(said)), np.int64, n_words.sum())
        owner = np.repeat(np.arange(len(said)), n_words)
        place, numbers = self.of_words(words)
        numbers = numbers[np.argsort(place, kind="stable")]
        sizes = np.bincount(place, minlength=len(words))
        some = sizes[word] > 0
        word, owner = word[some], owner[some]
        many = sizes[word]
        at = np.repeat((np.cumsum(sizes) - sizes)[word] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        owner, numbers = np.divmod(np.unique(np.repeat(owner, many) * self.size + numbers[at]), max(self.size, 1))
        return n_words, np.searchsorted(owner, np.arange(len(said) + 1)), numbers


def evidence(p, u, n_positive, n_unlabelled, prior: float):
    """Lower bound of the chance that a document with a stem is toxic."""
    p, u = np.asarray(p, float), np.asarray(u, float)
    chance = prior * (p / n_positive) / np.maximum(u / n_unlabelled, 1e-12)
    bound = chance * np.exp(-1.64 * np.sqrt(1 / np.maximum(p, 1) + 1 / np.maximum(u, 1)))
    return np.where(p >= least_documents(n_positive), np.minimum(bound, 1.0), 0.0)


def least_documents(n_positive: float) -> float:
    return max(LEAST_DOCUMENTS, LEAST_SHARE * n_positive)


def measures(found: np.ndarray, words: int) -> np.ndarray:
    counts = np.bincount(np.searchsorted(LEVELS, found, "right"), minlength=len(LEVELS) + 1)[1:]
    return np.concatenate([
        np.log1p(counts), counts > 0, counts / np.sqrt(words + 1), [found.max(initial=0.0)]])


N_MEASURES = 3 * len(LEVELS) + 1


def cell(found: np.ndarray, words: int) -> int:
    counts = np.bincount(np.searchsorted(LEVELS, found, "right"), minlength=len(LEVELS) + 1)[1:]
    number = min(int(words).bit_length(), WORD_CLASSES - 1)
    for n in np.searchsorted([1, 2, 4], counts, "right").tolist():
        number = number * COUNT_CLASSES + n
    return number


@dataclass
class Model:
    known: dict[str, float]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    @cached_property
    def stems(self) -> Known:
        return Known(list(self.known))

    def score(self, texts) -> np.ndarray:
        return self.score_numbers(*self.stems.of(list(texts)))

    def score_numbers(self, n_words: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Scores of texts by what ``Known.of`` says of them."""
        worth = np.array(list(self.known.values()), float)
        rows = [measures(worth[numbers[low:high]], n) if low < high else NO_MEASURES
                for n, low, high in zip(n_words.tolist(), starts.tolist(), starts[1:].tolist())]
        x = (np.array(rows).reshape(-1, N_MEASURES) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -500, 500)))


NO_MEASURES = np.zeros(N_MEASURES)
NOTHING_KNOWN = Model({}, np.zeros(N_MEASURES), np.ones(N_MEASURES), np.zeros(N_MEASURES), -1e3)


def held_out() -> Column:
    """Fixed by the contract: whether a document's label may not be learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of all stems by fold within a task, handed on whenever they have become many."""
    def handed_on(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array([x for c in counts for x in c], pa.string()),
             pa.array([fold for fold, c in enumerate(counts) for _ in c], pa.int32()),
             pa.array([n for c in counts for n in c.values()], pa.int64())], ["stem", "fold", "n"])

    stems, counts = Stems(), [Counter() for _ in range(FOLDS)]
    for batch in batches:
        for text, fold in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist()):
            counts[fold].update(stems.of(set(tokens(text))))
            if sum(map(len, counts)) > 400_000:
                yield handed_on(counts)
                counts = [Counter() for _ in range(FOLDS)]
    yield handed_on(counts)


def _shown(sent):
    """The numbers of the candidates that each document shows, and its number of different words."""
    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems = Known(sent.value)
        for batch in batches:
            n_words, starts, numbers = stems.of(batch.column("text").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(numbers, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ROW], pa.array(n_words, pa.int32()), ids], [*ROW, "words", "ids"])
    return shown


def _in_cells(others: np.ndarray):
    """Sums of the measures of the documents of each side and cell within a task."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for side, fold, words, ids in zip(*[batch.column(c).to_pylist() for c in ("side", "fold", "words", "ids")]):
                found = others[fold][ids]
                key, x = (side, cell(found, words)), np.append(measures(found, words), 1.0)
                sums[key] = sums[key] + x if key in sums else x
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in sums], pa.int32()) for i in (0, 1)]
            + [pa.array(list(sums.values()), pa.list_(pa.float64()))], ["side", "cell", "x"])
    return added


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, n_positive: np.ndarray,
        n_unlabelled: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over the corrected risk with the logistic loss, whose slope does not vanish
    for positives that are still far on the wrong side. Rows count as often as ``n_`` says."""
    positive, unlabelled = (np.c_[x, np.ones(len(x))] for x in (positive, unlabelled))
    size = positive.shape[1] - 1
    w, first, second = (np.zeros(size + 1) for _ in range(3))  # the last entry is the bias
    shares = [n / n.sum() for n in (n_positive, n_unlabelled)]

    def mean_slope(x: np.ndarray, share: np.ndarray, sign: int) -> tuple[float, np.ndarray]:
        """Mean loss log(1 + exp(-sign g)), and its gradient."""
        margin = sign * (x @ w)
        return float(share @ np.logaddexp(0, -margin)), -sign * ((share / (1 + np.exp(np.clip(margin, -60, 60)))) @ x)

    for step in range(1, STEPS + 1):
        _, as_positive = mean_slope(positive, shares[0], 1)
        p_negative, p_slope = mean_slope(positive, shares[0], -1)
        u_negative, u_slope = mean_slope(unlabelled, shares[1], -1)
        if u_negative - prior * p_negative >= 0:
            slope = prior * as_positive + u_slope - prior * p_slope
        else:
            slope = prior * p_slope - u_slope
        slope[:size] += DECAY * w[:size]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def candidates(docs: DataFrame, toxic: DataFrame, prior: float, n_positive: int, n_unlabelled: int) -> list[tuple[str, int]]:
    """The stems whose evidence may suffice, in order, with the number of positives that show them. ``docs`` are those to learn from, ``toxic`` ids of positives."""
    fold = F.lit(0).alias("fold")

    def stems_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("text", fold).mapInArrow(_stem_counts, "stem string, fold int, n long").groupBy("stem").agg(
            F.sum("n").alias(name))

    sent = F.broadcast(toxic) if toxic.count() <= MAX_BROADCAST else toxic
    positive = stored(stems_of(docs.join(sent, "doc_id"), "p").where(
        F.col("p") >= least_documents(n_positive)), "toxicity-positive")
    share = min(1.0, PILOT / n_unlabelled)
    pilot = stems_of(docs.where(F.rand(SEED) < share), "k").join(positive.select("stem"), "stem", "left_semi")
    p, k = F.col("p").cast("double"), F.coalesce("k", F.lit(0)).cast("double")
    u = F.greatest(p, (k - DEVIATIONS * F.sqrt(k + 9)) / share if share < 1 else k)
    # The same bound as in ``evidence``, for the fewest unlabelled documents there can be.
    bound = F.lit(prior * n_unlabelled / n_positive) * p / u * F.exp(F.lit(-1.64) * F.sqrt(1 / p + 1 / u))
    reach = positive.join(pilot, "stem", "left").where(bound >= LEAST_EVIDENCE * (1 - 1e-9))
    return sorted((row["stem"], row["p"]) for row in reach.select("stem", "p").collect())


def _in_blocks(size: int):
    """How many documents of a task show each candidate: one row for each ``BLOCK`` candidates."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-size // BLOCK) * BLOCK, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("ids").flatten().to_numpy(zero_copy_only=False), minlength=len(total))
        blocks = total.reshape(-1, BLOCK)
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()),
             pa.array(list(blocks), pa.list_(pa.int64()))], ["block", "part", "n"])
    return counted


def _added_up(keys: tuple, table: pa.Table) -> pa.Table:
    n = table.column("n").combine_chunks().flatten().to_numpy().reshape(-1, BLOCK).sum(axis=0)
    return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([n], pa.list_(pa.int64()))})


def with_evidence(numbers: DataFrame, found: list[tuple[str, int]], prior: float, n_positive: int, n_unlabelled: int) -> list[int]:
    """Numbers of the candidates that have evidence, by their counts in all documents. Tasks' arrays are added up in
    two steps, so that no group has more of them than tasks by ``PARTS``."""
    blocks = numbers.select("ids").mapInArrow(_in_blocks(len(found)), "block int, part int, n array<long>")
    blocks = blocks.groupBy("block", "part").applyInArrow(_added_up, "block int, n array<long>")
    blocks = blocks.groupBy("block").applyInArrow(_added_up, "block int, n array<long>").orderBy("block")
    u = np.concatenate([row["n"] for row in blocks.toLocalIterator()])[:len(found)]
    known = evidence([p for _, p in found], u, n_positive, n_unlabelled, prior)
    return np.flatnonzero(known >= LEAST_EVIDENCE).tolist()


def _renumbered(kept: list[int], size: int):
    """The documents' numbers of candidates become those of the kept ones, all others go."""
    def renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(size, -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        for batch in batches:
            lists = batch.column("ids")
            new = place[lists.flatten().to_numpy(zero_copy_only=False)]
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            before = np.concatenate([[0], np.cumsum(new >= 0)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(before[starts.astype(np.int64)]), pa.array(new[new >= 0]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*ROW, "words")], ids], [*ROW, "words", "ids"])
    return renumbered


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    return _learnt(docs.where(~held_out()), labels, prior)[0]


def _learnt(docs: DataFrame, labels: DataFrame, prior: float | None) -> tuple[Model, DataFrame | None]:
    """The model, and by number which of its stems each row of ``docs`` shows, held out or not (none without a model)."""
    spark = docs.sparkSession
    python_tasks(spark)
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    marks, toxic = usable.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return NOTHING_KNOWN, None
    prior = toxic / marks if prior is None else prior
    usable = stored(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxicity-marks")
    docs = docs.select("doc_id", "text")
    training = docs.where(~held_out())
    marked = usable.where("toxic = 1").select("doc_id", F.lit(1).alias("side"))
    n_u, n_p = training.count(), training.select("doc_id").join(marked, "doc_id").count()
    if not n_p:
        return NOTHING_KNOWN, None
    found = candidates(training, marked.select("doc_id"), prior, n_p, n_u)
    if not found:
        return NOTHING_KNOWN, None
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    shown = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, fold int, words int,"
             " ids array<int>")
    sent = spark.sparkContext.broadcast([stem for stem, _ in found])
    numbers = stored(docs.select("doc_id", held_out().alias("held_out"), fold, "text").mapInArrow(_shown(sent), shown), "toxicity-numbers")
    kept = with_evidence(numbers.where("NOT held_out"), found, prior, n_p, n_u)
    if not kept:
        return NOTHING_KNOWN, None
    stems = [found[i][0] for i in kept]
    numbers = stored(numbers.mapInArrow(_renumbered(kept, len(found)), shown), "toxicity-evidence")
    marked = F.broadcast(marked) if toxic <= MAX_BROADCAST else marked
    rows = numbers.where("NOT held_out").join(marked, "doc_id", "left").select(
        F.coalesce("side", F.lit(0)).alias("side"), "fold", "words", "ids")
    n, counts = np.zeros((FOLDS, 2)), np.zeros((len(stems), FOLDS, 2))
    for row in rows.groupBy("fold", "side").count().collect():
        n[row["fold"], row["side"]] = row["count"]
    for row in rows.select("side", "fold", F.explode("ids").alias("id")).groupBy("id", "fold", "side").count().toLocalIterator():
        counts[row["id"], row["fold"], row["side"]] = row["count"]
    for c in (n, counts):  # positives are unlabelled documents as well
        c[..., 0] += c[..., 1]
    total, every = counts.sum(axis=1), n.sum(axis=0)
    known = evidence(total[:, 1], total[:, 0], every[1], every[0], prior)
    others = np.array([evidence(
        *(total - counts[:, k])[:, ::-1].T, max(every[1] - n[k, 1], 1), max(every[0] - n[k, 0], 1), prior)
        for k in range(FOLDS)])

    cells = rows.where(F.size("ids") > 0).mapInArrow(_in_cells(others), "side int, cell int, x array<double>")
    parts = [F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(N_MEASURES + 1)]
    held = cells.groupBy("side", "cell").agg(*parts).collect()  # at most CELLS for each side
    sums = {side: [[row[f"x{i}"] for i in range(N_MEASURES + 1)] for row in sorted(held, key=lambda r: r["cell"])
                   if row["side"] == side] for side in (0, 1)}
    for row in rows.where(F.size("ids") == 0).groupBy("side").count().collect():
        sums[row["side"]].append([*NO_MEASURES, row["count"]])
    sums[0] += sums[1]
    (x_p, n_p), (x_u, n_u) = [((c := np.array(sums[side]))[:, :-1] / c[:, -1:], c[:, -1]) for side in (1, 0)]
    centre = n_u @ x_u / n_u.sum()
    scale = np.sqrt(n_u @ (x_u - centre) ** 2 / n_u.sum()) + 1e-3
    weights, bias = fit((x_p - centre) / scale, (x_u - centre) / scale, prior, n_p, n_u)
    return Model(dict(zip(stems, known.tolist())), centre, scale, weights, bias), numbers


def scorer(model: Model):
    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts), dtype="float64")

    return score


def _scored_numbers(model: Model):
    def scored_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            starts = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            score = model.score_numbers(
                batch.column("words").to_numpy(), starts, ids.flatten().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "score"])
    return scored_numbers


def _judged(scores: DataFrame) -> DataFrame:
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    python_tasks(docs.sparkSession)
    return _judged(docs.select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score")))


def train_and_score(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """``scored(docs, train(docs, labels))`` without reading the texts again: held-out documents leave the numbers of
    their stems when those to learn from do, and their scores come from these. Nothing is learnt from them."""
    model, numbers = _learnt(docs, labels, prior)
    if numbers is None:
        return scored(docs, model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _judged(numbers.mapInArrow(_scored_numbers(model), f"doc_id {kind}, held_out boolean, score double"))
