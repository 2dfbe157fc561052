"""Text quality by a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; the model is one lookup table for each feature and one for each chosen
pair of features, and a score is the sum of a few table entries. Tables are learnt by cyclic boosting: in
every round each feature in turn gets a shallow tree, fitted to what the others leave unexplained and added
to its table with a small step. Then the pairs that reduce the loss most are chosen and boosted alike.

Training rows are labelled documents outside the held-out third. When there are more than ``MAX_TRAIN``, a
hashed share of about that many is used: their features (22 numbers a row) fit the driver at any size of the
corpus. Scoring covers every whole text. Only the text is an input. Null counts as empty. Without any
labels all scores are 0.5.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ridelake.llm.shared import python_tasks

MAX_TRAIN = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, STEP = 150, 60, 0.1
LEAVES, SHRINK, LEAST_WEIGHT = 4, 1.0, 2.0

SYMBOLS = set("!%$&*#|@~^_=+<>{}[]\\/")
FEATURES = [
    "words", "word_length", "letters", "capitals", "digits", "symbols", "spaces", "variety", "top_word",
    "repeats", "longest_repeat", "symbol_words", "bare_symbols", "capital_words", "short_words", "lines",
    "line_length", "line_copies", "worst_line", "odd_lines", "pair_variety", "entropy"]


def features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n, chars = len(words), max(len(text), 1)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    tops = np.fromiter(counts.values(), np.float64, len(counts))
    share = tops / n
    letters = [w.isalpha() for w in words]
    capital = [w.isupper() and len(w) > 1 for w in words]
    marked = [w[-1] in SYMBOLS or w[0] in SYMBOLS for w in words]
    repeats = longest = run = 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        repeats += a == b
        longest = max(longest, run)
    lines = [line for line in text.split("\n") if line.strip()]
    worst, odd, at = 0.0, 0, 0
    for line in lines:
        size = len(line.split())
        bad = sum(marked[at:at + size]) + sum(capital[at:at + size])
        at += size
        worst = max(worst, bad / size)
        odd += bad > 0.3 * size
    upper = sum(map(str.isupper, text))
    alphabetic = sum(map(str.isalpha, text))
    return [
        np.log1p(n), sum(map(len, words)) / n, alphabetic / chars, upper / max(alphabetic, 1),
        sum(map(str.isdigit, text)) / chars, sum(text.count(s) for s in SYMBOLS) / chars,
        sum(map(str.isspace, text)) / chars, np.log1p(len(counts)) / np.log1p(n), share.max(),
        repeats / n, np.log1p(longest), sum(marked) / n, 1 - sum(any(c.isalnum() for c in w) for w in counts) / len(counts),
        sum(capital) / n, sum(len(w) <= 3 for w in words) / n, np.log1p(len(lines)), np.log1p(chars / len(lines)),
        1 - len(set(lines)) / len(lines), worst, odd / len(lines),
        len(set(zip(words, words[1:]))) / max(n - 1, 1), -(share * np.log(share)).sum() / np.log(n + 1)]


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; place 0 if there is none."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_h = g.sum(), h.sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - all_g**2 / (all_h + SHRINK)
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A step function over the bins with up to ``LEAVES`` leaves, cut where the gain is largest."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        gain, place, (low, high) = max((*_best_cut(g[a:b], h[a:b]), (a, b)) for a, b in leaves)
        if gain <= 1e-9:
            break
        leaves.remove((low, high))
        leaves += [(low, low + place), (low + place, high)]
    out = np.zeros(len(g))
    for low, high in leaves:
        out[low:high] = -g[low:high].sum() / (h[low:high].sum() + SHRINK)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree of depth two on a grid: a cut of the rows, then one of the columns on each side."""
    best, out = 0.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + SHRINK)
    for cut in range(1, len(g)):
        gain, values = -whole, np.zeros_like(g)
        for rows in (slice(0, cut), slice(cut, len(g))):
            side_g, side_h = g[rows].sum(axis=0), h[rows].sum(axis=0)
            more, place = _best_cut(side_g, side_h)
            gain += side_g.sum() ** 2 / (side_h.sum() + SHRINK) + more
            for columns in (slice(0, place), slice(place, g.shape[1])):
                if place or columns.start == 0:
                    columns = columns if place else slice(0, g.shape[1])
                    values[rows, columns] = -side_g[columns].sum() / (side_h[columns].sum() + SHRINK)
        if gain > best:
            best, out = gain, values
    return best, out


@dataclass
class Model:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    """For each feature, the coarse bin of each fine one."""
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            bins = self.bins(x)
            for i, table in enumerate(self.tables):
                total += table[bins[:, i]]
            for i, j, table in self.pairs:
                total += table[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y):
        return Model()
    prior = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(base=float(np.log(prior / (1 - prior))))
    for i in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1]))
        model.edges.append(edges)
        model.tables.append(np.zeros(len(edges) + 1))
        model.coarse.append(np.arange(len(edges) + 1) * PAIR_BINS // (len(edges) + 1))
    bins = model.bins(x)
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            tree = STEP * shallow_tree(np.bincount(bins[:, i], g, len(table)), np.bincount(bins[:, i], h, len(table)))
            table += tree
            total += tree[bins[:, i]]

    coarse = np.stack([c[bins[:, i]] for i, c in enumerate(model.coarse)], axis=1)

    def grid(i: int, j: int):
        cell = coarse[:, i] * PAIR_BINS + coarse[:, j]
        return cell, *[np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in slopes()]

    ranked = sorted(((pair_tree(*grid(i, j)[1:])[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            cell, g, h = grid(i, j)
            tree = STEP * pair_tree(g, h)[1]
            table += tree
            total += tree.ravel()[cell]
    return model


def held_out() -> Column:
    """Fixed by the contract: whether a document's label may not be learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


GRAIN = 2**53


def in_share(share: float, salt: str) -> Column:
    """Whether a document is in a hashed share of all; as fine as a double is."""
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(GRAIN)) < F.lit(int(share * GRAIN))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, excluded: Column, most: int) -> DataFrame:
    """text and label of labelled documents; of many, a hashed share of about ``most`` (its ids are broadcast:
    at most ``most`` pairs of numbers, save for chance)."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~excluded).select("doc_id", label)
    share = min(1.0, most / max(usable.count(), 1))
    drawn = usable.where(in_share(share, "draw"))
    if share < 1 and drawn.isEmpty():
        raise ValueError(f"there are {label} labels, but none was drawn for training")
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Model:
    def measured(batches):
        for batch in batches:
            rows = [features(text) for text in batch["text"]]
            yield pd.DataFrame({"quality": batch["quality"].astype("int64"), "x": rows})

    python_tasks(docs.sparkSession)
    rows = training_rows(docs, labels, "quality", held_out(), most).select("text", "quality").mapInPandas(
        measured, "quality long, x array<double>").toPandas()
    order = np.lexsort(np.stack([np.array(x) for x in rows["x"]]).T) if len(rows) else []
    rows = rows.iloc[order]  # the same model whatever order the rows come in
    return fit(np.array(rows["x"].tolist()).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float))


def scorer(model: Model):
    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(text) for text in texts]).reshape(-1, len(FEATURES))))

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    python_tasks(docs.sparkSession)
    score = docs.select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
