"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics are computed by Spark tasks. Trees are grown by Spark ML from all labelled rows outside the
held-out fold, over the bin numbers of their statistics; the bounds of the bins are quantiles of all these rows.
Rows stay in the tasks: bounds and trees are all that reaches the driver. A fitted model is a handful of
arrays (every tree a complete binary tree), which tasks walk for all rows and all trees of a batch at once.

A null text counts as an empty one and gets a score like any other text. Without labels, or with
labels of one class only, every text gets the share of label 1 (0.5 without labels). Every row has a row of the result,
equal rows equal ones; an empty table has none. A row with a null doc_id counts as held out. A text's statistics are
those of all of it, taken by one task. Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from basketlens.llm.common import held_out, labelled_keys
from basketlens.operators.staging import shared_folder, staged

TREES, DEPTH, RATE, BINS, LEAST = 120, 4, 0.1, 64, 8
PART_ROWS = 100_000  # labelled rows to fill a partition while trees grow: each level of each tree is a shuffle of its own
THRESHOLD = 0.3  # a text is accepted from this score on

FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "top_word", "repeated_next",
    "upper", "digits", "punctuation", "space", "beyond_ascii", "log_lines", "distinct_lines",
    "line_length", "ends_in_symbols", "symbols_per_word", "entropy", "upper_pairs", "alone",
)

_UPPER, _LOWER, _DIGIT, _SPACE, _PUNCT, _BEYOND = range(6)
_CLASS = np.full(256, _PUNCT, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[128:] = _BEYOND
_SENTENCE = np.frombuffer(b".,;:'\"-()?", dtype=np.uint8)


def statistics(text: str | None) -> np.ndarray:
    """The numbers of :data:`FEATURES` for one whole text."""
    out = np.zeros(len(FEATURES), dtype=np.float32)
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    if not raw.size:
        return out
    by_byte = np.bincount(raw, minlength=256)
    share = np.bincount(_CLASS, weights=by_byte, minlength=6) / raw.size
    words, lines = text.split(), text.split("\n")
    counts = Counter(words)
    n = max(1, len(words))
    filled = [line for line in lines if line]
    seen = by_byte[by_byte > 0] / raw.size
    symbols = by_byte[_CLASS == _PUNCT].sum() - by_byte[_SENTENCE].sum()
    kind = np.full(raw.size + 2, _SPACE, dtype=np.uint8)
    kind[1:-1] = _CLASS[raw]
    space, upper = kind == _SPACE, kind == _UPPER
    out[:] = (
        np.log1p(raw.size),
        np.log1p(len(words)),
        (raw.size - by_byte[_CLASS == _SPACE].sum()) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        share[_UPPER],
        share[_DIGIT],
        share[_PUNCT],
        share[_SPACE],
        share[_BEYOND],
        np.log1p(len(lines)),
        len(set(filled)) / max(1, len(filled)),
        np.log1p(raw.size / len(lines)),
        np.count_nonzero((kind[:-1] == _PUNCT) & space[1:]) / n,
        symbols / n,
        -(seen * np.log2(seen)).sum(),
        np.count_nonzero(upper[:-1] & upper[1:]) / n,
        np.count_nonzero(space[:-2] & ~space[1:-1] & space[2:]) / n,
    )
    return out


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: inner nodes by level, then leaves."""

    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)
    start: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        if not len(self.leaf):
            return total
        depth = int(np.log2(self.leaf.shape[1]))
        tree = np.arange(len(self.leaf))[None, :]
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            node = np.zeros((len(part), len(self.leaf)), dtype=np.int64)
            row = np.arange(len(part))[:, None]
            for _ in range(depth):
                right = part[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total[at : at + 4096] += self.leaf[tree, node - (2**depth - 1)].sum(axis=1)
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit(
    rows: np.ndarray, label: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
    bins: int = BINS, ridge: float = 2.0, least: int = LEAST,
) -> Trees:
    """Boost ``trees`` trees on the logistic loss for rows in memory, splits taken between histogram bins."""
    inner, leaves = 2**depth - 1, 2**depth
    empty = np.zeros((0, inner)), np.zeros((0, leaves))
    if not len(label):
        return Trees(empty[0].astype(np.int64), empty[0], empty[1], 0.0)
    mean = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    if label.min() == label.max():
        return Trees(empty[0].astype(np.int64), empty[0], empty[1], start)
    width = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], 1)
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    margin = np.full(len(rows), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = label - p, p * (1 - p)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            local = node - first
            total_g = np.bincount(local, grad, many)
            total_h = np.bincount(local, hess, many)
            best = np.full(many, 1e-9)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                size = len(cuts[f]) + 1
                at = local * size + binned[:, f]
                g, h, n = (
                    np.bincount(at, weights, many * size).reshape(many, size).cumsum(axis=1)[:, :-1]
                    for weights in (grad, hess, None)
                )
                count = np.bincount(local, minlength=many)[:, None]
                other_g, other_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g**2 / (h + ridge) + other_g**2 / (other_h + ridge)
                gain -= (total_g**2 / (total_h + ridge))[:, None]
                gain[(n < least) | (count - n < least)] = 0
                cut = gain.argmax(axis=1)
                found = gain[np.arange(many), cut]
                better = found > best
                best[better] = found[better]
                feature[t, first : first + many][better] = f
                threshold[t, first : first + many][better] = cuts[f][cut[better]]
            right = rows[np.arange(len(rows)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        local = node - inner
        g, h = np.bincount(local, grad, leaves), np.bincount(local, hess, leaves)
        leaf[t] = rate * g / (h + ridge)
        margin += leaf[t, local]
    return Trees(feature, threshold, leaf, start)


def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([statistics(value.as_py()) for value in texts], type=pa.list_(pa.float32()))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(__key, row, label): the statistics of every labelled row outside the held-out fold, one for each key.

    They are computed before the labels are joined, so no text is shuffled. Of rows that share a key the text with the
    smallest hash counts, a null one only if there is no other.
    """
    key, text = F.col("doc_id"), F.col("text")
    hashed = F.when(text.isNotNull(), F.xxhash64(text)).alias("hash")
    known = docs.where(key.isNotNull() & ~held_out(key)).select(
        key.alias("__key"), hashed, arrow_udf(_statistics, "array<float>")(text).alias("row")
    )
    found = known.join(labelled_keys(labels, label), "__key").groupBy("__key").agg(
        F.min_by("row", "hash").alias("row"), F.first("__label").alias("label")
    )
    nothing = F.array_repeat(F.lit(0.0).cast("float"), len(FEATURES))
    return found.select("__key", F.coalesce("row", nothing).alias("row"), "label")


def _complete(model: GBTClassificationModel, cuts: list[np.ndarray], depth: int) -> Trees:
    """The trees over bin numbers as complete trees over the numbers themselves."""
    inner, many = 2**depth - 1, len(model.trees)
    feature = np.zeros((many, inner), dtype=np.int64)
    threshold = np.full((many, inner), np.inf)
    leaf = np.zeros((many, inner + 1))

    def put(t: int, at: int, node, weight: float) -> None:
        if node.subtreeDepth():
            split = node.split()
            feature[t, at] = split.featureIndex()
            threshold[t, at] = cuts[feature[t, at]][int(split.threshold())]
            put(t, 2 * at + 1, node.leftChild(), weight)
            put(t, 2 * at + 2, node.rightChild(), weight)
            return
        while at < inner:  # nothing is beyond an infinite threshold
            at = 2 * at + 1
        leaf[t, at - inner] = weight * node.prediction()

    for t, (weight, tree) in enumerate(zip(model.treeWeights, model.trees, strict=True)):
        put(t, 0, tree._call_java("rootNode"), 2 * weight)  # the library's probability is that of twice the sum
    return Trees(feature, threshold, leaf, 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Trees:
    """Fit on all of (doc_id, text) and (doc_id, label) outside the held-out fold."""
    rows = staged(training_rows(docs, labels, label))
    share = [p / BINS for p in range(1, BINS)]
    bounds = [F.percentile_approx(F.col("row")[i].cast("double"), share).alias(f"c{i}") for i in range(len(FEATURES))]
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"), *bounds).head()
    if not seen["n"] or seen["mean"] in (0, 1):
        mean = min(max(seen["mean"] if seen["n"] else 0.5, 1e-3), 1 - 1e-3)
        none = np.zeros((0, 2**DEPTH - 1))
        return Trees(none.astype(np.int64), none, np.zeros((0, 2**DEPTH)), float(np.log(mean / (1 - mean))))
    cuts = [np.unique(seen[f"c{i}"]) for i in range(len(FEATURES))]

    def binned(many: pa.Array) -> pa.Array:
        values = many.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(np.float64)
        at = np.stack([np.searchsorted(c, values[:, i], side="left") for i, c in enumerate(cuts)], axis=1)
        return pa.array(list(at.astype(np.float64)), type=pa.list_(pa.float64()))

    parts = -(-seen["n"] // PART_ROWS)
    ordered = rows.coalesce(parts).sortWithinPartitions("__key")
    features = array_to_vector(arrow_udf(binned, "array<double>")("row")).alias("features")
    learned = ordered.select(features, F.col("label").cast("double").alias("label")).cache()
    shared_folder(docs.sparkSession)  # the library cuts its lineage there
    try:
        model = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=BINS, minInstancesPerNode=LEAST, seed=7
        ).fit(learned)
    finally:
        learned.unpersist()
    return _complete(model, cuts, DEPTH)


def score_column(model: Trees, text: Column) -> Column:
    """The score of every text, 0 to 1."""

    def scored(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(value.as_py()) for value in texts], dtype=np.float64)
        return pa.array(model.score(rows.reshape(-1, len(FEATURES))))

    return arrow_udf(scored, "double")(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) for every row of ``docs``."""
    model = train(docs, labels)
    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
