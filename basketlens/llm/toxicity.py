"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

Kernel. A word's features are its subsequences of three characters that span at most six, each
weighted by ``DECAY`` to the power of its span, so gaps and inserted characters cost a little and
do not hide a word. The kernel of two words is the scalar product of their features, divided by
the two words' own norms. Punctuation inside a word is dropped, and letters written apart
("t r a s h") count as one word.

Landmarks are words of the training sample: those that tell toxic texts from others best, and the
most frequent ones of the others. A word is described by its kernel values with the landmarks,
whitened by the landmarks' own kernel matrix (Nyström), and a linear machine is fitted on that.
Labels belong to whole texts, so the words that stand for a toxic text are chosen anew in each of
``ROUNDS`` rounds: its highest-scoring one against the highest-scoring ones of clean texts.
A logistic curve over a text's highest word score, the number of words beyond the margin and the
number of its words turns that into a probability.

As every step after the features is linear, a fitted machine collapses into one weight for each
possible subsequence; tasks look these up for whole texts. Fitted in numpy on the driver from at
most ``TRAIN_ROWS`` labelled rows, of which only the distinct words leave the tasks.

Null and empty texts get the score of a text without words; without labels of both classes every
text gets the share of label 1 (0.5 without labels). Every row has a row of the result, equal rows equal ones; an empty table
has none. A row with a null doc_id counts as held out. A text is scored whole by one task, however long.
Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from basketlens.llm.common import held_out, training_texts

TRAIN_ROWS = 6_000
LANDMARKS = 240
DECAY = 0.7
ROUNDS = 4
GAPS = [(a, b) for b in range(2, 6) for a in range(1, b)]  # offsets of the second and third character
CODES = 1 << 18  # three characters of six bits

_DROP, _BLANK = 254, 255
_ASCII = np.full(128, _DROP, dtype=np.uint8)
_ASCII[ord("a") : ord("z") + 1] = np.arange(1, 27)
_ASCII[ord("0") : ord("9") + 1] = np.arange(27, 37)
_ASCII[[9, 10, 11, 12, 13, 32]] = _BLANK


def characters(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Six-bit characters of the whole text and, for each, the number of its word."""
    point = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    code = np.where(point < 128, _ASCII[np.minimum(point, 127)], 37 + point % 27).astype(np.uint8)
    code[(point == 0xA0) | (point == 0x3000) | ((point >= 0x2000) & (point <= 0x200A))] = _BLANK
    code = code[code != _DROP]
    blank = code == _BLANK
    first = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    last = np.flatnonzero(~blank & np.concatenate((blank[1:], [True])))
    single = first == last
    begins = np.ones(len(first), dtype=bool)
    begins[1:] = ~(single[1:] & single[:-1])
    number = np.repeat(np.cumsum(begins) - 1, last - first + 1)
    return code[~blank], number


def occurrences(code: np.ndarray, word: np.ndarray):
    """For each pair of offsets: word, code and weight of all subsequences with these gaps."""
    wide = code.astype(np.int32)
    for a, b in GAPS:
        if len(wide) <= b:
            continue
        same = word[:-b] == word[b:]
        key = (wide[:-b] << 12) | (wide[a : len(wide) - b + a] << 6) | wide[b:]
        yield word[:-b][same], key[same], DECAY ** (b + 1)


def norms(code: np.ndarray, word: np.ndarray, many: int) -> np.ndarray:
    square = np.zeros(many)
    for at, _, weight in occurrences(code, word):
        square += np.bincount(at, minlength=many) * weight**2
    return np.sqrt(np.maximum(square, 1e-12))


def word_scores(code: np.ndarray, word: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Weighted sum of every word's features divided by its norm; 0 for words of under three."""
    many = int(word[-1]) + 1 if len(word) else 0
    total, square = np.zeros(many), np.zeros(many)
    for at, key, weight in occurrences(code, word):
        total += np.bincount(at, table[key], many) * weight
        square += np.bincount(at, minlength=many) * weight**2
    return total / np.sqrt(np.maximum(square, 1e-12))


@dataclass(frozen=True)
class Machine:
    table: np.ndarray  # a weight for each subsequence
    bias: float
    curve: np.ndarray  # logistic weights of summary()

    def summary(self, text: str | None) -> np.ndarray:
        code, word = characters(text)
        return summary(word_scores(code, word, self.table) + self.bias)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.summary(text) @ self.curve, -30, 30))))


def summary(decision: np.ndarray) -> np.ndarray:
    """Of a text's word scores: 1, the highest, how many are beyond the margin, how many words."""
    top = float(decision.max()) if len(decision) else -2.0
    beyond = np.count_nonzero(decision > 0)
    return np.array([1.0, np.clip(top, -2, 2), np.log1p(beyond), np.log1p(len(decision)) / 10])


def _distinct(texts: pa.Array) -> pa.Array:
    rows = []
    for value in texts:
        code, word = characters(value.as_py())
        cut = np.flatnonzero(np.diff(word)) + 1
        rows.append(list({part.tobytes() for part in np.split(code, cut) if len(part) > 2}))
    return pa.array(rows, type=pa.list_(pa.binary()))


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(b"".join(words), dtype=np.uint8)
    return code, np.repeat(np.arange(len(words)), [len(w) for w in words])


class Nystroem:
    """Kernel values with the landmarks, whitened."""

    def __init__(self, landmarks: list[bytes]):
        code, word = _flat(landmarks)
        keys = [key for _, key, _ in occurrences(code, word)]
        self.keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)
        self.at = np.full(CODES, -1)
        self.at[self.keys] = np.arange(len(self.keys))
        own = np.zeros((len(landmarks), len(self.keys)))
        for where, key, weight in occurrences(code, word):
            np.add.at(own, (where, self.at[key]), weight)
        self.own = own / norms(code, word, len(landmarks))[:, None]
        value, vector = np.linalg.eigh(self.own @ self.own.T)
        good = value > 1e-6 * max(value.max(initial=0), 1e-12)
        self.white = vector[:, good] / np.sqrt(value[good])

    def rows(self, words: list[bytes], block: int = 2000) -> np.ndarray:
        out = np.zeros((len(words), self.white.shape[1]))
        for start in range(0, len(words), block):
            part = words[start : start + block]
            code, word = _flat(part)
            found = np.zeros((len(part), len(self.keys)), dtype=np.float32)
            for where, key, weight in occurrences(code, word):
                known = self.at[key] >= 0
                np.add.at(found, (where[known], self.at[key][known]), weight)
            values = (found @ self.own.T) / norms(code, word, len(part))[:, None]
            out[start : start + block] = values @ self.white
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """The machine's weight of each subsequence."""
        table = np.zeros(CODES)
        table[self.keys] = self.own.T @ (self.white @ weights)
        return table


def linear_svm(rows: np.ndarray, sign: np.ndarray, importance: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Squared hinge loss by Newton steps on the rows inside the margin; the last weight is the bias."""
    data = np.hstack([rows, np.ones((len(rows), 1))])
    w = np.zeros(data.shape[1])
    keep = np.eye(len(w))
    keep[-1, -1] = 1e-3
    for _ in range(30):
        inside = sign * (data @ w) < 1
        part, weight = data[inside], importance[inside] * c
        new = np.linalg.solve(keep + part.T @ (part * weight[:, None]), part.T @ (weight * sign[inside]))
        if np.abs(new - w).max() < 1e-8:
            break
        w = (w + new) / 2 if np.abs(new).max() > 1e3 else new
    return w


def logistic(rows: np.ndarray, label: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        hess = rows.T @ (rows * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, rows.T @ (label - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(texts: list[list[bytes]], label: np.ndarray) -> Machine:
    """From the distinct words of every text and the texts' labels."""
    flat_curve = np.zeros(4)
    if not len(label) or label.min() == label.max():
        mean = float(np.clip(label.mean(), 1e-3, 1 - 1e-3)) if len(label) else 0.5
        flat_curve[0] = np.log(mean / (1 - mean))
        return Machine(np.zeros(CODES), 0.0, flat_curve)
    toxic, clean = Counter(), Counter()
    for words, y in zip(texts, label, strict=True):
        (toxic if y else clean).update(words)
    n1, n0 = label.sum(), len(label) - label.sum()

    def stands_out(word: bytes) -> float:
        p1, p0 = toxic[word] / n1, clean[word] / n0
        p = (toxic[word] + clean[word] + 1) / (n1 + n0 + 2)
        return (p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))

    named = sorted((w for w in toxic if toxic[w] > 1), key=lambda w: (-stands_out(w), w))
    common = sorted(clean, key=lambda w: (-clean[w], w))
    landmarks = list(dict.fromkeys(named[: LANDMARKS * 2 // 3] + common[: LANDMARKS // 3]))
    if not landmarks:
        flat_curve[0] = np.log(n1 / n0)
        return Machine(np.zeros(CODES), 0.0, flat_curve)
    space = Nystroem(landmarks)
    order = {w: i for i, w in enumerate(sorted(set(toxic) | set(clean)))}
    words = list(order)
    code, number = _flat(words)
    value = np.array([stands_out(w) for w in words])
    where = [np.array([order[w] for w in text], dtype=np.int64) for text in texts]
    table, bias = np.zeros(CODES), 0.0
    for _ in range(ROUNDS):
        chosen: Counter = Counter()
        for at, y in zip(where, label, strict=True):
            if len(at):
                top = at[np.argsort(-value[at], kind="stable")[: 1 if y else 4]]
                chosen.update((int(i), int(y)) for i in top)
        items = sorted(chosen)
        which = [words[i] for i, _ in items]
        sign = np.array([1.0 if y else -1.0 for _, y in items])
        weight = np.array([float(chosen[item]) for item in items])
        weight[sign > 0] *= weight[sign < 0].sum() / max(1.0, weight[sign > 0].sum())
        w = linear_svm(space.rows(which), sign, weight * len(items) / weight.sum())
        table, bias = space.table(w[:-1]), float(w[-1])
        value = word_scores(code, number, table) + bias
    rows = np.array([summary(value[at]) for at in where])
    return Machine(table, bias, logistic(rows, label.astype(float)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_ROWS) -> Machine:
    """Fit on (doc_id, text) and (doc_id, label), outside the held-out fold only."""
    words = arrow_udf(_distinct, "array<binary>")("text")
    found = training_texts(docs, labels, label, most).select("__key", words.alias("words"), "label").collect()
    found.sort(key=lambda r: r["__key"])
    return fit(
        [sorted(bytes(w) for w in r["words"]) for r in found], np.array([r["label"] for r in found], dtype=np.int64)
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5 on) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def scored(texts: pa.Array) -> pa.Array:
        machine = shared.value
        return pa.array([machine.score(value.as_py()) for value in texts], type=pa.float64())

    found = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), arrow_udf(scored, "double")("text").alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
