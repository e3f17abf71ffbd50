"""Language identification: averaged hashed subword embeddings under a linear softmax.

Every run of letters, lower-cased and marked at both ends, gives its subwords of 2 and 3
characters; a subword's hash picks an embedding. A text's vector is the average over all its subwords. Embeddings
and softmax are trained together by stochastic gradient descent in numpy on a bounded sample:
at most ``PER_LANGUAGE`` texts of each language, or its part of ``MOST_TEXTS`` where that is less, but no
fewer than ``LEAST_TEXTS``. Languages with fewer texts are taken whole. Rows that agree in doc_id and text count
once, and of equal hashes one text is taken, so ids or texts shared by very many rows do not break the bound. Tasks
send the driver only the subword counts of the sample. For prediction the product of embeddings and softmax, one row
for each bucket, is all that is needed, so a text costs one table lookup for each subword.

Rejection is calibrated on a part of the sample that training has not seen: the lowest score at
which that part reaches ``PRECISION``. Rejected rows keep their best language and are marked.

Texts that are null or have no letter get ``und`` with score 0. If no language was learned, all do.
Every row has a row of the result, equal rows equal ones; an empty table has none. A row with a null doc_id counts as held
out. A text is scored whole by one task, however long. Columns other than doc_id, text and lang are not read, whatever their
names, and lang only for training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from basketlens.llm.common import held_out

BUCKETS = 1 << 14
DIMENSIONS = 16
PER_LANGUAGE = 500
MOST_TEXTS = 4_000
LEAST_TEXTS = 25
PRECISION = 0.99
UNKNOWN = "und"
_SPACE = ord(" ")
_NOT_LETTERS = regex.compile(r"\P{L}+")
_FIRST, _SECOND, _THIRD, _MIX = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))
_SHIFT = np.uint32(32 - 14)


def subwords(text: str | None) -> np.ndarray:
    """Buckets of all subwords of the whole text; empty if it has no letter."""
    words = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not words:
        return np.zeros(0, dtype=np.int64)
    code = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    pair = (code[:-1] * _FIRST) ^ (code[1:] * _SECOND)
    triple = (pair[:-1] * _FIRST) ^ (code[2:] * _THIRD)
    # A mark stands at the ends of a subword only.
    triple = triple[code[1:-1] != _SPACE]
    return np.concatenate(((pair * _MIX) >> _SHIFT, (triple * _MIX) >> _SHIFT)).astype(np.int64)


def _counted(texts: pa.Array) -> pa.Array:
    rows = []
    for value in texts:
        bucket, many = np.unique(subwords(value.as_py()), return_counts=True)
        rows.append({"bucket": bucket.tolist(), "share": (many / max(1, many.sum())).tolist()})
    kind = pa.struct([("bucket", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])
    return pa.array(rows, type=kind)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # (languages, buckets): embeddings times softmax weights
    bias: np.ndarray
    accept: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found = subwords(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        logit = self.bias.copy()
        for i, row in enumerate(self.table):
            logit[i] += row.take(found).sum() / len(found)
        p = np.exp(logit - logit.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _softmax(logit: np.ndarray) -> np.ndarray:
    p = np.exp(logit - logit.max())
    return p / p.sum()


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, languages: list[str],
    epochs: int = 6, rate: float = 2.0, seed: int = 7,
) -> Model:
    """One step of gradient descent for each text and epoch; a fifth is kept for calibration."""
    many = len(languages)
    if not many:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), 0.0)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (BUCKETS, DIMENSIONS))
    out = rng.normal(0, 0.3, (DIMENSIONS, many))
    bias = np.zeros(many)
    order = rng.permutation(len(rows))
    kept = order[: len(rows) // 5] if len(rows) >= 20 * many else order[:0]
    learn = order[len(kept) :]
    steps, total = 0, max(1, epochs * len(learn))
    for _ in range(epochs):
        for i in rng.permutation(learn):
            bucket, share = rows[i]
            now = rate * (1 - steps / total)
            steps += 1
            if not len(bucket):
                continue
            mean = share @ emb[bucket]
            error = _softmax(mean @ out + bias)
            error[label[i]] -= 1
            back = out @ error
            out -= now * 0.5 * np.outer(mean, error)
            bias -= now * 0.05 * error
            emb[bucket] -= now * 20 * np.minimum(share, 0.02)[:, None] * back[None, :]
    table = emb @ out
    p = np.array([_softmax(rows[i][1] @ table[rows[i][0]] + bias) for i in kept]).reshape(-1, many)
    accept = 0.0
    if len(kept):
        score, right = p.max(axis=1), p.argmax(axis=1) == label[kept]
        by_score = np.argsort(-score, kind="stable")
        good = np.cumsum(right[by_score]) / np.arange(1, len(kept) + 1) >= PRECISION
        accept = float(score[by_score[np.flatnonzero(good)[-1]]]) if good.any() else 1.0
    return Model(languages, np.ascontiguousarray(table.T), bias, accept)


def _sample(known: DataFrame) -> DataFrame:
    """lang, mark and text of what to learn from: of each language its part of rows that differ in doc_id or text.

    ``mark`` is a hash of doc_id and text. Rows below a share of its range are taken, a fifth more than wanted as
    different rows are counted by a sketch; of these the lowest marks stay, so the bound holds to the row.
    """
    marked = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("mark"))
    counts = marked.groupBy("lang").agg(F.approx_count_distinct("mark", 0.02).alias("many"))
    each = max(LEAST_TEXTS, min(PER_LANGUAGE, MOST_TEXTS // max(1, counts.count())))
    share = F.shiftrightunsigned("mark", 11).cast("double") / float(1 << 53)
    few = marked.join(F.broadcast(counts), "lang").where(share * F.col("many") < 1.2 * each + 20)
    once = few.groupBy("lang", "mark").agg(F.min("text").alias("text"))
    lowest = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("mark", 11), "mark", "text")
    return once.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= each).drop("place")


def train(docs: DataFrame) -> Model:
    """Learn from text and lang of the rows outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counted = arrow_udf(_counted, "struct<bucket: array<int>, share: array<float>>")("text")
    found = _sample(known).select("mark", "lang", counted.alias("c")).collect()
    found.sort(key=lambda r: (r["mark"], r["lang"]))
    languages = sorted({r["lang"] for r in found})
    at = {name: i for i, name in enumerate(languages)}
    rows = [(np.array(r["c"]["bucket"], dtype=np.int64), np.array(r["c"]["share"])) for r in found]
    return fit(rows, np.array([at[r["lang"]] for r in found], dtype=np.int64), languages)


def predict_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``."""
    model = train(docs)

    def predicted(texts: pa.Array) -> pa.Array:
        rows = [model.predict(value.as_py()) for value in texts]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
            ["lang_pred", "score"],
        )

    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), arrow_udf(predicted, "struct<lang_pred: string, score: double>")("text").alias("p"))
    return found.select(
        "doc_id", "held_out", "p.lang_pred", "p.score", (F.col("p.score") < model.accept).alias("rejected")
    )
