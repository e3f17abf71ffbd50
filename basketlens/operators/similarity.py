"""The best items for many query vectors, by cosine or by inner product, without comparing all pairs.

Items are cut into blocks of bounded size that travel by shuffle; nothing but a bounded number of pivots and four
numbers a block reaches the driver. For every block there is an upper bound of what a query can reach in it:

* cosine: items go to the nearest of the pivots and are cut by their angle from it, so a block is a ring around its
  pivot. By the triangle inequality no item of the ring is closer to a query than the query's own angle from the
  pivot allows.
* inner product: items are cut by falling length, and no product exceeds that of the lengths (Cauchy-Schwarz).

Each query is first compared with its most promising block. Its k-th best there is a floor: blocks whose bound is
below it cannot hold any of the k best and are skipped, all others are searched. Few items are one block, and that
is the whole search. The queries of a block come in parts as bounded as the block; a part and its block meet in one task,
which returns k items a query, never pairs.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from basketlens.operators.numbering import in_order
from basketlens.operators.staging import staged

BLOCK_BYTES = 16 * 1024 * 1024
CELLS_PER_STEP = 4_000_000
MOST_PIVOTS = 256
COSINE, PRODUCT = "similarity", "product"
_SLACK = 1e-9  # what rounding may take from a bound

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _plain(vectors: pa.Array) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _matrix(vectors: pa.Array, kind: str = COSINE) -> np.ndarray:
    """A matrix of the vectors; for cosines of length 1, where a zero vector stays zero."""
    matrix = _plain(vectors)
    if kind == PRODUCT:
        return matrix
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(queries: np.ndarray, items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best item rows of each query row, the first of equal ones, and their similarity."""
    k = min(k, len(items))
    at = np.empty((len(queries), k), dtype=np.int64)
    found = np.empty((len(queries), k))
    step = max(1, CELLS_PER_STEP // max(len(items), 1))
    for start in range(0, len(queries), step):
        scores = queries[start : start + step] @ items.T
        rows = np.arange(len(scores))
        for place in range(k):
            top = scores.argmax(axis=1)
            at[start : start + step, place] = top
            found[start : start + step, place] = scores[rows, top]
            scores[rows, top] = -np.inf
    return at, found + 0.0


def whole_vectors(df: DataFrame, vector: str, nulls: str = "skip") -> DataFrame:
    """Rows whose vector is there and holds no null; ``nulls="error"`` fails on one that does."""
    df = df.where(F.col(vector).isNotNull())
    if not df.schema[vector].dataType.containsNull:
        return df
    holds_null = F.exists(vector, lambda x: x.isNull())
    if nulls == "error":
        return df.where(~F.when(holds_null, F.raise_error(F.lit(f"a null in {vector}")).cast("boolean")).otherwise(F.lit(False)))
    return df.where(~holds_null)


@dataclass(frozen=True)
class Blocks:
    """For each block of items its pivot's row and the least and greatest distance from it.

    The distance is an angle, or for inner products the negative length. The last pivot is the zero vector: around it are the
    zero items, or all items where there is one block.
    """

    kind: str
    pivots: np.ndarray
    cell: np.ndarray
    near: np.ndarray
    far: np.ndarray
    rows: int  # items a block, queries a part

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query can reach in each block."""
        if self.kind == PRODUCT:
            most = np.linalg.norm(queries, axis=1)[:, None] * -self.near
            return most + _SLACK * (1 + np.abs(most))
        angle = np.arccos(np.clip(queries @ self.pivots.T, -1, 1))[:, self.cell]
        return np.cos(np.maximum(0, np.maximum(angle - self.far, self.near - angle))) + _SLACK

    def first(self, queries: np.ndarray) -> np.ndarray:
        """The block that each query looks into first."""
        return (self.bounds(queries) + 1e-3 * (queries @ self.pivots.T)[:, self.cell]).argmax(axis=1)


def blocks_of(items: DataFrame, vector: str, kind: str, block_bytes: int = BLOCK_BYTES) -> tuple[Blocks, DataFrame] | None:
    """The blocks of ``items`` (item, and a column of vectors without nulls), and (block, item, vector); None if there are none."""
    size = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).head()
    if not size["n"]:
        return None
    rows, dims = max(1, block_bytes // (8 * max(1, size["d"]))), size["d"]
    many = -(-size["n"] // rows)
    pivots = np.zeros((0, dims))
    if many > 1 and kind == COSINE:
        sample = items.orderBy(F.xxhash64("item"), "item").select(vector).limit(min(MOST_PIVOTS, 2 * many))
        pivots = np.unique(_matrix(sample.toArrow()[vector]), axis=0)
        pivots = pivots[np.linalg.norm(pivots, axis=1) > 0]
    around, one = np.vstack([pivots, np.zeros((1, dims))]), many == 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch.column(vector), kind)
            cell, away = np.full(len(matrix), len(around) - 1), -np.linalg.norm(matrix, axis=1)
            if kind == COSINE:
                away = np.zeros(len(matrix))
                step = max(1, CELLS_PER_STEP // len(around))
                for start in range(0, len(matrix) if len(pivots) else 0, step):
                    part = matrix[start : start + step]
                    cosine = part @ pivots.T
                    nearest, real = cosine.argmax(axis=1), part.any(axis=1)
                    cell[start : start + step][real] = nearest[real]
                    angle = np.arccos(np.clip(cosine[np.arange(len(part)), nearest], -1, 1))
                    away[start : start + step][real] = angle[real]
            flat = pa.ListArray.from_arrays(np.arange(0, matrix.size + 1, max(1, matrix.shape[1]), dtype=np.int32), matrix.ravel())
            columns = [pa.array(cell, pa.int32()), pa.array(away), batch.column("item"), flat]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "away", "item", "vector"])

    placed = items.select("item", vector).mapInArrow(place, "cell int, away double, item bigint, vector array<double>")
    if one:
        placed = staged(placed.withColumn("block", F.lit(0).cast("bigint")))
    else:
        numbered = in_order(placed, ["cell", "away", "item"])
        firsts = numbered.groupBy("cell").agg(F.min("_at").alias("begin"))  # a row for each pivot
        number = F.floor((F.col("_at") - F.col("begin")) / rows).cast("bigint")
        placed = staged(numbered.join(F.broadcast(firsts), "cell").withColumn("block", F.shiftleft(F.col("cell").cast("bigint"), 40) + number))
    stats = placed.groupBy("block").agg(F.min("cell").alias("cell"), F.min("away").alias("near"), F.max("away").alias("far"))
    found = stats.orderBy("block").toArrow()
    near, far = (found[c].to_numpy() for c in ("near", "far"))
    if kind == COSINE and one:
        far = np.array([math.pi])  # all items, wherever they are
    elif kind == COSINE:
        near, far = near - _SLACK, far + _SLACK
    # Blocks are told apart by their place in the table of blocks, which has a row for each of them.
    names = found.select(["block"]).append_column("place", pa.array(range(len(found)), pa.int32()))
    places = items.sparkSession.createDataFrame(names)
    placed = placed.join(F.broadcast(places), "block").select(F.col("place").alias("block"), "item", "vector")
    return Blocks(kind, around, found["cell"].to_numpy(), near, far, rows), placed


def _routed(queries: DataFrame, blocks: Blocks, again: bool, parts: dict[int, int] | None = None) -> DataFrame:
    """The queries (id, vector and, ``again``, _floor) by the blocks they have to be compared with.

    At first that is one block each, ``again`` all others that can reach the floor. Without ``parts`` only
    the numbers of queries: rows (block, queries).
    """
    query_id, query_vector = queries.columns[:2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch.column(query_vector), blocks.kind)
            step = max(1, CELLS_PER_STEP // len(blocks.cell))
            for start in range(0, len(matrix), step):
                some = matrix[start : start + step]
                first = blocks.first(some)
                if again:
                    floor = batch.column("_floor").slice(start, len(some)).to_numpy(zero_copy_only=False)
                    reach = ~(blocks.bounds(some) < np.asarray(floor, dtype=np.float64)[:, None])
                    reach[np.arange(len(some)), first] = False
                    row, block = np.nonzero(reach)
                else:
                    row, block = np.arange(len(some)), first
                if parts is None:
                    block, count = np.unique(block, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(count, pa.int64())], ["block", "queries"])
                    continue
                at = pa.array(row + start)
                spread = batch.column("_spread").to_numpy().view(np.uint64)[row + start]
                part = spread % np.array([parts[b] for b in block.tolist()], dtype=np.uint64)
                columns = [pa.array(block, pa.int32()), pa.array(part.astype(np.int32)), batch.column(query_id).take(at)]
                columns.append(batch.column(query_vector).take(at))
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", query_id, query_vector])

    if parts is None:
        return queries.mapInArrow(work, "block int, queries bigint").groupBy("block").agg(F.sum("queries").alias("queries"))
    keys = StructType.fromDDL("block int, part int").fields
    return queries.mapInArrow(work, StructType(keys + queries.schema.fields[:2]))


def _compared(queries: DataFrame, items: DataFrame, blocks: Blocks, k: int, again: bool = False) -> DataFrame:
    """Rows (query id, item, value): the k best of each block that a query has to be compared with.

    ``queries`` is a stored table: read again by a repeated task, its rows get the same numbers, hence the same parts.
    """
    spark, (query_id, query_vector), kind = queries.sparkSession, queries.columns[:2], blocks.kind
    queries = queries.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    counts = {r["block"]: r["queries"] for r in _routed(queries, blocks, again).collect()}
    parts = {block: -(-count // blocks.rows) for block, count in counts.items()}
    schema = StructType([queries.schema.fields[0], *StructType.fromDDL("item bigint, value double").fields])
    if not parts:
        return spark.createDataFrame([], schema)
    table = spark.createDataFrame(list(parts.items()), "block int, parts int")  # a row for each block
    copies = items.join(F.broadcast(table), "block")
    copies = copies.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "item", "vector")

    def score(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not len(ours) or not len(theirs):
            return pa.Table.from_arrays([theirs[query_id].slice(0, 0), pa.array([], pa.int64()), pa.array([], pa.float64())], [query_id, "item", "value"])
        order = np.argsort(ours["item"].to_numpy(), kind="stable")
        at, found = _best(_matrix(theirs[query_vector], kind), _plain(ours["vector"])[order], k)
        rows = pa.array(np.repeat(np.arange(len(at)), at.shape[1]))
        columns = [theirs[query_id].take(rows), pa.array(ours["item"].to_numpy()[order][at.ravel()]), pa.array(found.ravel())]
        return pa.Table.from_arrays(columns, [query_id, "item", "value"])

    ours, theirs = (df.groupBy("block", "part") for df in (copies, _routed(queries, blocks, again, parts)))
    return ours.cogroup(theirs).applyInArrow(score, schema)


def _ranked(found: DataFrame, query_id: str, k: int, distinct: bool) -> DataFrame:
    if distinct:
        found = found.groupBy(query_id, "item").agg(F.max("value").alias("value"))
    order = Window.partitionBy(query_id).orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top_k(queries: DataFrame, items: DataFrame, k: int, kind: str, block_bytes: int, distinct: bool, nulls: str) -> DataFrame:
    (query_id, query_vector), (item_id, item_vector) = queries.columns, items.columns
    # Dealing by ranges looks at its input twice, so what is behind the items is computed before.
    numbered = in_order(staged(whole_vectors(items, item_vector, nulls)), [item_id])
    names = staged(numbered.select(F.col("_at").alias("item"), F.col(item_id).alias("_name"), F.col(item_vector).alias("_vector")))
    cut = blocks_of(names.select("item", "_vector"), "_vector", kind, block_bytes)
    if cut is None:
        return queries.limit(0).select(
            query_id, F.lit(None).cast(items.schema[item_id].dataType).alias(item_id),
            F.lit(None).cast("double").alias(kind), F.lit(None).cast("int").alias("rank"),
        )
    blocks, placed = cut
    rows = staged(whole_vectors(queries, query_vector, nulls).select(query_id, query_vector))
    found = _compared(rows, placed, blocks, k)
    if len(blocks.cell) > 1:
        found = staged(found)
        floors = _ranked(found, query_id, k, distinct).where(F.col("rank") == k)
        floors = staged(floors.select(F.col(query_id).alias("_id"), F.col("value").alias("_floor")))
        rows = rows.join(floors, F.col(query_id).eqNullSafe(F.col("_id")), "left").drop("_id")
        found = found.unionByName(_compared(staged(rows), placed, blocks, k, again=True))
    best = _ranked(found, query_id, k, distinct).join(names.select("item", "_name"), "item")
    return best.select(query_id, F.col("_name").alias(item_id), F.col("value").alias(kind), "rank")


def top_k_similar(
    queries: DataFrame,
    items: DataFrame,
    k: int = 5,
    block_bytes: int = BLOCK_BYTES,
    distinct: bool = True,
    nulls: str = "skip",
) -> DataFrame:
    """Rows (query id, item id, similarity, rank): the k items with the greatest cosine.

    Both inputs have two columns, an id (which may be null) and an ``array<double>``; all vectors
    have one length. Item ids are distinct. A query id may have several vectors: an item counts with its best
    similarity, or, unless ``distinct``, once for each of them. Ties go to the smaller item id.

    The k best of a part of the data contain that part's members of the k best of all, so
    partial results are merged without loss.
    """
    return _top_k(queries, items, k, COSINE, block_bytes, distinct, nulls)


def top_k_products(
    queries: DataFrame,
    items: DataFrame,
    k: int = 5,
    block_bytes: int = BLOCK_BYTES,
    distinct: bool = True,
    nulls: str = "skip",
) -> DataFrame:
    """Rows (query id, item id, product, rank): as :func:`top_k_similar`, with the greatest inner products."""
    return _top_k(queries, items, k, PRODUCT, block_bytes, distinct, nulls)
