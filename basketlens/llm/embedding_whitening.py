"""Whitening of embeddings by polarisation covariance.

Entries become whole numbers (``SCALE`` times the entry, rounded down, plus ``OFFSET``), so every sum is exact
and does not depend on the partitioning. With n vectors and the sums S of their dimensions, the centred values
n*x - S are whole numbers as well. Their squares are summed for every dimension and for the sum of every pair of
dimensions; half the difference of such a sum of squares and those of its two dimensions is the covariance of the
pair. From the covariances, divided only at the end, come the eigenvectors.

Squares are summed without rounding in doubles: a centred value is cut into digits of ``DIGIT`` bits, digits of a
pair's sum are the sums of its digits, and a product of two digits summed over ``BLOCK`` rows stays below 2^53.
Blocks are added up as decimals. A task holds a block of rows and three numbers for each pair of dimensions, the
driver one for each pair.

What happens to odd input: rows whose vector is null, empty or holds a null or a non-finite entry are dropped. So
are vectors of another length than the most frequent one (the greater one of equally frequent ones), as they have no
place in its covariance. Entries beyond 2^51 count as that. Null and repeated ids are kept, a row each, and repeated
rows count as often as they come up. An empty table gives no rows. Only the two columns named are read, so other
columns may have any name. Directions without variance (fewer distinct vectors than dimensions, constant entries) have
no whitened value (null) and do not enter identity_error. Equal eigenvalues leave the choice of vectors to the
eigensolver; each component's largest entry (the first of equal ones) is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
DIGIT = 20
BLOCK = 4096
_FARTHEST = float(2**51)


@dataclass(frozen=True)
class Whitening:
    """n vectors, the sums of their dimensions, eigenvalues (falling) and unit eigenvectors (columns), and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def varied(self, components: int) -> np.ndarray:
        """Which of the first components have variance beyond rounding."""
        first = self.values[:components]
        return first > self.size * np.finfo(float).eps * max(self.values[0], 0.0)


def whole_numbers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, x): the rows of a list column that have ``size`` finite entries, as whole numbers."""
    right = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    places = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    entries = pc.cast(column.filter(right).flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    entries = entries.reshape(len(places), size)
    finite = np.isfinite(entries).all(axis=1)
    scaled = np.floor(np.clip(entries[finite], -_FARTHEST, _FARTHEST) * SCALE)
    return places[finite], scaled.astype(np.int64) + OFFSET


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: as Python numbers where 64 bits are not enough."""
    middle = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    away = x - middle
    wide = n * (int(np.abs(away).max(initial=0)) + 1) >= 2**62
    return (away.astype(object) if wide else away) * n - rest


def digits(z: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, weighted by powers of 2^DIGIT, is ``z``; the lower ones of at most DIGIT - 1 bits and a sign."""
    half, out = 1 << (DIGIT - 1), []
    while True:
        low = ((z + half) & ((1 << DIGIT) - 1)) - half
        out.append(low.astype(np.float64))
        z = (z - low) >> DIGIT
        if not z.any():
            return out


def squares(x: np.ndarray, n: int, sums: list[int]) -> list[np.ndarray]:
    """For every power of 2^DIGIT, the exact sums of the squared centred values: entry (i, i) of dimension i,
    entry (i, j) of the sum of dimensions i and j, i < j."""
    size = len(sums)
    powers: list[np.ndarray] = []
    for begin in range(0, len(x), BLOCK):
        parts = [np.ascontiguousarray(p.T) for p in digits(centred(x[begin : begin + BLOCK], n, sums))]
        while len(powers) < 2 * len(parts) - 1:
            powers.append(np.zeros((size, size), dtype=object))
        for i in range(size):
            both = [p[i:] + p[i] for p in parts]
            for b, p in zip(both, parts, strict=True):
                b[0] = p[i]
            for a in range(len(parts)):
                for b in range(a, len(parts)):
                    found = np.einsum("jr,jr->j", both[a], both[b]).astype(np.int64).astype(object)
                    powers[a + b][i, i:] += found if a == b else 2 * found
    return powers


# ---- Spark ----------------------------------------------------------------------------------


def _vectors(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.select(F.col(key).alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))


def fit(df: DataFrame, column: str = "embedding") -> Whitening | None:
    """The whitening of a column of vectors; None where no vector is left. Reads ``df`` three times."""
    rows = df.select(F.col(column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    lengths = rows.where(F.col("vector").isNotNull() & finite).groupBy(F.size("vector").alias("size")).count()
    best = lengths.where("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    if best is None:
        return None
    size, n = best["size"], best["count"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in batches:
            _, x = whole_numbers(batch.column("vector"), size)
            for half, weight in ((x >> 32, 1 << 32), (x & 0xFFFFFFFF, 1)):
                total = [t + int(s) * weight for t, s in zip(total, half.sum(axis=0), strict=True)]
        made = [pa.array(range(size), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(made, ["i", "total"])

    added = rows.mapInArrow(add, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
    sums = [int(r["total"]) for r in sorted(added.collect())]

    def polarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: list[np.ndarray] = []
        for batch in batches:
            _, x = whole_numbers(batch.column("vector"), size)
            found = squares(x, n, sums)
            powers += [np.zeros((size, size), dtype=object) for _ in found[len(powers) :]]
            for total, more in zip(powers, found):
                total += more
        i, j = np.triu_indices(size)
        for power, total in enumerate(powers):
            made = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([power] * len(i), pa.int32())]
            made.append(pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(made, ["i", "j", "power", "total"])

    sums_of_squares = rows.mapInArrow(polarise, "i int, j int, power int, total decimal(38,0)")
    exact = np.zeros((size, size), dtype=object)
    for r in sums_of_squares.groupBy("i", "j", "power").agg(F.sum("total").alias("total")).collect():
        exact[r["i"], r["j"]] += int(r["total"]) << (DIGIT * r["power"])
    covariance = np.empty((size, size))
    for i in range(size):
        covariance[i, i] = exact[i, i] / n**3
        for j in range(i + 1, size):
            covariance[i, j] = covariance[j, i] = (exact[i, j] - exact[i, i] - exact[j, j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1].copy(), vectors[:, ::-1].copy()
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), range(size)] < 0, -1.0, 1.0)
    return Whitening(n, sums, values, vectors, sum(int(exact[i, i]) for i in range(size)) / n**3)


def projected(x: np.ndarray, model: Whitening, components: int = COMPONENTS) -> np.ndarray:
    """Whitened values of whole-number vectors, a column for each component; nan where it has no variance."""
    varied = model.varied(components)
    scale = np.full(len(varied), np.nan)
    scale[varied] = 1 / np.sqrt(model.values[:components][varied])
    return (centred(x, model.n, model.sums).astype(np.float64) / model.n) @ (model.vectors[:, :components] * scale)


def identity_error(df: DataFrame, model: Whitening, column: str = "embedding", components: int = COMPONENTS) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    used = np.flatnonzero(model.varied(components))
    if not len(used):
        return None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(len(used)), np.zeros((len(used), len(used)))
        for batch in batches:
            _, x = whole_numbers(batch.column("vector"), model.size)
            white = projected(x, model, components)[:, used]
            sums += white.sum(axis=0)
            products += white.T @ white
        both = [pa.array([sums.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(both, ["sums", "products"])

    rows = df.select(F.col(column).cast("array<double>").alias("vector"))
    found = rows.mapInArrow(moments, "sums array<double>, products array<double>")
    many = len(used)
    total = found.agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(many)]).alias("sums"),
        F.array(*[F.sum(F.col("products")[i]) for i in range(many * many)]).alias("products"),
    ).first()
    mean = np.array(total["sums"]) / model.n
    covariance = np.array(total["products"]).reshape(many, many) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(many)).max())


def whitened(
    df: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, deviation, deviation_digits, whitened (an array, a value for each component) of every vector that fits.

    ``deviation`` is null where it does not fit 64 bits; ``deviation_digits`` always has all its digits.
    """
    rows = _vectors(df, key, column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = whole_numbers(batch.column("vector"), model.size)
            z = centred(x, model.n, model.sums)
            if model.size * int(np.abs(z).max(initial=0)) ** 2 >= 2**63:
                z = z.astype(object)
            deviation = (z * z).sum(axis=1).tolist()
            white = projected(x, model, components)
            made = [
                batch.column("vec_id").take(pa.array(places)),
                pa.array([d if d < 2**63 else None for d in deviation], pa.int64()),
                pa.array([str(d) for d in deviation], pa.string()),
                pa.array([[None if v != v else v for v in row] for row in white.tolist()], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(made, ["vec_id", "deviation", "deviation_digits", "whitened"])

    more = StructType.fromDDL("deviation bigint, deviation_digits string, whitened array<double>")
    return rows.mapInArrow(work, StructType(rows.schema.fields[:1] + more.fields))


def whitening_report(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits.

    A row for each remaining row of ``embeddings`` (vec_id, embedding) and each of the first ``components``
    components, as far as there are dimensions.
    """
    model = fit(df)
    if model is None:
        kind = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_digits string"
        empty = df.select("vec_id").limit(0)
        return df.sparkSession.createDataFrame([], StructType(empty.schema.fields + StructType.fromDDL(kind).fields))
    shares = model.values[:components] / model.trace if model.trace else np.full(min(components, model.size), np.nan)
    explained = F.array(*[F.lit(None if v != v else float(v)).cast("double") for v in shares])
    error = identity_error(df, model, components=components)
    rows = whitened(df, model, components=components)
    return rows.select("vec_id", "deviation", "deviation_digits", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_digits",
    )
