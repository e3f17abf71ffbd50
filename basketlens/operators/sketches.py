"""Approximate quantiles and distinct counts from states that are stored once and merged at will.

A state is a sketch of one column over one part of a table, say a month: a few kilobytes however many rows it stands for.
New parts add states and leave the others alone, and any selection of parts is answered from their states, without a
pass over the table. How exact answers are is the caller's choice, not the data's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FLOATS = ("double", "float")
STATE = "state_"  # before the name of the column that a state is of


def quantile_accuracy(rank_error: float) -> int:
    """The sketch size whose ranks are off by less than half of ``rank_error`` with 99 % confidence, so that the
    whole of it is hardly ever used up."""
    if not 0 < rank_error < 1:
        raise ValueError(f"a rank error lies between 0 and 1, {rank_error} does not")
    return min(65535, max(8, math.ceil((2 * 2.296 / rank_error) ** (1 / 0.9723))))


def distinct_accuracy(error: float) -> int:
    """The binary logarithm of the sketch size whose standard error is at most a quarter of ``error``."""
    if not 0 < error < 1:
        raise ValueError(f"a relative error lies between 0 and 1, {error} does not")
    return min(21, max(4, math.ceil(2 * math.log2(4 * 1.04 / error))))


def _number(df: DataFrame, name: str) -> Column:
    """The column as a double, NaN as null."""
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def quantile_states(df: DataFrame, columns: Sequence[str], by: Sequence[str], rank_error: float = 0.01) -> DataFrame:
    """Rows (by..., state_...): a quantile sketch of every numeric column for every part. Null and NaN count as missing."""
    size = quantile_accuracy(rank_error)
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(_number(df, c), F.lit(size)).alias(STATE + c) for c in columns])


def merged_quantiles(
    states: DataFrame, columns: Sequence[str], named_probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by..., column, count, one column for each named quantile) from the states that ``states`` holds.

    A quantile is one of the column's values, null where it has none.
    """
    merged = states.groupBy(*by).agg(*[F.kll_merge_agg_double(STATE + c).alias(STATE + c) for c in columns])

    def row(name: str) -> Column:
        state = STATE + name
        n = F.kll_sketch_get_n_double(state)
        values = [
            F.when(n > 0, F.kll_sketch_get_quantile_double(state, F.lit(float(p)))).alias(out) for out, p in named_probs.items()
        ]
        return F.struct(F.lit(name).alias("column"), n.alias("count"), *values)

    return merged.select(*by, F.inline(F.array(*[row(c) for c in columns])))


def distinct_states(df: DataFrame, columns: Sequence[str], by: Sequence[str], error: float = 0.02) -> DataFrame:
    """Rows (by..., state_...): a sketch of the different values of every column for every part.

    Null and NaN count as missing, 0.0 and -0.0 as one value.
    """
    kinds = dict(df.dtypes)

    def value(name: str) -> Column:
        kind = kinds[name]
        if kind in ("int", "bigint", "string", "binary"):
            return F.col(name)
        if kind in _FLOATS:
            return F.when(~F.isnan(name), F.col(name) + 0.0).cast("string")
        return F.col(name).cast("bigint" if kind in ("tinyint", "smallint") else "string")

    size = F.lit(distinct_accuracy(error))
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(value(c), size).alias(STATE + c) for c in columns])


def merged_distinct(states: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, distinct_values) from the states that ``states`` holds."""
    merged = states.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(STATE + c)).alias(STATE + c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.coalesce(STATE + c, F.lit(0)).cast("bigint").alias("distinct_values")) for c in columns]
    return merged.select(*by, F.inline(F.array(*rows)))


def rank_errors(df: DataFrame, quantiles: DataFrame, named_probs: dict[str, float]) -> DataFrame:
    """Rows (column, quantile, error): how far the rank of each approximate quantile of ``df`` is from the wanted one.

    ``quantiles``: as from :func:`merged_quantiles` without ``by``, a row for each column. One pass over ``df``.
    """
    found = [(r["column"], name, r[name], p) for r in quantiles.collect() for name, p in named_probs.items() if r[name] is not None]
    cells = []
    for column, name, value, prob in found:
        x, n = _number(df, column), F.count(_number(df, column))
        below, up_to = F.count_if(x < value) / n, F.count_if(x <= value) / n
        error = F.greatest(below - prob, prob - up_to, F.lit(0.0))
        cells.append(F.struct(F.lit(column).alias("column"), F.lit(name).alias("quantile"), error.alias("error")))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, quantile string, error double")
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
