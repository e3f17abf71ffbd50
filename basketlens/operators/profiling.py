"""Column profiles and the numbers behind distribution charts."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from basketlens.functions.numeric import exact_avg
from basketlens.operators.quantiles import exact_quantiles, quantile_columns
from basketlens.operators.sketches import merged_quantiles, quantile_states
from basketlens.operators.staging import staged

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
BINS = 1024  # bins of a density for each bandwidth
REACH = 12  # bandwidths
HELD = 100_000  # values of a column that a task holds at a time
# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _stacked(names: list[str], cells: list[list[Column]], out: list[str]) -> Column:
    flat = [c for name, row in zip(names, cells) for c in (F.lit(name), *row)]
    return F.stack(F.lit(len(names)), *flat).alias(*out)


def _counts_by_column(df: DataFrame, conditions: dict[str, Column], out: str) -> DataFrame:
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
    names = list(conditions)
    return counts.select(_stacked(names, [[F.col(n)] for n in names], ["column", out]))


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (column, nulls), from one pass over the table."""
    return _counts_by_column(df, {c: F.col(c).isNull() for c in df.columns}, "nulls")


def null_nan_counts(df: DataFrame) -> DataFrame:
    """As :func:`null_counts`, with NaN counted too in float and double columns."""
    conditions = {
        name: F.col(name).isNull() | F.isnan(name)
        if dtype in ("double", "float")
        else F.col(name).isNull()
        for name, dtype in df.dtypes
    }
    return _counts_by_column(df, conditions, "nulls")


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows (column, distinct_values), nulls and NaN not counted; 0.0 and -0.0 are one value.

    The exact form groups by (column, value) first, so that no task holds the values of a
    whole column. Before, a task leaves out what repeats among the values of a column, ``HELD`` of
    them at a time, so rows are not copied for each column.
    """
    names = df.columns
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        return counts.select(
            _stacked(names, [[F.col(c)] for c in names], ["column", "distinct_values"])
        )
    # Once -0.0 and NaN are gone, the text of a value tells apart what the type tells apart.
    floats = ("double", "float")
    kept = df.select([
        (F.when(~F.isnan(c), F.col(c) + 0.0).cast("string") if kind in floats else F.col(c).cast("string")).alias(f"c{i}")
        for i, (c, kind) in enumerate(df.dtypes)
    ])

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.Array]] = [[] for _ in names]
        sizes = [0] * len(names)

        def given(i: int) -> pa.RecordBatch:
            values = pc.unique(pa.chunked_array(held[i], pa.string()))
            held[i], sizes[i] = [], 0
            return pa.RecordBatch.from_arrays([pa.array([i] * len(values), pa.int32()), values], ["at", "value"])

        for batch in batches:
            for i in range(len(names)):
                values = pc.unique(batch.column(i)).drop_null()
                held[i].append(values)
                sizes[i] += len(values)
                if sizes[i] >= HELD:
                    yield given(i)
        yield from (given(i) for i in range(len(names)) if held[i])

    found = kept.mapInArrow(different, "at int, value string").groupBy("at", "value").agg(F.lit(1).alias("one"))
    counts = found.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    every = _stacked(names, [[F.lit(i)] for i in range(len(names))], ["column", "at"])
    columns = df.sparkSession.range(1).select(every)
    return columns.join(counts, "at", "left").select("column", F.coalesce("n", F.lit(0)).alias("distinct_values"))


def describe(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of numeric and text columns.

    Numbers and texts have separate minimum and maximum columns.
    """
    numbers, texts = numeric_columns(df), text_columns(df)
    names = [c for c in df.columns if c in numbers or c in texts]
    aggregates, cells = [], []
    for i, name in enumerate(names):
        x = F.col(name)
        is_number = name in numbers
        as_double = x.cast("double")
        stats = {
            "count": F.count(x),
            "mean": F.avg(as_double) if is_number else F.lit(None).cast("double"),
            "stddev": F.stddev_samp(as_double) if is_number else F.lit(None).cast("double"),
            "min": F.min(as_double if is_number else x),
            "max": F.max(as_double if is_number else x),
        }
        aggregates += [s.alias(f"{i}_{k}") for k, s in stats.items()]

        def pick(stat: str, wanted: bool, kind: str) -> Column:
            return F.col(f"{i}_{stat}") if wanted else F.lit(None).cast(kind)

        cells.append(
            [
                F.col(f"{i}_count"),
                F.col(f"{i}_mean"),
                F.col(f"{i}_stddev"),
                pick("min", is_number, "double"),
                pick("max", is_number, "double"),
                pick("min", not is_number, "string"),
                pick("max", not is_number, "string"),
            ]
        )
    out = ["column", "count", "mean", "stddev", "min_number", "max_number", "min_text", "max_text"]
    return df.agg(*aggregates).select(_stacked(names, cells, out))


def describe_quartiles(df: DataFrame, rank_error: float | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum of numeric columns.

    The moments come from one wide aggregate, the quartiles from two passes over the long form, or,
    with a ``rank_error``, from sketches whose quartiles have ranks that are off by no more than that.
    """
    names = numeric_columns(df)
    cells = [[F.col(c).cast("double")] for c in names]
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(
        *[make(cell).alias(f"{i}_{stat}") for i, (cell,) in enumerate(cells) for stat, make in stats.items()]
    )
    moments = wide.select(
        _stacked(names, [[F.col(f"{i}_{stat}") for stat in stats] for i in range(len(names))], ["column", *stats])
    )
    if rank_error is None:
        long = df.select(_stacked(names, cells, ["column", "value"]))
        quartiles = quantile_columns(long, "value", QUARTILES, ["column"])
    else:
        quartiles = merged_quantiles(quantile_states(df, names, [], rank_error), names, QUARTILES).drop("count")
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "stddev", "min", *QUARTILES, "max"
    )


def value_counts(df: DataFrame, name: str, dropna: bool = False) -> DataFrame:
    rows = df.dropna(subset=[name]) if dropna else df
    counts = rows.groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), name)


def value_summary(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Rows, mean, median, minimum, maximum and sample deviation of a column, by group."""
    by = by or []
    x = F.col(name)
    moments = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(x).alias("value_count"),
        exact_avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.stddev_samp(x).alias("std"),
    )
    medians = exact_quantiles(df, name, [0.5], by).select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        F.col("quantile").alias("median"),
    )
    if not by:
        return moments.select("*", medians.select("median").scalar().alias("median"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    return moments.join(medians, same, "left").select(*moments.columns, "median")


def _log_values(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name) > 0).select(F.log10(name).alias("x"))


def log_histogram(df: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """Equal bins of log10 of a column, empty bins included; values <= 0 have no logarithm.

    The last bin includes the maximum. Rows (bin, low, high, count).
    """
    logs = _log_values(df, name)
    limits = logs.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("r"))
    low, high = limits.scalar()["low"], limits.scalar()["high"]
    place = F.floor(F.try_divide((F.col("x") - low) * F.lit(bins), high - low))
    counts = (
        logs.select(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (high - low) / bins
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def log_density(df: DataFrame, name: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density of log10 of a column on an even grid from minimum to maximum.

    Bandwidth by Scott's rule. Values are first summed up by bins of a ``BINS``-th of the bandwidth, as their number and
    the first three moments around the bin's middle. The kernel is then taken at the middles only and expanded by the
    moments, which changes a density by less than 1e-13 of a value's own kernel. So what meets the grid are bins, whose number depends
    on the range in bandwidths and not on the rows. A value has no part beyond ``REACH`` bandwidths (1e-31 of its kernel).
    Rows (point, x, density); none for a column without spread.
    """
    logs = _log_values(df, name)
    stats = logs.agg(
        F.struct(
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            F.count("x").alias("n"),
            (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
        ).alias("r")
    ).head()["r"]
    if not stats["h"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    low, n, h = stats["low"], stats["n"], stats["h"]
    step, width = (stats["high"] - low) / (points - 1), h / BINS

    place = (F.col("x") - low) / width
    away = place - F.floor(place) - 0.5
    bins = logs.select(F.floor(place).alias("bin"), away.alias("m")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("m0"),
        F.sum("m").alias("m1"),
        F.sum(F.col("m") * F.col("m")).alias("m2"),
        F.sum(F.col("m") * F.col("m") * F.col("m")).alias("m3"),
    )
    middle = (F.col("bin") + 0.5) * width  # from the lowest value on
    first = F.greatest(F.ceil((middle - REACH * h) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((middle + REACH * h) / step), F.lit(points - 1)).cast("int")
    near = bins.withColumns({"middle": middle, "first": first, "last": last}).where("first <= last")
    near = near.withColumn("point", F.explode(F.sequence("first", "last")))
    z, t = (F.col("point") * step - F.col("middle")) / h, 1.0 / BINS
    expanded = (
        F.col("m0") + F.col("m1") * t * z + F.col("m2") * (t**2 / 2) * (z * z - 1) + F.col("m3") * (t**3 / 6) * (z * z * z - 3 * z)
    )
    sums = near.select("point", (F.exp(-0.5 * z * z) * expanded).alias("s")).groupBy("point").agg(F.sum("s").alias("s"))
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    scale = 1.0 / (n * h * (2 * math.pi) ** 0.5)
    return every.join(sums, "point", "left").select(
        "point",
        (F.lit(low) + F.col("point") * step).alias("x"),
        (F.coalesce("s", F.lit(0.0)) * scale).alias("density"),
    )


def box_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, mean, whiskers and outlier count by group.

    A whisker ends at the last value within 1.5 interquartile ranges of the box.
    """
    rows = df.select(group, F.col(value).cast("double").alias("_v")).dropna()
    boxes = quantile_columns(rows, "_v", QUARTILES, [group])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    boxes = staged(
        boxes.select(
            "*", (F.col("q1") - reach).alias("_low"), (F.col("q3") + reach).alias("_high")
        )
    )
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return (
        rows.join(boxes, group)
        .groupBy(group, *QUARTILES)
        .agg(
            F.count(F.lit(1)).alias("count"),
            exact_avg(F.col("_v")).alias("mean"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(group, "count", "mean", *QUARTILES, "whisker_low", "whisker_high", "outliers")
    )


def preview(df: DataFrame, columns: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n).select(*columns)
