"""Two-way tables, long and wide."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.labels import month_index

ROWS = 200_000  # added up at a time
# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count}


@dataclass(frozen=True)
class Spec:
    """One two-way table: two keys, a measured column and sum, avg or count."""

    f1: str
    f2: str
    metric: str
    op: str

    @property
    def short_name(self) -> str:
        short = {
            "Product_Category": "category", "Product_Brand": "brand", "Product_Type": "type",
            "Customer_Segment": "segment", "Shipping_Method": "shipping",
            "Payment_Method": "payment",
        }
        return "_".join([short.get(c, c.lower()) for c in (self.f1, self.f2)] + [self.op])


def key_column(name: str) -> Column:
    """Months are compared by number, whatever way they are written."""
    return (month_index(F.col("Month")) if name == "Month" else F.col(name)).alias(name)


def crosstab(df: DataFrame, spec: Spec) -> DataFrame:
    keys = [key_column(spec.f1), key_column(spec.f2)]
    return df.groupBy(*keys).agg(AGGREGATES[spec.op](spec.metric).alias("value"))


def crosstab_many(df: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """All tables from one scan, long form: (spec, f1, f2, value) with keys as text.

    A task adds up its rows by each pair of keys in Arrow, ``ROWS`` rows at a time, so a row is never
    copied for each pair: what is shuffled are cells.
    """
    pairs = list(dict.fromkeys((s.f1, s.f2) for s in specs))
    keys = list(dict.fromkeys(c for pair in pairs for c in pair))
    metrics = list(dict.fromkeys(s.metric for s in specs))
    narrow = df.select(
        *[key_column(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
        *[F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metrics)],
    )
    wanted = [(f"k{keys.index(one)}", f"k{keys.index(two)}") for one, two in pairs]
    sums, counts = [f"s{i}" for i in range(len(metrics))], [f"n{i}" for i in range(len(metrics))]
    names = ["pair", "f1", "f2", *sums, *counts]
    measured = [(f"m{i}", kind) for kind in ("sum", "count") for i in range(len(metrics))]

    def cells(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        for number, (one, two) in enumerate(wanted):
            # Equal keys are grouped under two names, or a pair of one key would be one column.
            both = rows.select([f"m{i}" for i in range(len(metrics))]).append_column("f1", rows[one]).append_column("f2", rows[two])
            found = both.group_by(["f1", "f2"]).aggregate(measured)
            columns = [pa.array([number] * len(found), pa.int32()), found["f1"], found["f2"]]
            columns += [found[f"{m}_{kind}"] for m, kind in measured]
            yield from pa.Table.from_arrays(columns, names).combine_chunks().to_batches()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            held.append(batch)
            many += len(batch)
            if many >= ROWS:
                yield from cells(held)
                held, many = [], 0
        if held:
            yield from cells(held)

    kinds = ", ".join([f"{n} double" for n in sums] + [f"{n} bigint" for n in counts])
    partial = narrow.mapInArrow(work, f"pair int, f1 string, f2 string, {kinds}")
    total = partial.groupBy("pair", "f1", "f2").agg(*[F.sum(n).alias(n) for n in (*sums, *counts)])

    def row(spec: Spec) -> Column:
        at = metrics.index(spec.metric)
        there = F.col(f"n{at}")
        value = {"sum": F.when(there > 0, F.col(f"s{at}")), "avg": F.try_divide(f"s{at}", there), "count": there.cast("double")}
        return F.struct(F.lit(spec.short_name).alias("spec"), F.col("f1"), F.col("f2"), value[spec.op].alias("value"))

    rows = F.lit(None)
    for number, pair in enumerate(pairs):
        members = F.array(*[row(s) for s in specs if (s.f1, s.f2) == pair])
        rows = F.when(F.col("pair") == number, members).otherwise(rows)
    return total.select(F.inline(rows))


def pivot_wide(
    df: DataFrame,
    rows: str,
    columns: str,
    value: Column,
    values: Sequence[str] | None = None,
    nulls: bool = True,
    other: str = "other",
) -> DataFrame:
    """Wide form, one column per value of ``columns``; empty cells are 0.

    With ``values``, the columns are these in this order, "null" unless ``nulls`` is false, and ``other``, which takes
    all other labels: they do not depend on the data, and no job looks for them. Rows with a null are left out where
    there is no column for them. Without ``values`` Spark finds them first, and fails beyond its limit of pivot columns.
    A null in ``columns`` becomes a column named "null"; a label that reads so itself is an error.
    """
    label = F.col(columns).cast("string")
    clash = F.raise_error(F.lit(f"a value of {columns} reads 'null', the name of the column of nulls"))
    label = F.when(label == "null", clash.cast("string")).otherwise(label)
    if values is not None:
        names = [*values, *(["null"] if nulls else []), other]
        if len(set(names)) < len(names):
            raise ValueError(f"columns that are named twice: {names}")
        df = df if nulls else df.where(F.col(columns).isNotNull())
        label = F.when(label.isNull() | label.isin(*values), label).otherwise(F.lit(other))
    named = df.withColumn(columns, F.coalesce(label, F.lit("null")))
    wide = named.groupBy(rows).pivot(columns, names if values is not None else None).agg(value)
    return wide.fillna(0, [c for c in wide.columns if c != rows])
