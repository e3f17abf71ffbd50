"""Positions of rows in a total order, without putting all rows, or all rows of one large
group, in one task.

Rows are dealt once, by ranges of their key, sorted inside the ranges and written with their place
in the range. The written table is read for everything else, so no recomputed task can disagree
about places. Places are then shifted by the sizes of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.staging import staged

_PLACE_BITS = 33  # Spark's increasing ids: the partition above 33 bits of place


def in_order(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """``df`` with its 0-based position by ``keys`` as ``_at``: one shuffle, written once.

    The shifts have one row for each range, and there are as many ranges as shuffle partitions.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = staged(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _PLACE_BITS)
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = stored.join(F.broadcast(shifts), part == F.col("_part"))
    return placed.select(*df.columns, (place + F.col("_before")).alias("_at"))


def number_rows(
    df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "position"
) -> DataFrame:
    """Add the 1-based position of each row in ``order``, counted within ``by``.

    ``by`` and ``order`` together must tell rows apart, or tied rows take their positions in
    an arbitrary order.
    """
    by = by or []
    placed = in_order(df, [*by, *order])
    if not by:
        return placed.select(*df.columns, (F.col("_at") + 1).alias(name))
    # Rows of a group follow each other, so a position in the group is that in the table less
    # the group's first. The firsts are stored: then adaptive execution can split a hot group.
    groups = [F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)]
    first = staged(placed.groupBy(*groups).agg(F.min("_at").alias("_first")))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    position = (F.col("_at") - F.col("_first") + 1).alias(name)
    return placed.join(first, same).select(*df.columns, position)
