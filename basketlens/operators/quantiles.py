"""Exact quantiles by group, for groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a first pass finds
approximate quantiles, which come with a bound of their rank error. So the wanted rank lies between two of them,
and a second pass counts what is below and looks at the values in between only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.staging import staged

ACCURACY = 10_000  # ranks are off by one part in so many; as many values lie between, about


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Rows (by..., prob, quantile), with linear interpolation between neighbours.

    Null and NaN count as missing. ``df`` is read twice: pass a stored table.
    """
    by = by or []
    values = df.select(*by, F.col(value).cast("double").alias("_value")).where(
        F.col("_value").isNotNull() & ~F.isnan("_value")
    )
    margin = 2.0 / accuracy
    asked = [p for prob in probs for p in (max(0.0, prob - margin), min(1.0, prob + margin))]
    sketch = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"),
        F.min("_value").alias("_min"),
        F.max("_value").alias("_max"),
        F.percentile_approx("_value", asked, accuracy).alias("_p"),
    )
    brackets = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(float(prob)).alias("prob"),
                    (F.col("_min") if asked[2 * i] == 0 else F.col("_p")[2 * i]).alias("low"),
                    (F.col("_max") if asked[2 * i + 1] == 1 else F.col("_p")[2 * i + 1]).alias("high"),
                )
                for i, prob in enumerate(probs)
            ]
        )
    )
    wanted = sketch.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], "_total", brackets.alias("_b")
    )
    # One row for each group: a table of its own lets adaptive execution split a hot group.
    wanted = staged(wanted.groupBy(*[f"_by_{i}" for i in range(len(by))], "_total").agg(F.collect_list("_b").alias("_b")))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    if by:
        joined = values.join(wanted, same)
    else:  # a single row
        joined = values.withColumns({c: wanted.select(c).scalar() for c in ("_total", "_b")})
    each = joined.select(*by, "_total", "_value", F.explode("_b").alias("_b"))
    # All values below a bracket become one row for each task, and so do all above. Of these only
    # the value next to the bracket can be wanted.
    side = F.when(F.col("_value") < F.col("_b.low"), -1).when(F.col("_value") > F.col("_b.high"), 1).otherwise(0)
    each = each.select(*by, "_total", "_value", F.col("_b.prob").alias("prob"), side.alias("_side"))
    counted = each.groupBy(
        *by, "_total", "prob", "_side", F.when(F.col("_side") == 0, F.col("_value")).alias("_inside")
    ).agg(F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    up_to = (
        Window.partitionBy(*by, "prob")
        .orderBy("_side", "_inside")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rank = (F.col("_total") - 1) * F.col("prob")
    placed = (
        counted.withColumn("_end", F.sum("_n").over(up_to))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumns({"_rank": rank, "_low": F.floor(rank), "_high": F.ceil(rank)})
    )

    def at(position: str):
        first = F.when(F.col("_side") < 0, F.col("_end") - 1).otherwise(F.col("_start"))
        last = F.when(F.col("_side") > 0, F.col("_start")).otherwise(F.col("_end") - 1)
        value = F.when(F.col("_side") < 0, F.col("_most")).otherwise(F.col("_least"))
        return F.max(F.when((first <= F.col(position)) & (F.col(position) <= last), value))

    return (
        placed.groupBy(*by, "prob")
        .agg(
            at("_low").alias("_v0"),
            at("_high").alias("_v1"),
            F.max(F.col("_rank") - F.col("_low")).alias("_part"),
        )
        .select(
            *by,
            "prob",
            (F.col("_v0") + F.col("_part") * (F.col("_v1") - F.col("_v0"))).alias("quantile"),
        )
    )


def quantile_columns(
    df: DataFrame,
    value: str,
    named_probs: dict[str, float],
    by: list[str] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group, one column per named quantile."""
    by = by or []
    rows = exact_quantiles(df, value, list(named_probs.values()), by, accuracy)
    return rows.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for name, p in named_probs.items()
        ]
    )
