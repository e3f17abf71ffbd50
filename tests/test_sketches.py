import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import profiling as p
from basketlens.operators import sketches as k
from basketlens.operators.staging import staged

PROBS = {"low": 0.01, "median": 0.5, "high": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    skewed = F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pow(F.rand(3), F.lit(9.0)) * 1000)
    odd = F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).when(F.col("id") % 51 != 0, skewed)
    return staged(spark.range(60_000).select(
        (F.col("id") % 7).alias("part"), F.col("id"), odd.alias("x"), F.lit(None).cast("int").alias("none"),
        F.concat(F.lit("v"), F.col("id") % 911).alias("name"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("day"),
    ))


@pytest.mark.parametrize("error", [0.05, 0.005])
def test_ranks_are_as_exact_as_asked_for(spark, rows, error):
    columns = ["id", "x", "none"]
    states = staged(k.quantile_states(rows, columns, ["part"], error))
    assert states.count() == 7
    found = staged(k.merged_quantiles(states, columns, PROBS))
    assert {r.column: r["count"] for r in found.collect()} == {
        c: rows.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).count() for c in columns
    }
    errors = k.rank_errors(rows, found, PROBS).collect()
    assert {(r.column, r.quantile) for r in errors} == {(c, q) for c in ("id", "x") for q in PROBS}
    assert max(r.error for r in errors) <= error
    values = [v for v in (r.x for r in rows.select("x").collect()) if v is not None and v == v]
    for r in found.where("column = 'x'").collect():
        for name, prob in PROBS.items():
            assert np.mean(np.array(values) < r[name]) - error <= prob <= np.mean(np.array(values) <= r[name]) + error


def test_a_selection_of_parts_and_new_parts(spark, rows):
    states = k.quantile_states(rows.where("part < 5"), ["id"], ["part"]).union(k.quantile_states(rows.where("part >= 5"), ["id"], ["part"]))
    some = k.merged_quantiles(states.where("part in (1, 6)"), ["id"], PROBS).first()
    assert some["count"] == rows.where("part in (1, 6)").count() and abs(some["median"] - 30_000) < 0.01 * 60_000
    by_part = k.merged_quantiles(states, ["id"], PROBS, ["part"]).collect()
    assert sorted(r.part for r in by_part) == list(range(7))


def test_distinct_counts_are_as_exact_as_asked_for(spark, rows):
    columns = ["id", "x", "none", "name", "day"]
    states = staged(k.distinct_states(rows, columns, ["part"], 0.02))
    found = {r.column: r.distinct_values for r in k.merged_distinct(states, columns).collect()}
    exact = {r.column: r.distinct_values for r in p.distinct_counts(rows.select(columns)).collect()}
    assert found["none"] == 0
    assert all(abs(found[c] - exact[c]) <= 0.02 * exact[c] for c in columns)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "z double")
    assert k.merged_distinct(k.distinct_states(zeros, ["z"], []), ["z"]).first().distinct_values == 1


def test_no_rows(spark, rows):
    none = rows.where("false")
    assert k.merged_quantiles(k.quantile_states(none, ["id"], ["part"]), ["id"], PROBS).collect()[0]["median"] is None
    assert k.merged_distinct(k.distinct_states(none, ["id"], ["part"]), ["id"]).first().distinct_values == 0


def test_describe_with_a_rank_error(spark, rows):
    exact = {r.column: r for r in p.describe_quartiles(rows.select("id", "x")).collect()}
    rough = {r.column: r for r in p.describe_quartiles(rows.select("id", "x"), rank_error=0.01).collect()}
    assert exact.keys() == rough.keys()
    assert abs(rough["id"].median - exact["id"].median) <= 0.01 * 60_000 and rough["id"]["max"] == exact["id"]["max"]


@pytest.mark.parametrize("call", [lambda: k.quantile_accuracy(0), lambda: k.distinct_accuracy(1.5)])
def test_errors_out_of_range(call):
    with pytest.raises(ValueError, match="between 0 and 1"):
        call()


def test_density_equals_the_sum_of_all_kernels(spark):
    rng = np.random.default_rng(1)
    values = 10 ** np.concatenate([rng.normal(2, 0.3, 3000), np.full(1500, 1.0), rng.normal(4, 0.05, 200)])
    found = p.log_density(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", 80).orderBy("point").collect()
    x = np.log10(values)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 80)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * (2 * np.pi) ** 0.5)
    assert [r.x for r in found] == pytest.approx(grid.tolist(), rel=1e-12)
    assert [r.density for r in found] == pytest.approx(want.tolist(), rel=1e-11, abs=1e-14)


def test_a_density_does_not_grow_with_the_rows(spark):
    one = spark.range(5000).select((F.rand(1) * 100 + 1).alias("v"))
    plan = p.log_density(one, "v")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
