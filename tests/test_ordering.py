import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.operators import staging
from basketlens.operators.numbering import in_order, number_rows
from basketlens.operators.quantiles import exact_quantiles


def hot_groups(spark, n=3000):
    """One group has a third of all rows; keys come in no order, some groups are null."""
    rng = random.Random(1)
    keys = list(range(n))
    rng.shuffle(keys)
    rows = [("hot" if k % 3 == 0 else None if k % 50 == 0 else f"g{k % 97}", k, f"t{k}") for k in keys]
    return spark.createDataFrame(rows, "g string, k long, t string").repartition(5), rows


@pytest.fixture(params=["1", "7", "40"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbers_whole_table(spark, partitions):
    df, rows = hot_groups(spark)
    got = number_rows(df, ["k"]).collect()
    assert sorted(r.position for r in got) == list(range(1, len(rows) + 1))
    assert all(r.position == r.k + 1 for r in got)


def test_numbers_within_groups(spark, partitions):
    df, rows = hot_groups(spark)
    got = number_rows(df, ["k"], ["g"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.k, r.position))
    assert sum(map(len, by_group.values())) == len(rows)
    for members in by_group.values():
        assert [p for _, p in sorted(members)] == list(range(1, len(members) + 1))


def test_large_group_spans_ranges(spark):
    """A range holds a bounded part of the hot group: its sizes are those of the whole table's ranges."""
    df, rows = hot_groups(spark, 40_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        in_order(df, ["g", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(staging._STAGED[-1])
    parts = stored.where("g = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.6 * 40_000 / 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "g string, k long")
    assert number_rows(empty, ["k"], ["g"]).collect() == []
    assert exact_quantiles(empty, "k", [0.5], ["g"]).collect() == []


@pytest.mark.parametrize("accuracy", [5, 50, 10_000])
def test_quantiles_with_a_hot_value_and_a_hot_group(spark, accuracy):
    rng = random.Random(2)
    rows = [("a" if i % 3 else "b", 0.0 if i % 3 == 1 else rng.gauss(0, 1000)) for i in range(2000)]
    rows += [("c", 5.0), (None, 1.0), (None, 2.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"], accuracy).collect()
    assert len(got) == 4 * len(probs)
    for r in got:
        values = [v for g, v in rows if g == r.g and v is not None]
        assert r["quantile"] == pytest.approx(np.quantile(values, r.prob), rel=1e-12, abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_of_anything(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.prob: r["quantile"] for r in exact_quantiles(df, "v", [0.25, 0.5, 0.9], accuracy=5).collect()}
    for prob, quantile in got.items():
        assert quantile == pytest.approx(np.quantile(values, prob))
