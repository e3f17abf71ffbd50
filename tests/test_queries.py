"""Every registered query against its SQL, on the smallest test tables."""

import sys

import pytest

import __spark_entry__ as entry
from basketlens.operators import staging
from basketlens.plans import load
from conftest import SF_DIR
from oracle import compare, connect

QUERIES, SQL = load().QUERIES, load().ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def check_plan(df):
    """No row-at-a-time Python, no product of tables, and one-task steps only over aggregates."""
    plan = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    for operator in ["BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert operator not in plan
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:
            assert "Aggregate" in below, below


@pytest.fixture
def stored_plans(monkeypatch):
    """Checks the plan of everything a query stores on its way."""
    new_path, seen = staging.new_path, []

    def checked(df, *partition_by):
        check_plan(df)
        seen.append(df)
        path = new_path(df.sparkSession)
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    for name, module in list(sys.modules.items()):
        if name.startswith("basketlens.") and getattr(module, "staged", None) is staging.staged:
            if module is not staging:
                monkeypatch.setattr(module, "staged", checked)
    return seen


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(name, spark, duck, stored_plans):
    with staging.staging(spark):
        df = QUERIES[name](spark, SF_DIR)
        check_plan(df)
        assert compare(df, duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_plans_of_the_trained_ones(name, spark, stored_plans):
    with staging.staging(spark):
        df = QUERIES[name](spark, SF_DIR)
        check_plan(df)
        assert df.count() and stored_plans


@pytest.mark.parametrize("name", ["rmse", "combined_rating"])
def test_nothing_is_built_that_is_not_wanted(name, spark, stored_plans):
    with staging.staging(spark):
        QUERIES[name](spark, SF_DIR)
    assert len(stored_plans) <= 2
    assert not any("monotonically" in df._jdf.queryExecution().toString() for df in stored_plans[:1] if name == "rmse")


def test_queries_without_sql_are_the_trained_or_hashed_ones():
    assert sorted(set(QUERIES) - set(SQL)) == [
        "als_combined_top5", "als_feedback_top5", "als_rmse", "als_top5", "kmeans_clusters",
        "kmeans_popular", "word2vec_hit_rate",
    ]
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_has_the_clean_columns(spark):
    from basketlens.schema import CLEAN_COLUMNS

    assert entry.entry(spark).columns == CLEAN_COLUMNS
