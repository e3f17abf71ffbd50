import math

import pytest
from pyspark.sql import functions as F

from basketlens.operators import profiling as p
from basketlens.operators import reports as r
from basketlens.operators.crosstab import Spec, crosstab, crosstab_many, pivot_wide
from basketlens.plans import reports


@pytest.fixture(scope="module")
def nan_rows(spark):
    rows = [(float("nan"), 1, "a"), (None, 2, None), (0.0, None, "a"), (-0.0, 4, "b")]
    return spark.createDataFrame(rows, "x double, n int, s string").withColumn(
        "at", F.current_timestamp()
    )


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_null_counts(nan_rows):
    assert as_dict(p.null_counts(nan_rows)) == {"x": 1, "n": 1, "s": 1, "at": 0}
    assert as_dict(p.null_nan_counts(nan_rows)) == {"x": 2, "n": 1, "s": 1, "at": 0}


def test_distinct_counts(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("a"), F.lit(None).cast("int").alias("b"), "id")
    assert as_dict(p.distinct_counts(df)) == {"a": 7, "b": 0, "id": 3000}
    odd = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (1.0,), (None,)], "x double")
    assert as_dict(p.distinct_counts(odd)) == {"x": 2}
    rough = as_dict(p.distinct_counts(df, approximate=True))
    assert rough["a"] == 7 and rough["id"] == pytest.approx(3000, rel=0.1)


def test_value_counts_keeps_or_drops_nulls(nan_rows):
    assert as_dict(p.value_counts(nan_rows, "s")) == {"a": 2, "b": 1, None: 1}
    assert as_dict(p.value_counts(nan_rows, "s", dropna=True)) == {"a": 2, "b": 1}


def test_histogram_keeps_every_positive_value_and_empty_bins(spark):
    values = [1.0, 10.0, 10.0, 100.0, 1000.0, 0.0, -5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = p.log_histogram(df, "v", bins=3).orderBy("bin").collect()
    assert [row["count"] for row in rows] == [1, 2, 2]
    assert rows[0].low == 0.0 and rows[-1].high == 3.0
    single = spark.createDataFrame([(10.0,)], "v double")
    assert sum(row["count"] for row in p.log_histogram(single, "v", bins=4).collect()) == 1


def test_density_is_that_of_the_definition(spark):
    values = [1.0, 2.0, 4.0, 8.0, 8.0, 16.0, 300.0]
    logs = [math.log10(v) for v in values]
    mean = sum(logs) / len(logs)
    h = (sum((x - mean) ** 2 for x in logs) / (len(logs) - 1)) ** 0.5 * len(logs) ** -0.2
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = p.log_density(df, "v", points=50).collect()
    assert len(rows) == 50
    for row in rows:
        want = sum(math.exp(-0.5 * ((row.x - x) / h) ** 2) for x in logs)
        assert row.density == pytest.approx(want / (len(logs) * h * math.sqrt(2 * math.pi)), rel=1e-6)


def test_density_without_spread_is_empty(spark):
    assert p.log_density(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v").collect() == []


def test_statistics_keep_all_digits(spark):
    df = spark.createDataFrame([(123456789.123456,)], "v double")
    assert p.describe(df).head()["mean"] == 123456789.123456
    assert p.describe_quartiles(df).head()["median"] == 123456789.123456


def test_box_outliers(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 7.0), ("a", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    a, b = p.box_summary(df, "g", "v").orderBy("g").collect()
    assert (a.q1, a.median, a.q3) == (2.25, 3.5, 4.75)
    assert (a.whisker_low, a.whisker_high, a.outliers) == (1.0, 5.0, 1)
    assert (b.q1, b.q3, b.outliers, b["count"]) == (7.0, 7.0, 0, 1)


def test_months_written_in_any_way_are_one_month(spark):
    rows = [("January", "b", 1.0), ("1", "b", 2.0), ("1.0", "b", 4.0), ("May", "c", 8.0)]
    df = spark.createDataFrame(rows, "Month string, Product_Brand string, Total_Purchases double")
    assert as_dict(r.monthly_quantity(df)) == {1: 7.0, 5: 8.0}
    spec = Spec("Month", "Product_Brand", "Total_Purchases", "sum")
    assert {tuple(x) for x in crosstab(df, spec).collect()} == {(1, "b", 7.0), (5, "c", 8.0)}
    many = crosstab_many(df, [spec]).collect()
    assert {tuple(x) for x in many} == {
        ("month_brand_sum", "1", "b", 7.0), ("month_brand_sum", "5", "c", 8.0)
    }


def test_pivot_fills_and_keeps_null_labels(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", None, 2), ("y", "q", 3)], "r string, c string, v int")
    wide = pivot_wide(df, "r", "c", F.sum("v")).orderBy("r")
    assert wide.columns == ["r", "null", "p", "q"]
    assert [tuple(x) for x in wide.collect()] == [("x", 2, 1, 0), ("y", 0, 0, 3)]


def test_pivot_rejects_a_label_that_reads_null(spark):
    df = spark.createDataFrame([("x", "null", 1), ("x", None, 2)], "r string, c string, v int")
    with pytest.raises(Exception, match="reads 'null'"):
        pivot_wide(df, "r", "c", F.sum("v"))


def test_small_amounts_are_summed_before_they_are_rounded(spark):
    df = spark.createDataFrame([(1, 1.004)] * 1000, "Customer_ID long, Total_Amount double")
    assert as_dict(r.customer_spending(df)) == {1: 1004.0}
    assert as_dict(r.spend_tiers(df)) == {"Regular": 1}


def test_spend_tiers(spark):
    rows = [(1, 5000.0), (2, 5000.01), (3, 1000.0), (4, 1000.01), (5, None)]
    df = spark.createDataFrame(rows, "Customer_ID long, Total_Amount double")
    assert as_dict(r.spend_tiers(df)) == {"VIP": 1, "Regular": 2, "Low Spender": 2}


def test_declared_pivot_columns_do_not_depend_on_the_data(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "new", 2), ("x", None, 4), ("y", "newer", 8)], "r string, c string, v int")
    declared = ["b", "a"]
    rows = pivot_wide(df, "r", "c", F.sum("v"), declared).orderBy("r")
    assert rows.columns == ["r", "b", "a", "null", "other"]
    assert [tuple(r) for r in rows.collect()] == [("x", 0, 1, 4, 2), ("y", 0, 0, 0, 8)]
    few = pivot_wide(df.where("c = 'a'"), "r", "c", F.sum("v"), declared, nulls=False, other="rest")
    assert few.columns == ["r", "b", "a", "rest"] and [tuple(r) for r in few.collect()] == [("x", 0, 1, 0)]
    with pytest.raises(ValueError, match="named twice"):
        pivot_wide(df, "r", "c", F.sum("v"), ["a", "other"])


def test_declared_pivots_run_no_job_before_the_result(spark):
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivot-declared", "")
    df = spark.range(10).selectExpr("id % 2 as r", "cast(id % 3 as string) as c")
    pivot_wide(df, "r", "c", F.count(F.lit(1)), ["0", "1"])
    assert not status.getJobIdsForGroup("pivot-declared")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_every_country_has_a_column_of_its_own(spark, monkeypatch):
    rows = [("x", "USA", 1.0), ("x", "Atlantis", 2.0), ("x", "Utopia", 4.0), ("y", "Utopia", 8.0), ("y", None, 16.0)]
    table = spark.createDataFrame(rows, "Product_Category string, Country string, Total_Purchases double")
    monkeypatch.setattr(reports, "stored_retail", lambda *_: table)
    found = {r.Product_Category: r.asDict() for r in reports.pivot_category_country(spark, "").collect()}
    assert found["x"] == {"Product_Category": "x", "USA": 1.0, "Atlantis": 2.0, "Utopia": 4.0, "null": 0.0}
    assert found["y"] == {"Product_Category": "y", "USA": 0.0, "Atlantis": 0.0, "Utopia": 8.0, "null": 16.0}
