import datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from __spark_entry__ import queries
from basketlens.functions.dates import date_prefix, parse_timestamp
from basketlens.functions.labels import age_group, feedback_rating, income_score, month_index
from basketlens.functions.numeric import exact_avg, exact_sum, round_half_up
from basketlens.operators import cleaning as c
from basketlens.operators import staging
from basketlens.operators.staging import staged
from basketlens.plans.tables import ROW_KEY, clean_table
from basketlens.schema import CLEAN_COLUMNS
from basketlens.schema import (
    MissingColumns,
    TYPED_SCHEMA,
    apply_schema,
    drop_required,
    require_columns,
)
from basketlens.sources.adapter import retail

PROFILE_SCHEMA = (
    "Customer_ID long, Country string, Gender string, Customer_Segment string, Age int, Income string"
)


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_month_labels(spark):
    df = one_column(spark, ["January", "1.0", "1", "12.0", "Foo", "13", "1.5", None])
    got = [r[0] for r in df.select(month_index(F.col("x"))).collect()]
    assert got == [1, 1, 1, 12, 0, 0, 0, 0]
    numbers = one_column(spark, [1, 12, 0, None], "int")
    assert [r[0] for r in numbers.select(month_index(F.col("x"))).collect()] == [1, 12, 0, 0]


def test_date_texts(spark):
    texts = ["9/18/2023", "2023-09-18", "2023-09-18 22:03:55", "22:03:55", "x", None]
    df = one_column(spark, texts)
    day = datetime.datetime(2023, 9, 18)
    rows = df.select(
        parse_timestamp(F.col("x")).cast("timestamp_ntz"), date_prefix(F.col("x"))
    ).collect()
    assert [r[0] for r in rows] == [day, day, day.replace(hour=22, minute=3, second=55), None, None, None]
    assert [r[1] for r in rows] == [None, day.date(), day.date(), None, None, None]


def test_labels(spark):
    df = one_column(spark, ["Low", "Medium", "High", None, "Weird"])
    assert [r[0] for r in df.select(income_score(F.col("x"))).collect()] == [1, 2, 3, 2, None]
    df = one_column(spark, ["Bad", "Excellent", "Odd", None])
    assert [r[0] for r in df.select(feedback_rating(F.col("x"))).collect()] == [1, 4, None, None]
    ages = one_column(spark, [30, 39, 5, None], "int")
    assert [r[0] for r in ages.select(age_group(F.col("x"))).collect()] == ["30-39", "30-39", "0-9", ""]


def test_rounding_is_half_up(spark):
    df = one_column(spark, [2.5, 3.5, 1.005, -2.5, None], "double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 0)).collect()]
    assert got == [3.0, 4.0, 1.0, -3.0, None]
    df = one_column(spark, [1.005, 0.00499999999999], "double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()] == [1.01, 0.0]


def test_rounding_keeps_large_numbers(spark):
    df = one_column(spark, [1e25, float("nan")], "double")
    large, missing = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert large == 1e25 and missing != missing


def test_exact_sums(spark):
    df = one_column(spark, [0.1] * 1000 + [float("nan"), None], "double")
    assert tuple(df.agg(exact_sum(F.col("x")), exact_avg(F.col("x"))).head()) == (100.0, 0.1)
    small = one_column(spark, [0.004] * 1000, "double")
    assert small.agg(exact_sum(F.col("x"))).head()[0] == 4.0
    with pytest.raises(ArithmeticException):
        one_column(spark, [1e20], "double").agg(exact_sum(F.col("x"))).collect()


def test_quantity_from_total(spark):
    rows = [(None, 10.0, 25.0), (None, 0.0, 25.0), (None, None, 25.0), (None, -10.0, 25.0),
            (7.0, 10.0, 25.0), (None, 10.0, 35.0)]
    df = spark.createDataFrame(rows, "Total_Purchases double, Amount double, Total_Amount double")
    got = [r.Total_Purchases for r in c.derive_quantity(df).collect()]
    assert got == [3.0, None, None, -3.0, 7.0, 4.0]


def test_profile_branches(spark):
    rows = [
        (1, "FR", "Male", "New", 30, "Low"), (1, "FR", "Male", "New", 30, "High"),
        (1, "DE", None, "Old", 41, None),                                  # repeated values
        (2, "FR", "Male", "New", 30, "High"), (2, "DE", "Female", "Old", 41, "High"),  # none repeated
        (3, "FR", "Male", None, 20, "Low"), (3, "FR", "Male", None, 20, "Low"),
        (3, "DE", "Female", None, 19, "Low"), (3, "DE", "Female", None, 19, "Low"),    # ties
        (4, None, None, None, 55, "Weird"),                                # nothing known
    ]
    got = {r.Customer_ID: r[1:] for r in c.customer_profile(spark.createDataFrame(rows, PROFILE_SCHEMA)).collect()}
    assert got == {
        1: ("FR", "Male", "New", 30, 2.0),
        2: ("USA", "Female", "Regular", 36, 3.0),
        3: ("DE", "Female", "Regular", 19, 1.0),
        4: ("USA", "Female", "Regular", 55, None),
    }


def test_age_ties_go_to_the_smaller_number(spark):
    rows = [(1, None, None, None, a, None) for a in (100, 100, 99, 99)]
    df = spark.createDataFrame(rows, PROFILE_SCHEMA)
    assert c.customer_profile(df).head().Age == 99


def test_drop_any_of_a_subset(spark):
    rows = [(1, 1), (1, None), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "Customer_ID long, Age int")
    assert c.drop_unattributed(df).count() == 1


def test_strict_cleaning(spark, sf_dir):
    raw = retail(spark, sf_dir)
    doubled = raw.unionAll(raw)
    assert c.clean_strict(doubled).count() == c.clean_strict(raw).count()
    cleaned = c.clean_strict(raw)
    assert cleaned.dropna().count() == cleaned.count()
    assert "Email" not in cleaned.columns
    with pytest.raises(MissingColumns):
        c.clean_strict(raw.drop("Email"))


def test_duplicate_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, 2), (1, 3)], "a int, b int")
    assert df.dropDuplicates().count() == 3


def test_time_source_replaces_the_date(spark):
    rows = [("2020-01-01", "2021-05-06 10:00:00", None, None), ("2020-01-01", "10:00:00", None, None)]
    df = spark.createDataFrame(rows, "Date string, Time string, Year int, Month int")
    got = c.fill_year_month(df, source="time").select("Year", "Month").collect()
    assert [tuple(r) for r in got] == [(2021, 5), (None, None)]
    got = c.fill_year_month(df, source="date").select("Year", "Month").collect()
    assert [tuple(r) for r in got] == [(2020, 1), (2020, 1)]


def test_time_helps_out_where_there_is_no_date(spark):
    rows = [("2020-01-01", "2021-05-06 10:00:00"), (None, "2021-05-06 10:00:00"), ("x", "10:00:00")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "Date string, Time string, Year int, Month int")
    got = c.fill_year_month(df, source="either").select("Year", "Month").collect()
    assert [tuple(r) for r in got] == [(2020, 1), (2021, 5), (None, None)]


def test_only_what_is_wanted_is_built(spark, sf_dir):
    raw = retail(spark, sf_dir)
    whole = c.clean(staged(raw), ROW_KEY)
    for columns in (["products", "Ratings"], ["Customer_ID", "Income"], ["Transaction_ID", "Year"]):
        some = c.clean(raw, ROW_KEY, sort=False, columns=columns)
        assert some.columns == [x for x in whole.columns if x in columns]
        assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*some.columns).collect()))


def test_steps_are_counted_by_the_steps(spark, sf_dir):
    raw = staged(retail(spark, sf_dir))
    got = {r.step: r.row_count for r in c.clean_step_counts(raw, ROW_KEY).collect()}
    dated = c.drop_undated(c.fill_year_month(raw))
    assert list(got) == c.STEPS
    assert got["initial"] == got["dates_processed"] == raw.count()
    assert got["undated_dropped"] == got["quantity_derived"] == dated.count()
    assert got["final"] == got["unattributed_dropped"] == c.drop_unattributed(dated).count()


def test_month_as_text_stays_text(spark):
    df = spark.createDataFrame([("2020-03-01", "t", 2020, None), ("2020-03-01", "t", 2020, "May")],
                               "Date string, Time string, Year int, Month string")
    assert [r.Month for r in c.fill_year_month(df).collect()] == ["3", "May"]


def test_missing_columns_fail_early(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for build in (
        lambda: require_columns(df, ["b"]),
        lambda: drop_required(df, ["b"]),
        lambda: apply_schema(df),
        lambda: c.clean(df, ["a"]),
    ):
        with pytest.raises(MissingColumns):
            build()
    assert require_columns(df, ["A"]) is df


def test_schema_casts_bad_text_to_null(spark):
    raw = spark.createDataFrame(
        [tuple("x" for _ in TYPED_SCHEMA)], ", ".join(f"{n} string" for n in TYPED_SCHEMA.names)
    )
    row = apply_schema(raw).head()
    assert row.Age is None and row.Amount is None and row.Date is None and row.Name == "x"


def test_clean_does_not_depend_on_partitions_or_buckets(spark, sf_dir):
    raw = retail(spark, sf_dir)
    expected = sorted(map(str, c.clean(raw, ROW_KEY).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = c.clean(raw.repartition(int(partitions)), ROW_KEY)
            assert sorted(map(str, got.collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_clean_is_sorted(spark, sf_dir):
    rows = c.clean(retail(spark, sf_dir), ROW_KEY).select("Customer_ID", "Transaction_ID").collect()
    assert rows == sorted(rows)


def test_customer_with_a_third_of_all_rows_is_split(spark):
    """Adaptive execution cuts the partition of the large customer in the profile join."""
    n = 300_000
    customer = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    df = spark.range(n).select(
        customer.alias("Customer_ID"),
        F.lit("FR").alias("Country"), F.lit("Male").alias("Gender"),
        F.lit("New").alias("Customer_Segment"), (20 + F.col("id") % 2).cast("int").alias("Age"),
        F.lit("Low").alias("Income"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        result = c.apply_profile(df, staged(c.customer_profile(df)))
        assert len(result.collect()) == n
        assert "skew=true" in result._jdf.queryExecution().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_what_the_profile_replaces_is_not_dealt_with_the_rows(spark, sf_dir, monkeypatch):
    seen = []
    plain = c.renumber
    monkeypatch.setattr(c, "renumber", lambda df, order: seen.append(df.columns) or plain(df, order))
    result = clean_table(spark, sf_dir)
    assert not {"Country", "Gender", "Customer_Segment", "Income"}.intersection(seen[0]) and "Age" in seen[0]
    assert result.columns == CLEAN_COLUMNS


def test_rows_that_come_twice_are_not_joined_twice(spark, sf_dir):
    plan = queries()["dedupe_rows"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1


def test_steps_are_counted_without_storing_what_no_step_reads(spark, sf_dir):
    before = len(staging._STAGED)
    queries()["clean_step_counts"](spark, sf_dir)
    stored = [spark.read.parquet(path).columns for path in staging._STAGED[before:]]
    assert stored and all("Email" not in columns for columns in stored)
