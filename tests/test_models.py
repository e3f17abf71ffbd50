import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from basketlens.operators import features as f
from basketlens.operators import recommend as r
from basketlens.operators import sequences as s
from basketlens.operators.staging import staged
from basketlens.plans.tables import model


@pytest.fixture(scope="module")
def rows(spark):
    return model(spark, "/root/testdata/sf0.001")


def test_index_order_is_that_of_the_library(spark):
    values = ["b", "b", "a", "c", "c", None, "d"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    indices = staged(f.value_indices(df, ["v"]))
    ours = f.attach_indices(df, indices, ["v"])
    theirs = StringIndexer(inputCol="v", outputCol="k", handleInvalid="keep").fit(df).transform(df)
    got = ours.join(theirs.select("i", "k"), "i").select("v_index", "k").collect()
    assert len(got) == len(values) and all(x.v_index == x.k for x in got)


def test_values_known_to_be_unique_are_placed_by_their_text(spark):
    ids = [*range(1, 130), 1000, 1001, 200_000]
    cells = [(i, i % 7, f"n{i % 3}", "Good", 3.0) for i in ids]
    clean = staged(spark.createDataFrame(cells, "Transaction_ID long, Customer_ID long, products string, Feedback string, Ratings double"))
    wanted = ["Customer_ID", "Transaction_ID", "Products_Index", "Products", "Combined_Rating"]
    counted = f.model_table(clean, wanted)
    placed = f.model_table(clean, wanted, unique="Transaction_ID")
    assert placed.dtypes == counted.dtypes
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, counted.collect()))
    places = {x.Transaction_ID: x.i for x in f.place_by_text(clean, "Transaction_ID").withColumnRenamed("Transaction_ID_index", "i").collect()}
    assert [places[i] for i in sorted(ids, key=str)] == list(range(len(ids)))


def test_spread_elements_are_rounded_as_one_array(spark):
    df = spark.createDataFrame([(1, [0.1234565, 2.0, -0.0000005]), (2, [None, 1 / 3, 1e12]), (3, None)], "i int, v array<double>")
    spread = df.select("i", *f.spread("v", 3, "v"))
    each = df.select("i", *[F.round(F.col("v")[k], 6).alias(f"v{k}") for k in range(3)])
    assert sorted(map(tuple, spread.collect()), key=lambda x: x[0]) == sorted(map(tuple, each.collect()), key=lambda x: x[0])
    # One expression for the whole array, which generated code computes once.
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(v" in plan


def test_scaling_is_that_of_the_library(rows):
    columns = [*f.TRANSACTION_FEATURES, "constant"]
    df = rows.withColumn("constant", F.lit(3))
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(df)
    theirs = MinMaxScaler(inputCol="v", outputCol="s").fit(vectors).transform(vectors)
    ours = theirs.withColumn("a", f.scaled_array(df, columns))
    for x in ours.select("s", "a").collect():
        assert x.a == pytest.approx(x.s.toArray().tolist())


def test_hybrid_vector_equals_the_joined_form(rows):
    users = f.user_profiles(rows)
    user = users.select("Customer_ID", f.scaled_array(users, f.USER_FEATURES).alias("u"))
    parts = rows.select(
        "Transaction_ID", "Customer_ID",
        f.scaled_array(rows, f.TRANSACTION_FEATURES).alias("t"),
        f.scaled_array(rows, f.PRODUCT_FEATURES).alias("p"),
    )
    joined = parts.join(user, "Customer_ID").select(
        "Transaction_ID", F.concat("u", "t", "p").alias("expected")
    )
    both = f.hybrid_vectors(rows).join(joined, "Transaction_ID")
    assert both.count() == rows.count()
    assert both.where(F.col("hybrid_vector") != F.col("expected")).count() == 0


def test_split_does_not_depend_on_partitions(rows):
    train, test = f.train_test_split(rows)
    again, _ = f.train_test_split(rows.repartition(3))
    ids = {x[0] for x in train.select("Transaction_ID").collect()}
    assert ids == {x[0] for x in again.select("Transaction_ID").collect()}
    assert len(ids) + test.count() == rows.count()
    assert 0.77 < len(ids) / rows.count() < 0.83


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    ratings = rng.uniform(0.5, 1.5, (200, 2)) @ rng.uniform(0.5, 1.5, (2, 50))
    cells = [
        (int(u), int(i), float(ratings[u, i] + rng.normal(0, 0.01)), int(u * 50 + i))
        for u in range(200) for i in range(50) if rng.random() < 0.5
    ]
    schema = "Customer_ID int, Products_Index int, Ratings double, Transaction_ID long"
    return staged(spark.createDataFrame(cells, schema))


def test_als_beats_the_mean_and_recommends_to_all(spark, planted):
    train, test = f.train_test_split(planted)
    fitted = r.fit_als(train)
    predictions = r.predict(fitted, test)
    error = r.rmse(predictions, "Ratings").head().rmse
    mean = train.agg(F.avg("Ratings")).head()[0]
    baseline = r.rmse(test.withColumn("prediction", F.lit(mean)), "Ratings").head().rmse
    assert error < 0.6 * baseline
    library = RegressionEvaluator(metricName="rmse", labelCol="Ratings").evaluate(predictions)
    assert error == pytest.approx(library, abs=1e-6)

    names = spark.range(50).select(
        F.col("id").cast("int").alias("Products_Index"),
        F.concat(F.lit("p"), F.col("id")).alias("Products"),
    )
    top = r.recommend_for_all(fitted, names).collect()
    assert len(top) == 5 * train.select("Customer_ID").distinct().count()
    assert all(x.Products == f"p{x.Products_Index}" and 1 <= x.rank <= 5 for x in top)
    own = {x.Customer_ID: [(i.Products_Index, i.rating) for i in x.recommendations] for x in fitted.recommendForAllUsers(5).collect()}
    got = {}
    for x in sorted(top, key=lambda x: x["rank"]):
        got.setdefault(x.Customer_ID, []).append((x.Products_Index, x.predicted))
    assert got.keys() == own.keys()
    for customer, best in got.items():
        assert [v for _, v in best] == pytest.approx([v for _, v in own[customer]], rel=1e-5)
        assert len({i for i, _ in best} ^ {i for i, _ in own[customer]}) <= 2  # floats of 32 bits tie where these do not
    again = r.recommend_for_all(r.fit_als(train), names).collect()
    assert [x.Products_Index for x in sorted(top)] == [x.Products_Index for x in sorted(again)]


def test_clusters_of_separate_blobs(spark):
    rng = np.random.default_rng(6)
    centres = np.eye(5) * 20
    points = [(int(i), (centres[i % 5] + rng.normal(0, 0.3, 5)).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(points, "Customer_ID long, hybrid_vector array<double>")
    fitted = r.fit_clusters(vectors)
    found = np.array(fitted.clusterCenters())
    for x in r.assign_clusters(fitted, vectors).collect():
        distances = np.linalg.norm(found - np.array(x.hybrid_vector), axis=1)
        assert distances.argmin() == x.cluster
    array = np.array([v for _, v in points])
    assert fitted.summary.trainingCost < ((array - array.mean(axis=0)) ** 2).sum()


def test_popularity_equals_the_fan_out_join(spark):
    rng = np.random.default_rng(7)
    rated = spark.createDataFrame(
        [(int(rng.integers(12)), f"p{rng.integers(5)}", float(rng.integers(1, 6)) if rng.random() > 0.1 else None)
         for _ in range(400)], "Customer_ID long, Products string, Combined_Rating double")
    labels = spark.createDataFrame(
        [(int(rng.integers(12)), int(rng.integers(3))) for _ in range(60)],
        "Customer_ID long, cluster int")
    plain = rated.join(labels, "Customer_ID").groupBy("cluster", "Products").agg(F.avg("Combined_Rating"))
    want = {(x[0], x[1]): x[2] for x in plain.collect()}
    got = {(x[0], x[1]): x[2] for x in r.popular_by_cluster(rated, labels).collect()}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}


PURCHASES = [
    (1, 2020, 1, 5, "a"), (1, 2020, 1, 3, "b"), (1, 2019, 12, 9, "c"), (1, 2020, 2, 1, "a"),
    (2, 2020, 1, 1, "a"), (3, 2020, 1, 1, "a"), (3, 2020, 1, 2, "a"), (4, 2020, 1, 1, None),
    (4, 2020, 1, 2, "b"),
]


@pytest.fixture(scope="module")
def purchases(spark):
    return spark.createDataFrame(
        PURCHASES, "Customer_ID int, Year int, Month_Index int, Transaction_ID int, Products string")


def test_sequences(purchases):
    sequences = s.purchase_sequences(purchases)
    got = {(x.Customer_ID, x.position): (x.Products, x.seq_length) for x in sequences.collect()}
    assert got == {
        (1, 1): ("c", 4), (1, 2): ("b", 4), (1, 3): ("a", 4), (1, 4): ("a", 4), (3, 1): ("a", 2), (3, 2): ("a", 2)}
    pieces = s.training_sentences(sequences, most=3).collect()
    assert {(x.Customer_ID, x.piece): x.product_sequence for x in pieces} == {
        (1, 0): ["c", "b", "a"], (1, 1): ["a"], (3, 0): ["a", "a"]}


def test_a_customer_with_many_purchases_has_one_sequence(spark):
    rows = [(1, 2020, 1, i, f"p{i % 7}") for i in range(1001)]
    df = spark.createDataFrame(rows, "Customer_ID int, Year int, Month_Index int, Transaction_ID int, Products string")
    got = s.purchase_sequences(df).orderBy("position").collect()
    assert [(x.position, x.Products, x.seq_length) for x in got] == [(i + 1, f"p{i % 7}", 1001) for i in range(1001)]


def test_the_last_purchase_of_large_ids_and_null_dates(spark):
    big = 2**62
    rows = [(1, 2020, 1, big, "a"), (1, 2020, 1, big + 1, "b"), (1, None, 12, big + 2, "c"), (1, 2019, None, 5, "d")]
    df = spark.createDataFrame(rows, "Customer_ID int, Year int, Month_Index int, Transaction_ID long, Products string")
    assert [tuple(x) for x in s.last_purchases(df).select("actual_item", "seq_length").collect()] == [("b", 4)]


def test_rows_with_a_null_feature_are_skipped(spark, rows):
    some = rows.withColumn("Combined_Rating", F.when(F.col("Transaction_ID") > 10, F.col("Combined_Rating")))
    assert f.hybrid_vectors(some).count() == rows.where("Transaction_ID > 10").count()
    assert f.hybrid_vectors(some, nulls="keep").count() == rows.count()
    vectors = spark.createDataFrame([("a", [1.0, None]), ("a", [1.0, 3.0])], "g string, v array<double>")
    assert f.mean_vectors(vectors, ["g"], "v", "m").head().m == [1.0, 3.0]


def test_means_of_vectors_of_known_size(spark):
    cells = [("a", [i / 64, 1.0]) for i in (3, 50, 61, 7)] + [("b", None), ("b", [None, 1.0]), ("c", [0.5, -2.0]), ("b", [2.0, 4.0])]
    vectors = spark.createDataFrame(cells, "g string, v array<double>")
    means = {x.g: x.m for x in f.mean_vectors(vectors, ["g"], "v", "m", 2).collect()}
    assert means == {"a": [121 / 256, 1.0], "b": [2.0, 4.0], "c": [0.5, -2.0]}


def test_an_index_beyond_the_library_is_an_error(spark):
    train = spark.createDataFrame([(2**31, 1, 1.0)], "Customer_ID long, Products_Index long, Ratings double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        r.fit_als(train)


def test_leave_one_out(purchases):
    last = s.last_purchases(purchases)
    assert {x.Customer_ID: (x.actual_item, x.seq_length) for x in last.collect()} == {
        1: ("a", 4), 3: ("a", 2)}
    kept = s.training_products(purchases, last).collect()
    assert {(x.Customer_ID, x.Products) for x in kept} == {(1, "a"), (1, "b"), (1, "c"), (3, "a")}


def test_embeddings_of_every_product(rows):
    sequences = staged(s.training_sentences(s.purchase_sequences(rows)))
    first = s.embedding_table(s.fit_embeddings(sequences, size=10, partitions=1)).collect()
    again = s.embedding_table(s.fit_embeddings(sequences, size=10, partitions=1)).collect()
    assert {x.Products for x in first} == {
        x[0] for x in sequences.select(F.explode("product_sequence")).distinct().collect()}
    assert all(len(x.embedding) == 10 for x in first)
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_hit_rate(spark):
    hits = spark.createDataFrame([(1, 5), (2, 0), (3, 1)], "Customer_ID int, cat_hits long")
    assert tuple(s.hit_rate(hits).head()) == (2.0, 0.4)


def test_nobody_looks_for_nulls_where_rows_with_nulls_were_skipped(spark, rows):
    for nulls, looked_for in (("skip", False), ("keep", True)):
        hybrid = f.hybrid_vectors(rows, nulls=nulls)
        assert hybrid.schema["hybrid_vector"].dataType.containsNull == looked_for
        means = f.mean_vectors(hybrid, ["Products"], "hybrid_vector", "v", 16)
        plan = means._jdf.queryExecution().optimizedPlan().toString()
        assert ("exists(" in plan) == looked_for
