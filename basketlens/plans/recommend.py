"""Queries for similarity, models, sequences and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.numeric import round_half_up
from basketlens.functions.vectors import cosine_similarity
from basketlens.operators import features as f
from basketlens.operators import recommend as r
from basketlens.operators import sequences as s
from basketlens.operators.similarity import top_k_products, top_k_similar
from basketlens.operators.staging import staged
from basketlens.plans.features import HYBRID, HYBRID_COLUMNS, HYBRID_SIZE, PRODUCT_MEANS
from basketlens.plans.registry import query
from basketlens.plans.tables import model, over_model, round_sql, training_sql
from basketlens.sources.adapter import table

EMBEDDING_SIZE = 64
TRAINERS = 8  # partitions trained side by side; the vectors depend on it
SEQUENCE_COLUMNS = ["Customer_ID", *s.ORDER, "Products"]
EVALUATION_COLUMNS = [*SEQUENCE_COLUMNS, "Product_Category", "Products_Index"]


def _embeddings(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return rows.withColumn("embedding", F.col("embedding").cast("array<double>"))


def _label_means(embeddings):
    return f.mean_vectors(embeddings, ["label"], "embedding", "label_vector")


VECTORS = """vectors AS (SELECT vec_id, label, cast(embedding AS double[]) AS embedding FROM embeddings),
label_means AS (SELECT label, list(x ORDER BY place) AS label_vector FROM (
  SELECT label, place, avg(x) AS x FROM (
    SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM vectors) e
  GROUP BY label, place) m GROUP BY label)"""


@query("cosine_pairs", f"""WITH {VECTORS}
SELECT vec_id, label, {round_sql("list_cosine_similarity(embedding, label_vector)", 6)} AS similarity
FROM vectors JOIN label_means USING (label)""")
def cosine_pairs(spark, sf_dir):
    embeddings = _embeddings(spark, sf_dir)
    pairs = embeddings.join(staged(_label_means(embeddings)), "label")
    similarity = cosine_similarity(F.col("embedding"), F.col("label_vector"))
    return pairs.select("vec_id", "label", round_half_up(similarity, 6).alias("similarity"))


def _top5_sql(query_id: str, item_id: str, scored: str) -> str:
    """``scored``: a SELECT of query_id, item_id, similarity."""
    return f"""
SELECT {query_id}, {item_id}, {round_sql("similarity", 6)} AS similarity, cast(place AS int) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {query_id} ORDER BY similarity DESC, {item_id}) AS place FROM (
    SELECT {query_id}, {item_id}, max(similarity) AS similarity FROM ({scored}) s GROUP BY 1, 2) m
) p WHERE place <= 5"""


def _rounded(top):
    return top.withColumn("similarity", round_half_up(F.col("similarity"), 6))


@query("embedding_top5", f"WITH {VECTORS}" + _top5_sql("vec_id", "label", """
SELECT vec_id, m.label, list_cosine_similarity(embedding, label_vector) AS similarity
FROM vectors v CROSS JOIN label_means m"""))
def embedding_top5(spark, sf_dir):
    embeddings = _embeddings(spark, sf_dir)
    return _rounded(top_k_similar(embeddings.select("vec_id", "embedding"), _label_means(embeddings)))


@query("nearest_embeddings", f"WITH {VECTORS}" + _top5_sql("label", "vec_id", """
SELECT m.label, vec_id, list_cosine_similarity(embedding, label_vector) AS similarity
FROM vectors v CROSS JOIN label_means m"""))
def nearest_embeddings(spark, sf_dir):
    embeddings = _embeddings(spark, sf_dir)
    items = embeddings.select("vec_id", "embedding")
    return _rounded(top_k_similar(_label_means(embeddings), items))


# Given factors in place of fitted ones: the search behind the recommendations for every customer.
@query("factor_top5", f"WITH {VECTORS}" + _top5_sql("label", "vec_id", """
SELECT m.label, vec_id, list_inner_product(embedding, label_vector) AS similarity
FROM vectors v CROSS JOIN label_means m"""))
def factor_top5(spark, sf_dir):
    embeddings = _embeddings(spark, sf_dir)
    best = top_k_products(_label_means(embeddings), embeddings.select("vec_id", "embedding"))
    return _rounded(best.withColumnRenamed("product", "similarity"))


def _hybrid_lists(source: str, keep: str) -> str:
    cells = ", ".join(f"v{i}" for i in range(HYBRID_SIZE))
    return f"SELECT {keep}, [{cells}] AS v FROM {source}"


@query("hybrid_top5", over_model(
    f"{HYBRID}{PRODUCT_MEANS}" + _top5_sql("Customer_ID", "Products", f"""
SELECT u.Customer_ID, p.Products, list_cosine_similarity(u.v, p.v) AS similarity
FROM ({_hybrid_lists("hybrid", "Customer_ID")}) u CROSS JOIN ({_hybrid_lists("product_means", "Products")}) p""")
))
def hybrid_top5(spark, sf_dir):
    hybrid = f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS))
    means = f.mean_vectors(hybrid, ["Products"], "hybrid_vector", "product_vector", HYBRID_SIZE)
    return _rounded(top_k_similar(hybrid.select("Customer_ID", "hybrid_vector"), means))


@query("hybrid_top5_repeats", over_model(f"""{HYBRID}{PRODUCT_MEANS}
SELECT Customer_ID, {round_sql("similarity", 6)} AS similarity, cast(place AS int) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY similarity DESC) AS place FROM (
    SELECT u.Customer_ID, list_cosine_similarity(u.v, p.v) AS similarity
    FROM ({_hybrid_lists("hybrid", "Customer_ID")}) u CROSS JOIN ({_hybrid_lists("product_means", "Products")}) p) m
) t WHERE place <= 5"""))
def hybrid_top5_repeats(spark, sf_dir):
    """The five best (vector, product) pairs of a customer: a product may come up repeatedly."""
    hybrid = f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS))
    means = f.mean_vectors(hybrid, ["Products"], "hybrid_vector", "product_vector", HYBRID_SIZE)
    top = top_k_similar(hybrid.select("Customer_ID", "hybrid_vector"), means, distinct=False)
    return _rounded(top).select("Customer_ID", "similarity", "rank")


def _als_top5(spark, sf_dir, rating):
    rows = model(
        spark, sf_dir, "Customer_ID", "Products_Index", "Products", "Transaction_ID", rating
    )
    train, _ = f.train_test_split(rows)
    return r.recommend_for_all(r.fit_als(train, rating), f.product_lookup(rows))


@query("als_top5")
def als_top5(spark, sf_dir):
    return _als_top5(spark, sf_dir, "Ratings")


@query("als_feedback_top5")
def als_feedback_top5(spark, sf_dir):
    return _als_top5(spark, sf_dir, "Feedback_Rating")


@query("als_combined_top5")
def als_combined_top5(spark, sf_dir):
    return _als_top5(spark, sf_dir, "Combined_Rating")


RATINGS = ["Ratings", "Feedback_Rating", "Combined_Rating"]


@query("als_rmse")
def als_rmse(spark, sf_dir):
    """The error on the held-out rows, for each of the three ratings."""
    columns = ["Customer_ID", "Products_Index", "Transaction_ID", *RATINGS]
    train, test = f.train_test_split(model(spark, sf_dir, *columns))
    errors = [
        r.rmse(r.predict(r.fit_als(train, rating), test), rating).select(F.lit(rating).alias("rating"), "rmse")
        for rating in RATINGS
    ]
    return reduce(DataFrame.unionByName, errors)


@query("als_top5_shape", over_model(f"""
SELECT cast(Customer_ID AS int) AS Customer_ID, cast(5 AS bigint) AS items, cast(1 AS int) AS first_rank,
  cast(5 AS int) AS last_rank, cast(0 AS bigint) AS unknown_items
FROM (SELECT DISTINCT Customer_ID FROM model WHERE {training_sql("Transaction_ID")} AND Ratings IS NOT NULL) t"""))
def als_top5_shape(spark, sf_dir):
    """Five different known products, ranked 1 to 5, for every customer of the training part.

    Customers without any training row have no factors, so no recommendation either.
    """
    return _als_top5(spark, sf_dir, "Ratings").groupBy("Customer_ID").agg(
        F.count_distinct("Products_Index").alias("items"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.count_if(F.col("Products").isNull()).alias("unknown_items"),
    )


@query("kmeans_shape", over_model("""
SELECT cast(5 AS bigint) AS clusters, count(DISTINCT Customer_ID) AS customers, true AS better_than_one FROM model"""))
def kmeans_shape(spark, sf_dir):
    """Five clusters with every customer in them, closer to their centres than to the mean."""
    _, vectors = _user_vectors(spark, sf_dir)
    fitted = r.fit_clusters(vectors)
    labels = r.assign_clusters(fitted, vectors)
    one = r.cost_around_mean(vectors)
    return labels.agg(
        F.count_distinct("cluster").alias("clusters"),
        F.count_distinct("Customer_ID").alias("customers"),
        F.lit(fitted.summary.trainingCost < one).alias("better_than_one"),
    )


@query("word2vec_shape", over_model("""
SELECT DISTINCT Products, cast(50 AS int) AS size FROM model WHERE Products IS NOT NULL AND Customer_ID IN (
  SELECT Customer_ID FROM model WHERE Products IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)"""))
def word2vec_shape(spark, sf_dir):
    """A vector of the asked size for every product of a sequence."""
    sentences = staged(s.training_sentences(s.purchase_sequences(model(spark, sf_dir, *SEQUENCE_COLUMNS))))
    vectors = s.embedding_table(s.fit_embeddings(sentences, TRAINERS))
    return vectors.select("Products", F.size("embedding").alias("size"))


# The prediction checked in SQL is the mean rating of the product.
@query("rmse", over_model(f"""
, by_product AS (SELECT Products, avg(Ratings) AS prediction FROM model GROUP BY 1)
SELECT {round_sql("sqrt(avg((Ratings - prediction) * (Ratings - prediction)))", 6)} AS rmse
FROM model JOIN by_product USING (Products)"""))
def rmse(spark, sf_dir):
    rows = model(spark, sf_dir, "Products", "Ratings")
    means = rows.groupBy("Products").agg(F.avg("Ratings").alias("prediction"))
    return r.rmse(rows.join(staged(means), "Products"), "Ratings")


def _user_vectors(spark, sf_dir):
    hybrid = staged(f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS)))
    return hybrid, staged(f.distinct_user_vectors(hybrid))


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    _, vectors = _user_vectors(spark, sf_dir)
    labels = r.assign_clusters(r.fit_clusters(vectors), vectors)
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("vectors"))


@query("kmeans_popular")
def kmeans_popular(spark, sf_dir):
    hybrid, vectors = _user_vectors(spark, sf_dir)
    labels = r.assign_clusters(r.fit_clusters(vectors), vectors)
    return r.popular_by_cluster(hybrid, labels.select("Customer_ID", "cluster"))


# The label checked in SQL is the quarter of the purchase.
@query("popular_by_cluster", over_model(f"""
, labels AS (SELECT Customer_ID, cast(ceil(Month_Index / 3) AS int) AS cluster FROM model)
SELECT cluster, Products, {round_sql("avg(Combined_Rating)", 6)} AS avg_rating
FROM model JOIN labels USING (Customer_ID) GROUP BY 1, 2"""))
def popular_by_cluster(spark, sf_dir):
    columns = ["Customer_ID", "Products", "Combined_Rating", "Month_Index"]
    rows = model(spark, sf_dir, *columns)
    quarter = F.ceil(F.col("Month_Index") / 3).cast("int").alias("cluster")
    return r.popular_by_cluster(rows, rows.select("Customer_ID", quarter))


@query("purchase_sequences", over_model("""
SELECT * FROM (SELECT Customer_ID, count(*) OVER (PARTITION BY Customer_ID) AS seq_length, row_number() OVER (
  PARTITION BY Customer_ID ORDER BY Year, Month_Index, Transaction_ID) AS position, Products
FROM model WHERE Products IS NOT NULL) q WHERE seq_length >= 2"""))
def purchase_sequences(spark, sf_dir):
    return s.purchase_sequences(model(spark, sf_dir, *SEQUENCE_COLUMNS))


@query("ordered_purchases", over_model("""
SELECT Customer_ID, Products, row_number() OVER (
  PARTITION BY Customer_ID ORDER BY Year, Month_Index, Transaction_ID) AS position
FROM model WHERE Products IS NOT NULL"""))
def ordered_purchases(spark, sf_dir):
    return s.ordered_purchases(model(spark, sf_dir, *SEQUENCE_COLUMNS))


CATEGORIES = """categories AS (SELECT Products, Product_Category FROM (
  SELECT *, row_number() OVER (PARTITION BY Products ORDER BY n DESC, Product_Category) AS rn FROM (
    SELECT Products, Product_Category, count(*) AS n FROM model WHERE Products IS NOT NULL GROUP BY 1, 2) c
  ) r WHERE rn = 1)"""


@query("product_category", over_model(f", {CATEGORIES} SELECT * FROM categories"))
def product_category(spark, sf_dir):
    return s.product_categories(model(spark, sf_dir, "Products", "Product_Category"))


PLACED = """placed AS (SELECT Customer_ID, Products, Product_Category,
  row_number() OVER (PARTITION BY Customer_ID ORDER BY Year, Month_Index, Transaction_ID) AS place,
  count(*) OVER (PARTITION BY Customer_ID) AS seq_length FROM model WHERE Products IS NOT NULL),
actual AS (SELECT Customer_ID, Products AS actual_item, seq_length FROM placed
  WHERE place = seq_length AND seq_length >= 2),
training AS (SELECT DISTINCT Customer_ID, Products FROM placed WHERE place < seq_length)"""


@query("leave_one_out", over_model(f""", {PLACED}
SELECT a.Customer_ID, actual_item, a.seq_length, count(*) AS training_products
FROM actual a JOIN training t ON a.Customer_ID = t.Customer_ID GROUP BY 1, 2, 3"""))
def leave_one_out(spark, sf_dir):
    rows = model(spark, sf_dir, *SEQUENCE_COLUMNS)
    last = s.last_purchases(rows)
    products = s.training_products(rows, last).groupBy("Customer_ID").agg(
        F.count(F.lit(1)).alias("training_products")
    )
    return last.join(products, "Customer_ID")


# Fixed product vectors for the SQL checks: product i has the vector with vec_id i. Vectors whose
# vec_id is no product index have no product to stand for.
FIXED = f"""{PLACED}, {CATEGORIES},
product_vectors AS (SELECT DISTINCT Products, cast(embedding AS double[]) AS embedding
  FROM model JOIN embeddings ON vec_id = Products_Index),
user_vectors AS (SELECT Customer_ID, list(x ORDER BY place) AS v FROM (
  SELECT Customer_ID, place, avg(x) AS x FROM (
    SELECT Customer_ID, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place
    FROM training JOIN product_vectors USING (Products)) e GROUP BY 1, 2) m GROUP BY 1)"""
NEAREST = _top5_sql("Customer_ID", "Products", """
SELECT Customer_ID, Products, list_cosine_similarity(v, embedding) AS similarity
FROM user_vectors CROSS JOIN product_vectors""")
HITS = f"""{FIXED}, nearest AS ({NEAREST}),
hits AS (SELECT a.Customer_ID, actual_item, c.Product_Category AS actual_cat,
  count(*) FILTER (WHERE p.Product_Category = c.Product_Category) AS cat_hits
FROM actual a JOIN categories c ON actual_item = c.Products
JOIN nearest n ON a.Customer_ID = n.Customer_ID JOIN categories p ON n.Products = p.Products
GROUP BY 1, 2, 3)"""


def _fixed_vectors(rows, spark, sf_dir):
    vectors = _embeddings(spark, sf_dir).withColumnRenamed("vec_id", "Products_Index")
    named = f.product_lookup(rows).join(vectors, "Products_Index")
    return staged(named.select("Products", "embedding"))


@query("user_embeddings", over_model(f", {FIXED} SELECT Customer_ID, " + ", ".join(
    f"{round_sql(f'v[{i + 1}]', 6)} AS e{i}" for i in range(EMBEDDING_SIZE)
) + " FROM user_vectors"))
def user_embeddings(spark, sf_dir):
    rows = model(spark, sf_dir, *EVALUATION_COLUMNS)
    vectors = s.user_embeddings(rows, _fixed_vectors(rows, spark, sf_dir))
    return vectors.select("Customer_ID", *f.spread("user_vector", EMBEDDING_SIZE, "e"))


@query("nearest_products", over_model(f", {FIXED} {NEAREST}"))
def nearest_products(spark, sf_dir):
    rows = model(spark, sf_dir, *EVALUATION_COLUMNS)
    return _rounded(s.nearest_products(rows, _fixed_vectors(rows, spark, sf_dir)))


@query("category_hits", over_model(f", {HITS} SELECT * FROM hits"))
def category_hits(spark, sf_dir):
    rows = model(spark, sf_dir, *EVALUATION_COLUMNS)
    return s.category_hits(rows, _fixed_vectors(rows, spark, sf_dir))


@query("hit_rate", over_model(f""", {HITS}
SELECT {round_sql("avg(cat_hits)", 6)} AS avg_category_hits, {round_sql("avg(cat_hits) / 5", 6)} AS category_hit_rate
FROM hits"""))
def hit_rate(spark, sf_dir):
    rows = model(spark, sf_dir, *EVALUATION_COLUMNS)
    return s.hit_rate(s.category_hits(rows, _fixed_vectors(rows, spark, sf_dir)))


@query("word2vec_hit_rate")
def word2vec_hit_rate(spark, sf_dir):
    rows = model(spark, sf_dir, *EVALUATION_COLUMNS)
    sentences = staged(s.training_sentences(s.purchase_sequences(rows)))
    embeddings = staged(s.embedding_table(s.fit_embeddings(sentences, TRAINERS)))
    return s.hit_rate(s.category_hits(rows, embeddings))
