"""Queries for indices, ratings and feature vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions.labels import combined_rating, feedback_rating, month_index
from basketlens.operators import features as f
from basketlens.operators.staging import staged
from basketlens.plans.registry import query
from basketlens.plans.tables import (
    clean_table,
    model,
    over_clean,
    over_model,
    over_retail,
    rounded_sql,
    scaled_sql,
    training_sql,
)
from basketlens.schema import MODEL_COLUMNS
from basketlens.sources.adapter import retail

ID_COLUMNS = ["Customer_ID", "Transaction_ID"]
CATEGORY_COLUMNS = [c for c in f.INDEXED_COLUMNS if c not in ID_COLUMNS]
HYBRID_FEATURES = [*f.USER_FEATURES, *f.TRANSACTION_FEATURES, *f.PRODUCT_FEATURES]
HYBRID_SIZE = len(HYBRID_FEATURES)
HYBRID_COLUMNS = list(dict.fromkeys([*HYBRID_FEATURES, "Products"]))  # of the model table


def _indices_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", v AS value, cast(row_number() OVER (ORDER BY n DESC, v) - 1 AS bigint) AS "index"
        FROM (SELECT cast({c} AS varchar) AS v, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1) t"""
        for c in columns
    )


@query("index_categories", over_retail(_indices_sql("retail", CATEGORY_COLUMNS)))
def index_categories(spark, sf_dir):
    return f.value_indices(retail(spark, sf_dir), CATEGORY_COLUMNS)


@query("index_ids", over_retail(_indices_sql("retail", ID_COLUMNS)))
def index_ids(spark, sf_dir):
    return f.value_indices(retail(spark, sf_dir), ID_COLUMNS)


@query("replace_by_index", over_clean("""
, counted AS (SELECT *, count(*) OVER (PARTITION BY Country) AS nc, count(*) OVER (PARTITION BY Gender) AS ng FROM clean)
SELECT Transaction_ID, cast(dense_rank() OVER (ORDER BY nc DESC, Country) - 1 AS bigint) AS Country_index,
  cast(dense_rank() OVER (ORDER BY ng DESC, Gender) - 1 AS bigint) AS Gender_index FROM counted"""))
def replace_by_index(spark, sf_dir):
    columns = ["Country", "Gender"]
    clean = staged(clean_table(spark, sf_dir, columns=["Transaction_ID", *columns]))
    indices = staged(f.value_indices(clean, columns), "column")
    return f.attach_indices(clean, indices, columns).drop(*columns)


@query("feedback_rating", over_retail("""
SELECT Transaction_ID, Total_Amount, Feedback, CASE Feedback WHEN 'Bad' THEN 1.0::double
  WHEN 'Average' THEN 2.0::double WHEN 'Good' THEN 3.0::double WHEN 'Excellent' THEN 4.0::double END AS Feedback_Rating
FROM retail"""))
def feedback_ratings(spark, sf_dir):
    rating = feedback_rating(F.col("Feedback")).alias("Feedback_Rating")
    return retail(spark, sf_dir).select("Transaction_ID", "Total_Amount", "Feedback", rating)


@query("month_index", over_retail("""
SELECT Transaction_ID, Total_Amount, coalesce(Month, 0) AS from_number,
  CASE WHEN Date IS NULL THEN 0 ELSE cast(month(Date) AS int) END AS from_name FROM retail"""))
def month_indices(spark, sf_dir):
    return retail(spark, sf_dir).select(
        "Transaction_ID",
        "Total_Amount",
        month_index(F.col("Month")).alias("from_number"),
        month_index(F.date_format("Date", "MMMM")).alias("from_name"),
    )


@query("combined_rating", over_clean("""
SELECT Transaction_ID, 0.5::double * Ratings + 0.5::double * CASE Feedback WHEN 'Bad' THEN 1
  WHEN 'Average' THEN 2 WHEN 'Good' THEN 3 WHEN 'Excellent' THEN 4 END AS Combined_Rating FROM clean"""))
def combined_ratings(spark, sf_dir):
    rating = combined_rating(F.col("Ratings"), feedback_rating(F.col("Feedback")))
    rows = clean_table(spark, sf_dir, columns=["Transaction_ID", "Ratings", "Feedback"])
    return rows.select("Transaction_ID", rating.alias("Combined_Rating"))


@query("model_columns", over_model(f"SELECT {', '.join(MODEL_COLUMNS)} FROM model"))
def model_columns(spark, sf_dir):
    return model(spark, sf_dir).select(*MODEL_COLUMNS)


@query("product_lookup", over_model("SELECT DISTINCT Products_Index, Products FROM model"))
def product_lookup(spark, sf_dir):
    return f.product_lookup(model(spark, sf_dir, "Products", "Products_Index"))


@query("train_test_split", over_retail(f"""
SELECT Transaction_ID, Total_Amount, CASE WHEN {training_sql("Transaction_ID")} THEN 'train' ELSE 'test' END AS part
FROM retail"""))
def train_test_split(spark, sf_dir):
    train, test = f.train_test_split(retail(spark, sf_dir).select("Transaction_ID", "Total_Amount"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _features_sql(columns: list[str], keep: str) -> str:
    cells = ", ".join(f"cast({c} AS double) AS v{i}" for i, c in enumerate(columns))
    return f"SELECT {keep}, {cells} FROM model"


@query("user_profile", over_model(
    "SELECT DISTINCT * FROM (" + _features_sql(f.USER_FEATURES, "Customer_ID") + ") t"
))
def user_profile(spark, sf_dir):
    users = f.user_profiles(model(spark, sf_dir, *f.USER_FEATURES))
    vectors = users.select("Customer_ID", f.feature_array(f.USER_FEATURES).alias("v"))
    return vectors.select("Customer_ID", *f.spread("v", len(f.USER_FEATURES), "v"))


@query("product_features", over_model(_features_sql(f.PRODUCT_FEATURES, "Transaction_ID")))
def product_features(spark, sf_dir):
    vectors = model(spark, sf_dir, *f.PRODUCT_FEATURES).select(
        "Transaction_ID", f.feature_array(f.PRODUCT_FEATURES).alias("v")
    )
    return vectors.select("Transaction_ID", *f.spread("v", len(f.PRODUCT_FEATURES), "v"))


@query("transaction_features", over_model(_features_sql(f.TRANSACTION_FEATURES, "Transaction_ID")))
def transaction_features(spark, sf_dir):
    vectors = model(spark, sf_dir, *f.TRANSACTION_FEATURES).select(
        "Transaction_ID", f.feature_array(f.TRANSACTION_FEATURES).alias("v")
    )
    return vectors.select("Transaction_ID", *f.spread("v", len(f.TRANSACTION_FEATURES), "v"))


def _scaled(df, columns, keep):
    vectors = df.select(keep, f.scaled_array(df, columns).alias("v"))
    return vectors.select(keep, *f.spread("v", len(columns), "v"))


def _scaled_sql(columns: list[str], keep: str, before: str = "", source: str = "model") -> str:
    return over_model(
        f"{before}, scaled AS ({scaled_sql(columns, keep, source)}) "
        f"SELECT {keep}, {rounded_sql(len(columns))} FROM scaled"
    )


@query("minmax_user", _scaled_sql(
    f.USER_FEATURES, "Customer_ID",
    f", users AS (SELECT DISTINCT {', '.join(f.USER_FEATURES)} FROM model)", "users",
))
def minmax_user(spark, sf_dir):
    return _scaled(f.user_profiles(model(spark, sf_dir, *f.USER_FEATURES)), f.USER_FEATURES, "Customer_ID")


@query("minmax_product", _scaled_sql(f.PRODUCT_FEATURES, "Transaction_ID"))
def minmax_product(spark, sf_dir):
    return _scaled(model(spark, sf_dir, *f.PRODUCT_FEATURES), f.PRODUCT_FEATURES, "Transaction_ID")


@query("minmax_transaction", _scaled_sql(f.TRANSACTION_FEATURES, "Transaction_ID"))
def minmax_transaction(spark, sf_dir):
    return _scaled(model(spark, sf_dir, *f.TRANSACTION_FEATURES), f.TRANSACTION_FEATURES, "Transaction_ID")


HYBRID = (
    f", hybrid AS ({scaled_sql(HYBRID_FEATURES, 'Transaction_ID, Customer_ID, Products, Combined_Rating')})"
)


@query("hybrid_vectors", over_model(
    f"{HYBRID} SELECT Transaction_ID, Customer_ID, Products, Combined_Rating, {rounded_sql(HYBRID_SIZE)} FROM hybrid"
))
def hybrid_vectors(spark, sf_dir):
    hybrid = f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS))
    return hybrid.select(
        *[c for c in hybrid.columns if c != "hybrid_vector"],
        *f.spread("hybrid_vector", HYBRID_SIZE, "v"),
    )


@query("distinct_user_vectors", over_model(
    f"{HYBRID} SELECT DISTINCT Customer_ID, {rounded_sql(HYBRID_SIZE)} FROM hybrid"
))
def distinct_user_vectors(spark, sf_dir):
    vectors = f.distinct_user_vectors(f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS)))
    return vectors.select("Customer_ID", *f.spread("hybrid_vector", HYBRID_SIZE, "v"))


PRODUCT_MEANS = ", product_means AS (SELECT Products, " + ", ".join(
    f"avg(v{i}) AS v{i}" for i in range(HYBRID_SIZE)
) + " FROM hybrid GROUP BY Products)"


@query("product_mean_vector", over_model(
    f"{HYBRID}{PRODUCT_MEANS} SELECT Products, {rounded_sql(HYBRID_SIZE)} FROM product_means"
))
def product_mean_vector(spark, sf_dir):
    hybrid = f.hybrid_vectors(model(spark, sf_dir, *HYBRID_COLUMNS))
    means = f.mean_vectors(hybrid, ["Products"], "hybrid_vector", "product_vector", HYBRID_SIZE)
    return means.select("Products", *f.spread("product_vector", HYBRID_SIZE, "v"))


@query("join_user_profile", over_model("""
SELECT t.Transaction_ID, t.Customer_ID, u.Age, u.Income FROM model t
JOIN (SELECT DISTINCT Customer_ID, Age, Gender, Country, Income, Customer_Segment FROM model) u
  ON t.Customer_ID = u.Customer_ID"""))
def join_user_profile(spark, sf_dir):
    rows = model(spark, sf_dir, *f.USER_FEATURES, "Transaction_ID")
    users = f.user_profiles(rows).select("Customer_ID", "Age", "Income")
    return rows.select("Transaction_ID", "Customer_ID").join(users, "Customer_ID")


@query("join_tx_product", over_model(
    "SELECT Transaction_ID, Customer_ID, Products, Product_Brand FROM model"
))
def join_tx_product(spark, sf_dir):
    rows = model(
        spark, sf_dir, "Transaction_ID", "Customer_ID", "Products", "Product_Brand"
    )
    left = rows.select("Transaction_ID", "Customer_ID")
    return left.join(rows.select("Transaction_ID", "Products", "Product_Brand"), "Transaction_ID")
