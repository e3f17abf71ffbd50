"""Purchase sequences, product embeddings, and leave-one-out evaluation."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.numeric import round_half_up
from basketlens.operators.features import mean_vectors
from basketlens.operators.numbering import number_rows
from basketlens.operators.similarity import top_k_similar
from basketlens.operators.staging import staged

ORDER = ["Year", "Month_Index", "Transaction_ID"]


def ordered_purchases(model: DataFrame) -> DataFrame:
    """Rows (Customer_ID, position, Products): every purchase with its place in the sequence."""
    named = model.select("Customer_ID", *ORDER, "Products").dropna(subset=["Products"])
    numbered = number_rows(named, ORDER, ["Customer_ID"])
    return numbered.select("Customer_ID", "position", "Products")


def purchase_sequences(model: DataFrame) -> DataFrame:
    """Rows (Customer_ID, seq_length, position, Products) of customers with two purchases or more.

    The whole sequence of a customer, in the long form: no row grows with the number of purchases.
    """
    purchases = staged(ordered_purchases(model))
    lengths = purchases.groupBy("Customer_ID").agg(F.max("position").alias("seq_length"))
    several = staged(lengths.where("seq_length >= 2"))
    same = purchases["Customer_ID"].eqNullSafe(several["Customer_ID"])
    return purchases.join(several, same).select(
        purchases["Customer_ID"], "seq_length", "position", "Products"
    )


def training_sentences(sequences: DataFrame, most: int = 1000) -> DataFrame:
    """Rows (Customer_ID, piece, product_sequence): the sequences as sentences for training.

    Word2Vec cuts sentences longer than ``most`` itself; here a longer sequence comes as several rows.
    """
    piece = F.floor((F.col("position") - 1) / F.lit(most)).cast("int").alias("piece")
    collected = F.array_sort(F.collect_list(F.struct("position", "Products")))
    return sequences.groupBy("Customer_ID", piece).agg(
        F.transform(collected, lambda p: p["Products"].cast("string")).alias("product_sequence")
    )


def fit_embeddings(
    sentences: DataFrame, partitions: int, size: int = 50, seed: int = 42, most: int = 1000
) -> Word2VecModel:
    """Word2Vec over the sentences.

    ``partitions`` are trained side by side and averaged, so the vectors depend on it; it is the caller's choice and not
    that of the cluster. The vocabulary lies on the driver and grows with the number of products.
    """
    word2vec = Word2Vec(
        vectorSize=size, minCount=1, seed=seed, maxSentenceLength=most, numPartitions=partitions,
        inputCol="product_sequence", outputCol="product_embedding",
    )
    return word2vec.fit(sentences)


def embedding_table(model: Word2VecModel) -> DataFrame:
    vectors = model.getVectors()
    return vectors.select(
        F.col("word").alias("Products"), vector_to_array("vector").alias("embedding")
    )


def product_categories(model: DataFrame) -> DataFrame:
    """The most frequent category of each product, ties to the smallest."""
    counts = model.groupBy("Products", "Product_Category").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(-F.col("n"), F.col("Product_Category"))
    return counts.where("Products IS NOT NULL").groupBy("Products").agg(
        F.min_by("Product_Category", order).alias("Product_Category")
    )


def last_purchases(model: DataFrame) -> DataFrame:
    """Rows (Customer_ID, actual_item, seq_length) of customers with two purchases or more.

    The last key of a customer is found with fixed-size states; its product is joined to it.
    """
    year, month, transaction = (F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)") for c in ORDER)
    # The order as one number, which a hash aggregate can keep the maximum of.
    key = (year * 16 + month).cast("decimal(17,0)") * F.lit("1e20").cast("decimal(21,0)") + transaction
    named = model.dropna(subset=["Products"]).select(
        "Customer_ID", F.col("Products").alias("actual_item"), key.cast("decimal(38,0)").alias("_key")
    )
    last = named.groupBy("Customer_ID").agg(
        F.max("_key").alias("_key"), F.count(F.lit(1)).alias("seq_length")
    )
    # The key identifies a purchase, so this join has no hot value.
    return named.join(last.where("seq_length >= 2"), ["Customer_ID", "_key"]).drop("_key")


def training_products(model: DataFrame, last: DataFrame) -> DataFrame:
    """The distinct products of each customer, the last purchase left out.

    A product is left out only if its single occurrence is the last purchase.
    """
    named = model.dropna(subset=["Products"])
    counts = named.groupBy("Customer_ID", "Products").agg(F.count(F.lit(1)).alias("n"))
    kept = (F.col("Products") != F.col("actual_item")) | (F.col("n") > 1)
    # Stored, so that adaptive execution can split a customer with very many products.
    last = staged(last.select("Customer_ID", "actual_item"))
    # Dealt by customer while the rows are narrow, so that means of vectors by customer need not be.
    return counts.repartition("Customer_ID").join(last, "Customer_ID").where(kept).select("Customer_ID", "Products")


def user_embeddings(model: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Mean embedding of each customer's training products."""
    products = training_products(model, last_purchases(model))
    known = products.join(embeddings, "Products")
    return mean_vectors(known, ["Customer_ID"], "embedding", "user_vector")


def nearest_products(model: DataFrame, embeddings: DataFrame, k: int = 5) -> DataFrame:
    """Rows (Customer_ID, Products, similarity, rank) for every customer, in one job."""
    return top_k_similar(user_embeddings(model, embeddings), embeddings, k)


def category_hits(model: DataFrame, embeddings: DataFrame, k: int = 5) -> DataFrame:
    """Rows (Customer_ID, actual_item, actual_cat, cat_hits).

    ``model`` and ``embeddings`` are read more than once: pass stored tables.
    """
    categories = staged(product_categories(model))
    predicted = nearest_products(model, embeddings, k).join(categories, "Products")
    actual = last_purchases(model).join(
        categories.select(
            F.col("Products").alias("actual_item"), F.col("Product_Category").alias("actual_cat")
        ),
        "actual_item",
    )
    scored = predicted.join(actual, "Customer_ID")
    return scored.groupBy("Customer_ID", "actual_item", "actual_cat").agg(
        F.count_if(F.col("Product_Category") == F.col("actual_cat")).alias("cat_hits")
    )


def hit_rate(hits: DataFrame, k: int = 5) -> DataFrame:
    average = F.avg("cat_hits")
    return hits.agg(
        round_half_up(average, 6).alias("avg_category_hits"),
        round_half_up(average / k, 6).alias("category_hit_rate"),
    )
