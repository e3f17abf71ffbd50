"""From the clean table to numbers: indices, ratings, scaled vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.labels import combined_rating, feedback_rating, month_index
from basketlens.functions.numeric import exact_avg, round_half_up
from basketlens.operators.numbering import in_order, number_rows
from basketlens.operators.similarity import whole_vectors
from basketlens.operators.staging import staged
from basketlens.schema import CLEAN_COLUMNS, MODEL_COLUMNS, require_columns

# The columns replaced by their index, and the parts of the hybrid vector.
INDEXED_COLUMNS = [
    "Customer_ID", "Country", "Gender", "Customer_Segment", "Product_Category", "Product_Brand",
    "Product_Type", "Shipping_Method", "Payment_Method", "products", "Transaction_ID",
]
USER_FEATURES = ["Customer_ID", "Age", "Gender", "Country", "Income", "Customer_Segment"]
PRODUCT_FEATURES = [
    "Transaction_ID", "Product_Category", "Product_Brand", "Product_Type", "Products_Index",
]
TRANSACTION_FEATURES = [
    "Transaction_ID", "Customer_ID", "Month_Index", "Year", "Combined_Rating",
]


def value_indices(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value, index): the most frequent value is 0, ties in text order.

    Values of all columns are counted in one pass. A column may have any number of values;
    none of them pass through the driver.
    """
    pairs = [c for name in columns for c in (F.lit(name), F.col(name).cast("string"))]
    counts = (
        df.select(F.stack(F.lit(len(columns)), *pairs).alias("column", "value"))
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg((-F.count(F.lit(1))).alias("minus_count"))
    )
    numbered = number_rows(counts, ["minus_count", "value"], ["column"])
    return numbered.select("column", "value", (F.col("position") - 1).alias("index"))


def attach_indices(df: DataFrame, indices: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_index`` (bigint) for each column; a null or unknown value gets one index more.

    ``indices`` is a stored table: by its size Spark chooses between broadcast and shuffle.
    """
    counts = indices.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {row["column"]: row["n"] for row in counts}
    for name in columns:
        n = sizes.get(name, 0)
        lookup = indices.where(F.col("column") == name).select(
            F.col("value").alias("_value"), F.col("index").alias("_index")
        )
        joined = df.join(lookup, F.col(name).cast("string") == F.col("_value"), "left")
        df = joined.select(
            *df.columns, F.coalesce("_index", F.lit(n)).cast("bigint").alias(f"{name}_index")
        )
    return df


def place_by_text(df: DataFrame, name: str) -> DataFrame:
    """Add ``<name>_index`` for a column that tells rows apart and holds no null.

    Every value occurs once, so its index is its place in text order: rows are dealt by it with what they hold, once,
    instead of being counted, numbered and joined.
    """
    return in_order(df, [F.col(name).cast("string")]).withColumnRenamed("_at", f"{name}_index")


RATED = {"Ratings", "Feedback_Rating", "Combined_Rating"}


def model_sources(wanted: list[str]) -> list[str]:
    """The clean columns that the wanted model columns are made of."""
    made_of = {
        "Month_Index": ["Month"], "Products": ["products"], "Products_Index": ["products"],
        **dict.fromkeys(RATED, ["Ratings", "Feedback"]),
    }
    needed = {source for c in wanted for source in made_of.get(c, [c])}
    return [c for c in CLEAN_COLUMNS if c in needed]


def with_ratings(df: DataFrame, alpha: float = 0.5) -> DataFrame:
    rated = df.withColumn("Feedback_Rating", feedback_rating(F.col("Feedback")))
    ratings = F.col("Ratings").try_cast("double")
    return rated.withColumn("Ratings", ratings).withColumn(
        "Combined_Rating", combined_rating(F.col("Ratings"), F.col("Feedback_Rating"), alpha)
    )


def model_table(
    clean: DataFrame,
    columns: list[str] | None = None,
    alpha: float = 0.5,
    unique: str | None = None,
) -> DataFrame:
    """The 19 model columns in their order, and Products_Index; or only the ``columns`` wanted.

    Only the wanted columns are indexed, and ``clean`` needs to have their sources only
    (:func:`model_sources`). If any is indexed, it is read several times: pass a stored table.
    ``unique`` names an indexed column that tells the rows of ``clean`` apart and holds no null; its values are not counted
    (:func:`place_by_text`), and the result is a stored table.
    """
    wanted = columns or [*MODEL_COLUMNS, "Products_Index"]
    require_columns(clean, model_sources(wanted))
    source = {"products": "Products_Index"}
    to_index = [c for c in INDEXED_COLUMNS if source.get(c, c) in wanted]
    indexed = clean
    counted = [c for c in to_index if c != unique]
    if counted:
        indices = staged(value_indices(clean, counted), "column")
        indexed = attach_indices(clean, indices, counted)
    rated = with_ratings(indexed, alpha) if RATED.intersection(wanted) else indexed
    replaced = {source.get(c, c): F.col(f"{c}_index") for c in counted}
    computed = {
        **replaced,
        "Age": F.col("Age").try_cast("int"),
        "Year": F.col("Year").try_cast("int"),
        "Income": F.col("Income").try_cast("double"),
        "Month_Index": month_index(F.col("Month")),
        "Products": F.col("products"),
    }
    table = rated.select(*[computed.get(c, F.col(c)).alias(c) for c in wanted])
    if unique not in to_index:
        return table
    placed = place_by_text(table, unique)
    return placed.select(*[F.col(f"{c}_index" if c == unique else c).alias(c) for c in wanted])


def product_lookup(model: DataFrame) -> DataFrame:
    return model.select("Products_Index", "Products").distinct()


def training_flag(key: Column, share: float = 0.8, seed: int = 42) -> Column:
    """True for about ``share`` of the keys. Depends on the key alone, not on partitioning.

    By a hash that any engine has: the first eight hex digits of the MD5 of key:seed.
    """
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return number % 10_000 < int(share * 10_000)


def train_test_split(
    df: DataFrame, key: str = "Transaction_ID", share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    flag = training_flag(F.col(key), share, seed)
    return df.where(flag), df.where(~flag)


def feature_array(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def scaled_array(df: DataFrame, columns: list[str], nulls: bool = True) -> Column:
    """The columns scaled to [0, 1] by their range in ``df``; a constant column gives 0.5.

    The ranges are a one-row scalar subquery. Where the columns hold no ``nulls`` the type of the array says so, and nobody
    has to look for them.
    """
    ranges = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"low_{i}") for i, c in enumerate(columns)],
            *[F.max(F.col(c).cast("double")).alias(f"high_{i}") for i, c in enumerate(columns)],
        ).alias("ranges")
    ).scalar()

    def scaled(i: int, name: str) -> Column:
        low, high = ranges[f"low_{i}"], ranges[f"high_{i}"]
        x = F.col(name).cast("double")
        share = F.coalesce(F.try_divide(x - low, high - low), F.lit(0.5))
        return F.when(x.isNotNull(), share) if nulls else share

    return F.array(*[scaled(i, c) for i, c in enumerate(columns)])


def user_profiles(model: DataFrame) -> DataFrame:
    return model.select(*USER_FEATURES).distinct()


def hybrid_vectors(
    model: DataFrame,
    user: list[str] = USER_FEATURES,
    transaction: list[str] = TRANSACTION_FEATURES,
    product: list[str] = PRODUCT_FEATURES,
    nulls: str = "skip",
) -> DataFrame:
    """One scaled vector per transaction: user, transaction and product parts.

    Rows with a null feature are skipped; with ``nulls="keep"`` the null stands in the vector.

    All three parts are columns of the same row, and the range of a user column is the same
    over rows as over users, so neither a join nor a distinct is needed.
    """
    features = [*user, *transaction, *product]
    if nulls == "skip":
        model = model.dropna(subset=list(dict.fromkeys(features)))
    return model.select(
        "Transaction_ID", "Customer_ID", "Products", "Combined_Rating",
        scaled_array(model, features, nulls=nulls != "skip").alias("hybrid_vector"),
    )


def distinct_user_vectors(hybrid: DataFrame) -> DataFrame:
    return hybrid.select("Customer_ID", "hybrid_vector").distinct()


def mean_vectors(df: DataFrame, by: list[str], vector: str, name: str, size: int | None = None) -> DataFrame:
    """Element-wise mean of an array column by group; the state has the size of one vector.

    Vectors that hold a null are left out. With the ``size`` of the vectors given, means are exact sums over counts, so
    they don't depend on the order of rows; elements must have less than 21 digits in front and need no more than 18 places.
    """
    whole = whole_vectors(df, vector).groupBy(*by)
    if size is not None:
        return whole.agg(F.array(*[exact_avg(F.col(vector)[i]) for i in range(size)]).alias(name))
    means = whole.agg(Summarizer.mean(array_to_vector(F.col(vector))).alias("_mean"))
    return means.select(*by, vector_to_array("_mean").alias(name))


def spread(array: str, size: int, prefix: str) -> list[Column]:
    """The elements of an array as columns, rounded for comparison.

    Rounded as one array: with an expression for each element the generated code is too long to be compiled.
    """
    rounded = F.transform(array, lambda x: round_half_up(x, 6))
    return [rounded[i].alias(f"{prefix}{i}") for i in range(size)]
