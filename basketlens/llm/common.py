"""Shared by the corpus operators: tables, folds, bounded training samples, safe column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: Column) -> Column:
    """crc32 of the key as text modulo :data:`FOLDS`; a null key counts as the empty text (0)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(key: Column) -> Column:
    return fold_of(key) == 0


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores as it takes not to clash with a column of ``df``."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def labelled_keys(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """(__key, __label) of all keys outside the held-out fold that are labelled 0 or 1, the greatest label of each."""
    marked = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    known = marked.where(F.col("__key").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__key")))
    return known.groupBy("__key").agg(F.max("__label").alias("__label"))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id"
) -> DataFrame:
    """(__key, text, label) of at most ``most`` labelled rows outside the held-out fold.

    Keys are picked by the order of their hash, so the sample does not depend on the partitioning. There are
    at most ``most`` of them, which bounds their broadcast, and one text for each: of rows that share a key, that
    with the smallest hash, a null one only if there is no other.
    """
    picked = labelled_keys(labels, label, key).orderBy(F.xxhash64("__key"), "__key").limit(most)
    found = docs.select(F.col(key).alias("__key"), F.col("text").alias("text")).join(F.broadcast(picked), "__key")
    return found.groupBy("__key").agg(
        F.min_by("text", F.when(F.col("text").isNotNull(), F.xxhash64("text"))).alias("text"),
        F.first("__label").alias("label"),
    )
