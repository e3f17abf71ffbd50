import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketlens.llm import quality
from basketlens.llm.common import held_out

GOOD, BAD = "calm words about rivers and stones by the water", "!!! $$$ 12 ### 99 %%"


def test_trees_learn_from_all_labelled_rows(spark):
    """The only rows of label 1 come last in the order by which samples were picked."""
    ids = spark.range(32_000).withColumnRenamed("id", "doc_id").where(~held_out(F.col("doc_id")))
    place = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    marked = ids.withColumn("quality", (place > 20_000).cast("int")).cache()
    text = F.when(F.col("quality") == 1, GOOD).otherwise(BAD)
    docs = marked.select("doc_id", F.concat(text, F.lit(" "), (F.col("doc_id") % 7).cast("string")).alias("text"))
    rows = quality.training_rows(docs, marked)
    assert rows.count() == marked.count() > 25_000
    found = quality.quality_scores(docs, marked).join(marked, "doc_id")
    assert found.where("predicted <> quality").count() == 0


def test_trees_over_bins_are_those_over_numbers(spark):
    """Like those grown in memory, and the same for any partitioning; shared ids have one text, the least by hash."""
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["river", "Stone", "!!", "7", "by"], 12 + i % 30, p=p)), int(i % 3 == 0))
             for i in range(600) for p in [[0.4, 0.3, 0.1, 0.1, 0.1] if i % 3 == 0 else [0.2, 0.2, 0.2, 0.3, 0.1]]]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id bigint, text string")
    docs = docs.union(docs.where("doc_id % 5 = 1").withColumn("text", F.lit(None).cast("string")))
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id bigint, quality int")
    found = sorted(quality.training_rows(docs, labels).collect())
    assert all(any(r["row"]) for r in found) and len(found) == len({r["__key"] for r in found})
    numbers = np.array([r["row"] for r in found], dtype=np.float64)
    label = np.array([r["label"] for r in found], dtype=np.float64)
    model, again = quality.train(docs, labels), quality.train(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(model.leaf, again.leaf) and np.array_equal(model.threshold, again.threshold)
    plain = quality.fit(numbers, label)
    assert np.mean((model.score(numbers) >= 0.5) == (plain.score(numbers) >= 0.5)) > 0.97
