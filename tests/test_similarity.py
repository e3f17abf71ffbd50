import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.functions.vectors import cosine_similarity
from basketlens.operators import similarity as sim
from basketlens.operators.similarity import top_k_products, top_k_similar


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    lengths = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / lengths) if lengths else 0.0


def brute_force(queries, items, k):
    best = {}
    for q, v in queries:
        for i, w in items:
            score = cosine(v, w)
            best.setdefault(q, {})[i] = max(score, best.get(q, {}).get(i, -2.0))
    return {
        q: sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k] for q, scores in best.items()
    }


def tables(spark, n_queries=200, n_items=90, dims=6):
    rng = np.random.default_rng(3)
    queries = [(int(i % 60), rng.normal(size=dims).round(2).tolist()) for i in range(n_queries)]
    queries += [(0, queries[0][1])] * 80 + [(61, [0.0] * dims)]
    items = [(f"item{i:03}", rng.normal(size=dims).round(2).tolist()) for i in range(n_items)]
    items += [("twin", items[0][1]), ("zero", [0.0] * dims)]
    return (
        queries, items,
        spark.createDataFrame(queries, "user long, v array<double>").repartition(4),
        spark.createDataFrame(items, "item_name string, w array<double>"),
    )


@pytest.mark.parametrize("block_bytes", [64 * 2**20, 1000])
def test_agrees_with_brute_force(spark, block_bytes):
    queries, items, q, i = tables(spark)
    got = {}
    for r in top_k_similar(q, i, 5, block_bytes).orderBy("user", "rank").collect():
        got.setdefault(r.user, []).append((r.item_name, r.similarity))
    want = brute_force(queries, items, 5)
    assert got.keys() == want.keys()
    for user in want:
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in want[user]])
        # Items as similar as the last digit are in one order or the other.
        assert {n for n, _ in got[user]} == {n for n, _ in want[user]} or user == 0


@pytest.mark.parametrize("block_bytes", [64 * 2**20, 16])
def test_ids_are_kept_exactly(spark, block_bytes):
    big = 2**60 + 1
    q = spark.createDataFrame([(None, [1.0, 0.0]), (big, [0.0, 1.0])], "user long, v array<double>")
    i = spark.createDataFrame([(None, [1.0, 0.0]), (big, [0.0, 1.0]), (big + 1, [1.0, 1.0])], "item long, w array<double>")
    got = {(r.user, r["rank"]): r.item for r in top_k_similar(q, i, 2, block_bytes).collect()}
    assert got == {(None, 1): None, (None, 2): big + 1, (big, 1): big, (big, 2): big + 1}


def test_close_items_are_told_apart(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "user long, v array<double>")
    i = spark.createDataFrame([(1, [1.0, 2e-5]), (2, [1.0, 1e-5])], "item long, w array<double>")
    assert [r.item for r in top_k_similar(q, i, 2).orderBy("rank").collect()] == [2, 1]


def test_nulls_inside_vectors(spark):
    q = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 0.0])], "user long, v array<double>")
    i = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [None, 1.0])], "name string, w array<double>")
    assert [tuple(r) for r in top_k_similar(q, i).collect()] == [(2, "a", 0.0, 1)]
    with pytest.raises(Exception, match="a null in"):
        top_k_similar(q, i, nulls="error").collect()


def test_repeated_items_if_asked_for(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.1])], "user long, v array<double>")
    i = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "name string, w array<double>")
    assert [r.name for r in top_k_similar(q, i, 2, distinct=False).orderBy("rank").collect()] == ["a", "a"]
    assert [r.name for r in top_k_similar(q, i, 2).orderBy("rank").collect()] == ["a", "b"]


def test_fewer_items_than_asked_for(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "user long, v array<double>")
    i = spark.createDataFrame([("a", [0.0, 1.0]), ("b", None)], "name string, w array<double>")
    assert [tuple(r) for r in top_k_similar(q, i).collect()] == [(1, "a", 0.0, 1)]


def test_no_items(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "user long, v array<double>")
    i = spark.createDataFrame([], "name string, w array<double>")
    assert top_k_similar(q, i).collect() == []


def test_cosine_of_special_vectors(spark):
    rows = [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]), ([1.0, 1.0], [-1.0, -1.0]),
            ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0]), ([1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[:4] == pytest.approx([1.0, 0.0, -1.0, 0.0])
    assert got[4:] == [None, None]


def clustered(spark, n=600, dims=8):
    """Items and queries around ten directions, of very different lengths."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, dims))
    items = [(i, ((centres[i % 10] + rng.normal(size=dims) * 0.02) * 4.0 ** -(i % 7)).tolist()) for i in range(n)]
    queries = [(i, (centres[i % 10] + rng.normal(size=dims) * 0.02).tolist()) for i in range(100)]
    q = spark.createDataFrame(queries, "user long, v array<double>").repartition(3)
    return queries, items, q, spark.createDataFrame(items, "item long, w array<double>").repartition(5)


@pytest.mark.parametrize("kind", [sim.COSINE, sim.PRODUCT])
def test_blocks_out_of_reach_are_skipped_without_loss(spark, monkeypatch, kind):
    queries, items, q, i = clustered(spark)
    compared, routed = [], sim._routed

    def counted(*args, **more):
        out = routed(*args, **more)
        if len(args) == 3 and not more:
            compared.append((sum(r.queries for r in out.collect()), len(args[1].cell)))
        return out

    monkeypatch.setattr(sim, "_routed", counted)
    top = (top_k_similar if kind == sim.COSINE else top_k_products)(q, i, 5, block_bytes=20 * 8 * 8)
    got = {}
    for r in top.orderBy("user", "rank").collect():
        got.setdefault(r.user, []).append((r.item, r[kind]))
    score = cosine if kind == sim.COSINE else (lambda a, b: float(np.dot(a, b)))
    for user, v in queries:
        want = sorted(((j, score(v, w)) for j, w in items), key=lambda s: (-s[1], s[0]))[:5]
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in want])
        assert [n for n, _ in got[user]] == [n for n, _ in want]
    (first, blocks), (second, _) = compared
    assert first == len(queries) and blocks >= 30
    assert second < 0.35 * len(queries) * blocks


def test_products_of_null_and_large_ids_ties_and_zero_vectors(spark):
    big = 2**60 + 1
    q = spark.createDataFrame([(None, [1.0, 0.0]), (big, [0.0, -1.0]), (3, [0.0, 0.0])], "user long, v array<double>")
    i = spark.createDataFrame(
        [(None, [2.0, 1.0]), (big, [2.0, -1.0]), (big + 1, [1.0, 9.0]), (7, [0.0, 0.0])], "item long, w array<double>"
    )
    for block_bytes in (16, 1 << 20):
        got = {(r.user, r["rank"]): (r.item, r["product"]) for r in top_k_products(q, i, 2, block_bytes).collect()}
        assert got == {
            (None, 1): (None, 2.0), (None, 2): (big, 2.0), (big, 1): (big, 1.0), (big, 2): (7, 0.0),
            (3, 1): (None, 0.0), (3, 2): (7, 0.0),
        }


def test_one_query_repeated_very_often(spark):
    q = spark.range(4000).selectExpr("1L as user", "array(1D, cast(id % 2 as double)) as v")
    i = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [0.0, 1.0])], "name string, w array<double>")
    found = top_k_similar(q, i, 2, block_bytes=64).orderBy("rank").collect()
    assert [(r.name, round(r.similarity, 9)) for r in found] == [("a", 1.0), ("b", 1.0)]


def test_items_do_not_pass_through_the_driver(spark):
    _, _, q, i = clustered(spark)
    plan = top_k_similar(q, i)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Cartesian" not in plan
