import math
from fractions import Fraction

import numpy as np
import pytest

from basketlens.llm import embedding_whitening as ew
from basketlens.llm.queries import QUERIES
from conftest import SF_DIR

SCHEMA = "vec_id bigint, embedding array<double>, label int, vector string, n bigint, component string, whitened string"


def table(spark, vectors, parts=3):
    rows = [(i, v, 1, "v", 2, "c", "w") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(vectors):
    """{component: (explained, {vec_id: |whitened|})}, deviations and n, with fractions up to the covariance."""
    kept = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in vectors]
    n, size = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(size)]
    z = [[n * x[d] - sums[d] for d in range(size)] for _, x in kept]
    cov = [[float(Fraction(sum(r[a] * r[b] for r in z), n**3)) for b in range(size)] for a in range(size)]
    values, axes = np.linalg.eigh(np.array(cov))
    values, axes = values[::-1], axes[:, ::-1]
    white = (np.array(z, dtype=float) / n) @ axes[:, :8] / np.sqrt(values[:8])
    return n, [sum(v * v for v in r) for r in z], values[:8] / values.sum(), white


def check(vectors, found):
    n, deviations, explained, white = brute(vectors)
    assert len(found) == n * white.shape[1]
    at = {i: k for k, (i, _) in enumerate(vectors)}
    signs = {}
    for r in found:
        k, c = at[r.vec_id], r.component - 1
        exact = deviations[k]
        assert r.n == n and r.deviation_digits == str(exact)
        assert r.deviation == (exact if exact < 2**63 else None)
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[k, c]), abs=1e-8)
        if abs(white[k, c]) > 1e-6:
            signs.setdefault(c, set()).add(r.whitened * white[k, c] > 0)
        assert r.identity_error < 1e-4
    assert all(len(s) == 1 for s in signs.values())


def test_query_against_fractions(spark):
    found = QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    vectors = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None]
    check(vectors, found)


@pytest.mark.parametrize("size,spread", [(3, 1.0), (12, 1.0), (5, 1e7)])
def test_random_vectors(spark, size, spread):
    rng = np.random.default_rng(size)
    vectors = [(i, (rng.normal(size=size) * spread * (1 + np.arange(size))).tolist()) for i in range(60)]
    check(vectors, ew.whitening_report(table(spark, vectors)).collect())


def test_odd_rows(spark):
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [-0.0004, 0.5]), (None, [9.0, -3.25]), (3, [-0.0004, 0.5])]
    bad = [
        (10, None), (11, []), (12, [1.0, None]), (13, [float("nan"), 1.0]), (14, [float("inf"), 1.0]),
        (15, [-float("inf"), 1.0]), (16, [1.0]), (17, [1.0, 2.0, 3.0]), (None, None),
    ]
    found = ew.whitening_report(table(spark, good + bad)).collect()
    assert sorted((str(r.vec_id), r.component) for r in found) == sorted((str(i), c) for i, _ in good for c in (1, 2))
    plain = [(k, v) for k, (_, v) in enumerate(good)]
    n, deviations, _, _ = brute(plain)
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviations)
    assert {r.n for r in found} == {n}


def test_partitioning_does_not_matter(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(size=4).tolist()) for i in range(50)] + [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(25)]
    one = sorted(ew.whitening_report(table(spark, vectors, 1)).drop("identity_error").collect())
    many = sorted(ew.whitening_report(table(spark, vectors, 16)).drop("identity_error").collect())
    assert one == many


def test_no_variance_and_empty_tables(spark):
    same = ew.whitening_report(table(spark, [(1, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)
    flat = ew.whitening_report(table(spark, [(1, [1.0, 5.0]), (2, [2.0, 5.0])])).collect()
    assert sorted((r.component, r.whitened is None) for r in flat) == [(1, False), (1, False), (2, True), (2, True)]
    assert all(r.identity_error < 1e-9 for r in flat)
    none = ew.whitening_report(table(spark, [(1, None), (2, [])]))
    assert none.count() == 0 and none.columns == ew.whitening_report(table(spark, [(1, [1.0])])).columns


def test_sums_beyond_64_bits():
    rng = np.random.default_rng(2)
    x = rng.integers(-(2**55), 2**55, size=(300, 3))
    n, sums = 300, [sum(int(v) for v in x[:, d]) for d in range(3)]
    z = [[n * int(v) - s for v, s in zip(row, sums)] for row in x]
    powers = ew.squares(x, n, sums)
    for i in range(3):
        for j in range(i, 3):
            got = sum(int(p[i, j]) << (ew.DIGIT * k) for k, p in enumerate(powers))
            assert got == sum((r[i] + (r[j] if j > i else 0)) ** 2 for r in z)

