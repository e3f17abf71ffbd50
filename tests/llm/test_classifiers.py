import zlib

import numpy as np
import pytest

from basketlens.llm import language, quality, toxicity
from basketlens.llm.common import training_texts
from basketlens.llm.queries import QUERIES
from corpus_cases import TEXTS, empty, odd, one_for_each

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    marked = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return docs, marked


def scored(spark, name, truth):
    found = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert set(found) == set(truth[0])
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    return found


def test_quality_on_held_out_rows(spark, truth):
    found = scored(spark, "op6_quality_classifier", truth)
    assert all(r.predicted == int(r.score >= 0.3) for r in found.values())
    held = [(m.quality, found[i].predicted) for i, m in truth[1].items() if i in found and found[i].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_toxicity_on_held_out_rows(spark, truth):
    found = scored(spark, "op5_toxicity", truth)
    assert all(r.predicted == int(r.score >= 0.5) for r in found.values())
    held = [(m.toxic, found[i].predicted) for i, m in truth[1].items() if i in found and found[i].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.9
    assert np.mean([b for a, b in held if not a]) <= 0.05


def test_language_on_held_out_rows(spark, truth):
    found = scored(spark, "op7_language_id", truth)
    held = [(truth[0][i].lang, r.lang_pred) for i, r in found.items() if r.held_out]
    assert np.mean([a == b for a, b in held]) >= 0.98


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_odd_rows_and_missing_labels(spark, score):
    docs = odd(spark)
    some = [(i, n % 2, n % 2, "x") for n, (i, _) in enumerate(TEXTS) if i] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 7, 7, "x")]
    for rows in (some, [], [(i, 1, 1, "x") for i, _ in TEXTS if i]):
        found = one_for_each(docs, score(docs, labels(spark, rows)))
        assert all(0 <= r.score <= 1 for r in found)
    assert score(empty(spark), labels(spark, some)).count() == 0


def test_languages_of_odd_rows(spark):
    docs = odd(spark)
    found = {r.doc_id: r for r in one_for_each(docs, language.predict_language(docs))}
    for i in (5, 6, 7, 8):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[1].lang_pred == "en"
    assert language.predict_language(empty(spark)).count() == 0
    nothing = language.predict_language(docs.withColumn("lang", docs.lang.substr(0, 0).cast("string")).where("lang is null"))
    assert all(r.lang_pred == "und" for r in nothing.collect())


def test_whole_texts_count(spark):
    """What stands at the very end of a long text matters."""
    filler = "calm words about rivers and stones " * 3000
    rows = [(i, ("you utter moron " if i % 4 == 0 else "a quiet evening ") + f"river {i} stone") for i in range(1, 400)]
    docs = odd(spark, [*rows, (1000, filler + "you utter moron"), (1001, filler)])
    marked = labels(spark, [(i, 1, int(i % 4 == 0), "x") for i, _ in rows])
    found = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, marked).collect()}
    assert found[1000] == 1 and found[1001] == 0


def test_gaps_and_inserted_characters():
    words = [[b"".join(bytes([c - 96]) for c in w.encode()) for w in text.split()] for text in
             ["total moron here", "calm river stone", "such a moron again", "stone by the river", "moron", "quiet evening"] * 20]
    machine = toxicity.fit(words, np.array([1, 0, 1, 0, 1, 0] * 20))
    for text in ("you moron", "m.o.r.o.n", "m o r o n", "mo-ron!", "MORON", "moroon", "mor0on"):
        assert machine.score(text) >= 0.5, text
    for text in ("", None, "a river", "more on this", "!!!"):
        assert machine.score(text) < 0.5, text


def test_kernel_is_what_it_says():
    words = [b"\x01\x02\x03\x04", b"\x01\x09\x02\x03\x04", b"\x05\x06\x07"]
    space = toxicity.Nystroem(words)
    code, number = toxicity._flat(words)
    features = [{} for _ in words]
    for at, key, weight in toxicity.occurrences(code, number):
        for a, k in zip(at, key):
            features[a][k] = features[a].get(k, 0) + weight
    norm = toxicity.norms(code, number, 3)
    own = np.array([[sum(x * b.get(k, 0) for k, x in a.items()) for b in features] for a in features]) / np.outer(norm, norm)
    assert np.allclose(space.own @ space.own.T, own)
    assert np.allclose(space.rows(words) @ space.rows(words).T, own)
    weights = np.arange(space.white.shape[1], dtype=float)
    assert np.allclose(toxicity.word_scores(code, number, space.table(weights)), space.rows(words) @ weights, atol=1e-5)


def test_trees_walk_like_plain_code():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(500, 4))
    label = ((rows[:, 0] > 0) ^ (rows[:, 2] > 0.5)).astype(float)
    model = quality.fit(rows, label, trees=30, depth=3)
    for i in range(20):
        total = model.start
        for t in range(len(model.leaf)):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(rows[i, model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - 7]
        assert np.isclose(model.margin(rows[i : i + 1])[0], total)
    assert np.mean((model.score(rows) >= 0.5) == label) > 0.95


def test_no_language_is_lost_among_many(spark):
    ids = spark.range(36_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('l', id % 60) AS lang")
    few = spark.range(50_000, 50_020).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('rare', id % 10) AS lang")
    picked = {int(r.text.split()[1]) for r in language._sample(ids.union(few)).collect()}
    assert picked >= set(range(50_000, 50_020))
    at = [i % 60 for i in picked if i < 36_000]
    assert set(at) == set(range(60)) and {at.count(k) for k in range(60)} == {4000 // 70}


def test_shared_ids_and_texts_do_not_break_the_bound_on_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "PER_LANGUAGE", 100)
    docs = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id",
        "if(id % 9 < 4, 'the same', concat('text ', id)) as text",
        "if(id % 2 = 0, 'a', 'b') as lang",
    )
    hot = spark.range(5000).selectExpr("1L as doc_id", "'only this' as text", "'c' as lang")
    found = language._sample(docs.union(hot)).collect()
    per = {name: [r.text for r in found if r.lang == name] for name in "abc"}
    assert [len(per[name]) for name in "abc"] == [100, 100, 1]
    again = language._sample(docs.union(hot).repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_a_shared_id_does_not_break_the_bound_on_training_rows(spark):
    shared = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 5)
    docs = spark.range(3000).selectExpr(
        f"if(id % 3 = 0, {shared}, id + 100) as doc_id", "if(id % 9 = 0, null, concat('text ', id)) as text"
    )
    labels = spark.range(3200).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    found = training_texts(docs, labels, "toxic", 2000).collect()
    assert len(found) == len({r["__key"] for r in found}) <= 2000
    assert [r.text is not None for r in found if r["__key"] == shared] == [True]
    again = training_texts(docs.repartition(7), labels.repartition(3), "toxic", 2000).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
