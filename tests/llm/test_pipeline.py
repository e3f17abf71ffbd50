import corpus_pipeline as cp
from basketlens.llm import near_dedup as nd
from basketlens.llm import sentencepiece_viterbi as sv
from basketlens.llm.decontamination import contamination_report
from basketlens.llm.pii import pii_report
from basketlens.llm.quality import quality_scores
from conftest import SF_DIR


def test_every_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    now, seen = docs, {}
    for name, stage in cp.STAGES:
        seen[name] = cp.staged(stage(spark, now, SF_DIR))
        if name != cp.STAGES[-1][0]:
            assert seen[name].columns == docs.columns
        now = seen[name]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    accepted = quality_scores(docs, labels).where("predicted = 1")
    assert ids(seen["quality"]) == ids(accepted) and len(ids(accepted)) < docs.count()
    classes = nd.near_duplicate_classes(seen["quality"]).collect()
    assert ids(seen["near_dedup"]) == sorted({r.class_id for r in classes})
    report = contamination_report(seen["near_dedup"], benchmark)
    assert ids(seen["decontamination"]) == ids(report.where("not contaminated"))
    assert pii_report(seen["pii"]).where("spans <> ''").count() == 0
    assert ids(seen["pii"]) == ids(seen["decontamination"])
    texts = {r.doc_id: r.text for r in seen["pii"].collect()}
    words = sv.vocabulary(sv.MODEL_FILE)
    for r in seen["sentencepiece"].collect():
        assert sv.decode(words, r.ids) == texts[r.doc_id] and r.n_ids == len(r.ids)


def test_stages_take_odd_rows(spark):
    from corpus_cases import empty, odd

    for docs in (odd(spark), empty(spark)):
        now = docs
        for _, stage in cp.STAGES:
            now = stage(spark, now, SF_DIR)
        now.collect()
