import hashlib

from basketlens.llm import decontamination as dc
from basketlens.llm.queries import ORACLES, QUERIES
from conftest import SF_DIR
from corpus_cases import PASSAGE, collected, empty, odd, one_for_each, split_words
from oracle import compare, connect

ITEMS = [
    (1, PASSAGE), (2, "over the lazy dog"), (3, None), (4, "  "), (5, "Tie TIE"), (5, "never said anywhere"),
    (6, "ÄÖÜ straße"), (7, "by " * 40), (8, "äöü straße"),
]


def brute(texts, items, size=dc.WINDOW):
    windows = {}
    for item, text in items:
        words = split_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in texts:
        words = split_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def test_odd_rows(spark):
    from corpus_cases import TEXTS

    docs = odd(spark)
    found = one_for_each(docs, dc.contamination_report(docs, benchmark(spark)))
    assert sorted(map(tuple, found), key=str) == brute(TEXTS, ITEMS)


def test_blocks_give_the_same(spark, monkeypatch):
    from corpus_cases import TEXTS

    monkeypatch.setattr(dc, "BLOCK_BYTES", 6_000)
    found = dc.contamination_report(odd(spark), benchmark(spark)).collect()
    assert sorted(map(tuple, found), key=str) == brute(TEXTS, ITEMS)


def test_empty_tables(spark):
    none = benchmark(spark, []).limit(0)
    assert dc.contamination_report(empty(spark), benchmark(spark)).count() == 0
    found = dc.contamination_report(odd(spark), none).collect()
    assert all(r.n_hit == 0 and r.n_items == 0 and not r.contaminated for r in found)


def test_contaminated_rows_go(spark):
    docs = odd(spark)
    kept = dc.decontaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in dc.contamination_report(docs, benchmark(spark)).collect() if r.contaminated}
    assert bad
    assert [r["doc_id"] for r in collected(kept)] == [r["doc_id"] for r in collected(docs) if r["doc_id"] not in bad]


def test_query_agrees_with_sql(spark):
    df = QUERIES["op4_decontamination"](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert compare(df, connect(SF_DIR), ORACLES["op4_decontamination"]) is None
