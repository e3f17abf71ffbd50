import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import near_dedup as nd
from corpus_cases import PASSAGE, collected, empty, odd, one_for_each

SHORT = st.lists(st.integers(0, 4), max_size=25)


def lcs(a, b, band=None):
    before = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        now = [0]
        for j, y in enumerate(b):
            hit = x == y and (band is None or abs(i - j) <= band)
            now.append(max(before[j + 1], now[j], before[j] + 1 if hit else 0))
        before = now
    return before[-1]


@settings(max_examples=300, deadline=None)
@given(SHORT, SHORT, st.integers(0, 30))
def test_banded_alignment(a, b, band):
    found = nd.banded_lcs(a, b, band)
    assert lcs(a, b, band) <= found <= lcs(a, b)
    assert nd.banded_lcs(a, b, 30) == lcs(a, b)


def brute(left, right):
    a, b = nd.shingles(left).tolist(), nd.shingles(right).tolist()
    common = lcs(a, b)
    return bool(a and b) and common / (len(a) + len(b) - common) >= nd.SIMILARITY - 1e-9


def test_similar_agrees_with_the_whole_alignment():
    rng = np.random.default_rng(5)
    both = set()
    for _ in range(200):
        left = rng.integers(0, 1 << 40, rng.integers(1, 80), dtype=np.uint64)
        right = left.copy()
        right[rng.integers(0, len(left), rng.integers(0, 3))] = 7
        assert nd.similar(left, right) == brute(left, right)
        both.add(brute(left, right))
    assert both == {True, False}


def lists_of(spark, words):
    return spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in words.items()], "node bigint, words binary")


def test_pairs_at_exactly_the_threshold(spark):
    rng = np.random.default_rng(6)
    words, pairs = {}, []
    for total in (63, 117, 126, 135, 234):
        many, extra = total // 9 * 4, total // 9
        left = rng.integers(0, 1 << 40, many + 4, dtype=np.uint64)
        right = np.concatenate((left, rng.integers(0, 1 << 40, extra, dtype=np.uint64)))
        assert nd.similar(left, right) and nd.similar(right, left) and brute(left, right)
        assert not nd.similar(left, np.append(right, np.uint64(1)))
        words |= {total: left, -total: right}
        pairs.append((total, -total))
    found = nd.compared(spark.createDataFrame(pairs, "a bigint, b bigint"), lists_of(spark, words)).collect()
    assert len(found) == 5 and all(r.linked for r in found)


def test_words_and_labels():
    a, b = nd.word_hashes("Foo, bar foo"), nd.word_hashes("x foo!")
    assert a[0] == a[2] == b[1] and a[0] != a[1]
    grams = nd.labelled(np.array([5, 5, 6], dtype=np.uint64))
    assert len(set(grams.tolist())) == 3


def near(text, rng, many):
    words = text.split()
    for _ in range(many):
        words[rng.randrange(len(words))] = f"other{rng.randrange(10**6)}"
    return " ".join(words)


def brute_classes(words):
    """The smallest linked id of every id, all pairs compared."""
    ids = sorted(words)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if nd.similar(words[a], words[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_groups_of_copies_become_one_class(spark):
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    texts = [(i, near(base, rng, 3)) for i in range(10, 60)] + [(60, base), (61, base)]
    texts += [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + PASSAGE) for i in range(100, 140)]
    docs = odd(spark, texts)
    found = {r.doc_id: r for r in nd.near_duplicate_classes(docs).collect()}
    classes = brute_classes({i: nd.word_hashes(t) for i, t in texts})
    assert {i: r.class_id for i, r in found.items()} == classes
    assert len({r.class_id for r in found.values()}) == 41
    assert sum(r.kept for r in found.values()) == 41


def test_copies_of_far_copies_are_found(spark):
    """Texts too far from the hub to be linked to it, but close to each other."""
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    far = [near(base, rng, 6) for _ in range(40)]
    texts = [(0, base), *((100 + i, near(base, rng, 1)) for i in range(30))]
    texts += [(200 + i, t) for i, t in enumerate(far)] + [(300 + i, near(t, rng, 1)) for i, t in enumerate(far)]
    half = " ".join(base.split()[:80])
    texts += [(400, half), (401, near(half, rng, 1))]
    found = {r.doc_id: r.class_id for r in nd.near_duplicate_classes(odd(spark, texts)).collect()}
    words = {i: nd.word_hashes(t) for i, t in texts}
    assert not nd.similar(words[0], words[200]) and nd.similar(words[200], words[300])
    assert all(found[200 + i] == found[300 + i] for i in range(40)) and found[400] == found[401]
    assert len({found[100 + i] for i in range(30)}) == 1
    assert len(set(found.values())) == len({root for root in brute_classes(words).values()})


def test_long_chains_of_links(spark):
    pairs = [(i, i + 1) for i in range(0, 60, 2)] + [(i + 1, i + 2) for i in range(0, 58, 2)] + [(100, 101)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r.node: r.root for r in nd.components(links).collect()}
    assert found == {i: 0 for i in range(60)} | {100: 100, 101: 100}


def test_odd_rows(spark):
    docs = odd(spark)
    found = one_for_each(docs, nd.near_duplicate_classes(docs))
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[4] == classes[1] == 1 and classes[5] == classes[6] == 5
    assert classes[7] == 7 and classes[8] == 8 and classes[15] == 15 and classes[None] is None
    kept = nd.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in collected(kept)]
    assert len(ids) == len(set(ids)) == len(set(classes.values()))
    assert nd.near_duplicate_classes(empty(spark)).count() == 0
    assert nd.without_near_duplicates(empty(spark)).count() == 0


def test_null_and_shared_ids_tie_nothing(spark):
    rng = random.Random(12)
    clean = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(90)) for _ in range(14)]
    texts = [(None, t) for t in clean[:6]] + [(None, near(clean[0], rng, 1)), (None, clean[1])]
    texts += [(7, t) for t in clean[6:10]] + [(7, clean[6].upper() + "!"), (7, near(clean[7], rng, 1))]
    texts += [(8, near(clean[8], rng, 1)), (9, clean[9]), (3, near(clean[13], rng, 1)), (5, clean[13]), (6, clean[12])]
    docs = odd(spark, texts)
    kept = sorted((str(r.doc_id), r.text) for r in nd.without_near_duplicates(docs).collect())
    assert len(kept) == len({t for _, t in kept}) == 12
    assert sum(i == "None" for i, _ in kept) == 6 and sum(i == "7" for i, _ in kept) == 4
    assert [i for i, _ in kept if i not in ("None", "7")] == ["3", "6"]
    words = dict(enumerate(nd.word_hashes(t) for _, t in kept))
    assert brute_classes(words) == {i: i for i in words}
    assert kept == sorted((str(r.doc_id), r.text) for r in nd.without_near_duplicates(docs.repartition(5, "text")).collect())
    found = one_for_each(docs, nd.near_duplicate_classes(docs))
    assert {(r.doc_id, r.class_id) for r in found} == {(None, None), (7, 7), (8, 7), (9, 7), (3, 3), (5, 3), (6, 6)}
    assert sum(r.kept for r in found) == 13  # one kept row is there twice


def test_short_texts_are_never_missed(spark):
    rng = random.Random(21)

    def some(many):
        return [f"w{rng.randrange(10**6)}" for _ in range(many)]

    texts, many = [], 0
    for size in (8, 9, 10, 12, 13, 16, 23, 31, 39, 44):
        for k in range(12):
            words = some(size)
            more = max(1, (size - 4) // 4)
            ends = (words + some(more), some(more) + words, words[:-more], words + some(more + 1))
            texts += [(many, " ".join(words)), (many + 1, " ".join(ends[k % 4]))]
            many += 2
    hub = some(8)  # every line has the hub's four shingles and one or two of its own
    texts += [(10000 + i, " ".join(hub + some(1 + i % 2))) for i in range(60)] + [(9999, " ".join(hub))]
    found = {r.doc_id: r.class_id for r in nd.near_duplicate_classes(odd(spark, texts)).collect()}
    assert found == brute_classes({i: nd.word_hashes(t) for i, t in texts})
    assert found[1] == 0 and found[10000] == 9999 and found[10001] == 10001


def test_added_passages_of_one_class_do_not_pair_its_members(spark, monkeypatch):
    rows = [(i, 1, 100, 90, True, [5, 6]) for i in range(2, 302)]
    near_ = spark.createDataFrame(rows, "node bigint, top bigint, n int, common int, close boolean, added array<bigint>")
    roots = spark.createDataFrame([(i, 1) for i in range(2, 300)], "node bigint, root bigint")
    met, apart = [], nd._apart
    monkeypatch.setattr(nd, "_apart", lambda one, two, *more: met.append((one.count(), two.count())) or apart(one, two, *more))
    pairs = {(r.a, r.b) for r in nd._through_added(near_, roots, 0.8).collect()}
    assert pairs == {(i, j) for j in (300, 301) for i in range(2, j)}
    assert met == [(4, 600)]


def test_unlinked_copies_that_share_added_passages_are_not_paired(spark):
    # 79 shingles of 100 in common with the hub and two added ones with each other: 81 of the 88.9 needed.
    for many in (300, 600):
        rows = [(i, 1, 100, 79, True, [5, 6, 1000 + i]) for i in range(2, 2 + many)]
        near_ = spark.createDataFrame(rows, "node bigint, top bigint, n int, common int, close boolean, added array<bigint>")
        roots = spark.createDataFrame([], "node bigint, root bigint")
        assert nd._through_added(near_, roots, 0.8).count() == 0


def test_added_passages_that_are_enough_are_met(spark):
    # 70 in common with the hub and 19 added ones: 89 of the 88.9 needed.
    shared = list(range(100, 119))
    rows = [(i, 1, 100, 70, True, [*shared, *range(1000 * i, 1000 * i + 11)]) for i in (2, 3)]
    rows.append((4, 1, 100, 70, True, [*shared[1:], *range(4000, 4012)]))
    near_ = spark.createDataFrame(rows, "node bigint, top bigint, n int, common int, close boolean, added array<bigint>")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    assert {tuple(r) for r in nd._through_added(near_, roots, 0.8).collect()} == {(2, 3)}
