import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.llm import token_counts as tc
from corpus_cases import TEXTS, empty, odd, one_for_each

PIECES = st.sampled_from(["a", " b", "  ", "\n", "'s", " foo bar", "12 3", "é", "　", "!", " \n ", "\x1c"])


def whole(text):
    return len(tc.encoding(tc.RANKS_FILE).encode_ordinary(text))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(PIECES, max_size=60).map("".join),
    st.lists(st.tuples(st.integers(-2, 80), st.integers(-2, 20), st.lists(PIECES, max_size=3).map("".join)), max_size=8),
    st.sampled_from([1, 3, 16, 512]),
)
def test_edits_count_like_the_whole_text(text, edits, size):
    tree = tc.TokenTree(text, size=size)
    assert tree.total == whole(text)
    for start, many, new in edits:
        tree.edit(start, start + many, new)
        a = min(max(start, 0), len(text))
        text = text[:a] + new + text[min(max(start + many, a), len(text)) :]
        assert tree.text() == text
        assert tree.total == whole(text)


def test_an_edit_encodes_its_region_only():
    text = " ".join(random.Random(1).choices(["river", "stone", "a", "lantern"], k=20_000))
    tree = tc.TokenTree(text)
    tree.edit(50_000, 50_003, "xyz")
    assert 0 < tree.encoded < 4 * tc.LEAF


def test_query_on_odd_rows(spark):
    docs = odd(spark)
    found = one_for_each(docs, tc.counts_with_sample_edits(docs))
    texts = {i: t or "" for i, t in TEXTS}
    for r in found:
        text = texts[r.doc_id]
        n = len(text)
        assert (r.n_tokens, r.n_chars, r.n_edits) == (whole(text), n, 3)
        new = text[: n // 4] + text[:20] + text[n // 4 + 12 :]
        new = new[: n // 2] + " (see the note below)\n" + new[n // 2 :]
        new = new[: 3 * (n // 4)] + new[3 * (n // 4) + 30 :]
        assert r.n_tokens_edited == whole(new)
    assert tc.counts_with_sample_edits(empty(spark)).count() == 0


def test_null_edits(spark):
    docs = odd(spark)
    for edits in (F.lit(None).cast(tc.EDITS), F.array(F.lit(None)).cast(tc.EDITS)):
        for r in tc.token_counts(docs, edits).collect():
            assert r.n_edits == 0 and r.n_tokens == r.n_tokens_edited


def test_very_long_runs_of_white_space(monkeypatch):
    monkeypatch.setattr(tc, "_LONG_RUN", tc.re.compile(rf"[{tc.SPACES}]{{3,}}"))
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(["a", " ", "  ", "\n", "\t", "b!", "\u3000", " ", "\r\n", "7"]) for _ in range(rng.randrange(30)))
        assert tc.count(tc.RANKS_FILE, text) == whole(text)


def test_five_million_blanks_are_counted():
    for c in (" ", "\n", "\t"):
        tree = tc.TokenTree("a" + c * 5_000_000 + "b")
        few = tc.TokenTree("a" + c * 500_000 + "b")
        assert tree.chars[1] == 5_000_002 and tree.total > 9 * few.total
        assert few.total == whole("a" + c * 500_000 + "b")
