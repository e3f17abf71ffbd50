import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import sentencepiece_viterbi as sv
from corpus_cases import TEXTS, empty, odd, one_for_each

WORDS = sv.vocabulary(sv.MODEL_FILE)
TEXT = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="thonie \n▁é", max_size=80),
    st.lists(st.sampled_from(["the", " tion", "  ", "X", "\n", "漢", "international"]), max_size=30).map("".join),
)


def best_path(text):
    """The whole lattice at once."""
    best, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - WORDS.longest), end):
            found = WORDS.piece.get(text[begin:end])
            if found and best[begin] + found[1] > best[end]:
                best[end], back[end] = best[begin] + found[1], (begin, [found[0]])
        if text[end - 1] not in WORDS.piece and best[end - 1] + WORDS.fallback > best[end]:
            best[end] = best[end - 1] + WORDS.fallback
            back[end] = (end - 1, [WORDS.byte_id[b] for b in text[end - 1].encode()])
    ids, end = [], len(text)
    while end:
        ids = back[end][1] + ids
        end = back[end][0]
    return ids


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_streamed_cached_and_whole_search_agree(text, step):
    ids = sv.Encoder(WORDS).encode([text])[0].tolist()
    assert sv.decode(WORDS, ids) == text
    if text:
        assert ids == best_path(" " + text)
        stream, out = sv.StreamingViterbi(WORDS), []
        for at in range(0, len(text) + 1, step):
            out += stream.push((" " + text)[at : at + step])
        assert out + stream.finish() == ids


def test_the_window_stays_small():
    stream = sv.StreamingViterbi(WORDS)
    for _ in range(300):
        stream.push("thetionandofinterwordsthatgoonandon")
        assert stream.window() < 8 * WORDS.longest


@pytest.mark.parametrize("c", ["a", " ", "-", "漢"])
def test_long_runs_of_one_character_take_linear_time(c):
    def seconds(many):
        start = time.perf_counter()
        ids = sv.Encoder(WORDS).encode([c * many])[0]
        assert sv.decode(WORDS, ids) == c * many
        return time.perf_counter() - start

    assert sv.Encoder(WORDS).encode([c * 700])[0].tolist() == best_path(" " + c * 700)
    assert seconds(200_000) < 12 * seconds(25_000) + 1


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(sv, "REMEMBERED", 10)
    encoder = sv.Encoder(WORDS)
    for i in range(50):
        encoder.encode([f"word{i} other{i}"])
        assert len(encoder.memory) <= 13


def test_query_and_columns_on_odd_rows(spark):
    docs = odd(spark)
    for r in one_for_each(docs, sv.encode_and_verify(docs)):
        assert r.round_trip
        assert (r.n_ids == 0) == (not dict(TEXTS)[r.doc_id])
    back = docs.select("doc_id", "text", sv.text_column(sv.ids_column("text")).alias("again")).collect()
    assert all((r.text or "") == r.again for r in back)
    assert sv.encode_and_verify(empty(spark)).count() == 0


def test_ids_leave_a_worker_in_portions():
    texts = ["word " * 2000] * 100 + [None, "", "x" * 300_000]  # 1.3 million characters in one batch
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = list(sv.encoded_batches(iter([batch])))
    assert len(out) > 3 and max(b.column("ids").values.nbytes for b in out) < 8 * sv.PORTION
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert [sv.decode(WORDS, r["ids"]) for r in rows] == [text or "" for text in texts]
    assert all(r["n_ids"] == len(r["ids"]) for r in rows)


def test_new_units_take_little_memory():
    texts = [" ".join(f"{i * 37 % 99991:x}unit{i * 7919:x}" for i in range(start, start + 500)) for start in range(0, 100_000, 500)]
    tracemalloc.start()
    encoder = sv.Encoder(sv.Vocabulary(sv.MODEL_FILE))
    for part in sv.in_portions(pa.array(texts)):
        encoder.encode(part)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 75e6
