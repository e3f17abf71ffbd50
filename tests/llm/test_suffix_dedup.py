import hashlib
import random
import re

import numpy as np
import pytest

from basketlens.llm import suffix_dedup as sd
from corpus_cases import PASSAGE, TEXTS, empty, odd, one_for_each


def test_period_is_covered():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh "])
def test_sorted_suffixes(letters):
    rng = random.Random(len(letters))
    base = bytes(rng.choice(letters.encode()) for _ in range(300))
    raw = np.frombuffer(base + b"x" + base[50:] + b"y" + base[:200], dtype=np.uint8)
    starts = np.arange(len(raw) - sd.LENGTH + 1)
    block = sd.SuffixBlock(raw)
    ordered = block.order(starts)
    strings = [raw[s : s + sd.LENGTH].tobytes() for s in ordered]
    assert strings == sorted(strings) and sorted(ordered.tolist()) == starts.tolist()
    same = block.same_as_before(ordered).tolist()
    assert same == [False] + [a == b for a, b in zip(strings, strings[1:])]


def test_window_hashes_and_minima():
    raw = np.frombuffer(b"abcabcabcabd" * 12, dtype=np.uint8)
    for size in (1, 3, 32, 100):
        found = sd.window_hashes(raw, size)
        parts = [raw[i : i + size].tobytes() for i in range(len(raw) - size + 1)]
        assert len(found) == len(parts) and len(set(found.tolist())) == len(set(parts))
    values = np.array([5, 3, 8, 3, 9, 1, 7])
    assert sd.window_minima(values, 3).tolist() == [3, 3, 3, 1, 1]


def brute(texts):
    """By doc_id; ids must be unique."""
    first = {}
    for i, text in sorted(texts.items()):
        raw = text.encode()
        for p in range(len(raw) - sd.LENGTH + 1):
            first.setdefault(raw[p : p + sd.LENGTH], (i, p))
    out = {}
    for i, text in texts.items():
        raw = text.encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - sd.LENGTH + 1):
            if first[raw[p : p + sd.LENGTH]] != (i, p):
                mark[p : p + sd.LENGTH] = b"\x01" * sd.LENGTH
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        spans = len(re.findall(b"\x01+", bytes(mark)))
        out[i] = (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [sd.HOT, 2])
def test_removed_bytes(spark, hot):
    rng = random.Random(8)
    parts = [" ".join(rng.choices(PASSAGE.split(), k=rng.randrange(3, 40))) for _ in range(12)]
    texts = {i: " ".join(rng.choices(parts, k=rng.randrange(1, 7))) for i in range(80)}
    texts |= {100: PASSAGE * 3, 101: "ab" * 400, 102: "ab" * 60, 103: "é" * 90, 104: PASSAGE[:99], 105: PASSAGE[20:119]}
    docs = odd(spark, sorted(texts.items()))
    found = {r.doc_id: tuple(r)[1:5] for r in sd.deduplicated(docs, groups=5, hot=hot).collect()}
    want = brute(texts)
    assert found == want
    assert sum(r[1] for r in want.values()) > 0


def test_odd_rows(spark):
    docs = odd(spark)
    found = one_for_each(docs, sd.suffix_dedup_report(docs))
    want = brute({-1 if i is None else i: t or "" for i, t in TEXTS})
    for r in found:
        assert tuple(r)[1:] == want[-1 if r.doc_id is None else r.doc_id]
    assert sd.suffix_dedup_report(empty(spark)).count() == 0


def test_one_id_with_two_texts(spark):
    docs = odd(spark, [(1, PASSAGE), (1, "Also: " + PASSAGE), (2, PASSAGE)])
    found = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in sd.suffix_dedup_report(docs).collect())
    n = len(PASSAGE)
    assert found[2] == (2, n, n)
    assert sorted(r[2] for r in found[:2]) == [0, n]
