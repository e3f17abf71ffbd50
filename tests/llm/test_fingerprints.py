import hashlib
import re

import xxhash

from basketlens.llm import fingerprints as fp
from basketlens.llm.queries import QUERIES
from conftest import SF_DIR
from corpus_cases import PASSAGE, TEXTS, empty, odd, one_for_each

FULL = (1 << 64) - 1


def kept(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]
    if not words:
        return []

    def rotated(value, bits):
        return ((value << bits) | (value >> (64 - bits))) & FULL

    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    grams = []
    for i in range(max(1, len(words) - fp.GRAM + 1)):
        if len(words) >= fp.GRAM:
            value = 0
            for h in hashes[i : i + fp.GRAM]:
                value = rotated(value, 1) ^ h
        else:  # what doubling makes of a gram that ends early
            have = hashes + [None] * 4

            def join(a, b, bits):
                return a if b is None else rotated(a, bits) ^ b

            two = [None if a is None else join(a, b, 1) for a, b in zip(have, have[1:])]
            value = join(join(two[0], two[2], 2), have[4], 1)
        grams.append(value & 0xFFFFFFFF)
    out = []
    for i in range(max(1, len(grams) - fp.WINDOW + 1)):
        window = grams[i : i + fp.WINDOW]
        low = min(window)
        place = max(i + j for j, g in enumerate(window) if g == low)
        if not out or out[-1] != (low, place):
            out.append((low, place))
    return out


def printed(grams):
    return ",".join(f"{h:x}:{p}" for h, p in grams)


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_on_odd_rows(spark):
    docs = odd(spark)
    found = one_for_each(docs, fp.fingerprint_report(docs))
    order = sorted(((-(2**63) if i is None else i), t or "") for i, t in TEXTS)
    want = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        want.append((
            i, len(text), hashlib.sha256(new.encode()).hexdigest(), printed(kept(text)), printed(kept(new)),
            round(likeness(kept(text), kept(new)), 9), round(likeness(kept(text), kept(following)), 9),
        ))
    got = [(-(2**63) if r.doc_id is None else r.doc_id, *tuple(r)[1:5], round(r[5], 9), round(r[6], 9)) for r in found]
    assert sorted(got) == sorted(want)


def test_guarantee_and_empty_tables(spark):
    shared = " ".join(PASSAGE.split()[: fp.GRAM + fp.WINDOW - 1])
    docs = odd(spark, [(1, "one two three " + shared), (2, shared + " four five six"), (3, "nothing alike")])
    found = {r.doc_id: r for r in fp.fingerprint_report(docs).collect()}
    assert found[1].near_next > 0 and found[2].near_next == 0
    assert fp.fingerprint_report(empty(spark)).count() == 0
    alone = fp.fingerprint_report(odd(spark, [(1, "only one here")])).first()
    assert alone.near_next == 1.0


def test_nothing_leaves_the_jvm(spark):
    plan = QUERIES["op9_fingerprints"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
