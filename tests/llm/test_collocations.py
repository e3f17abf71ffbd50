import random
import re
from collections import Counter, defaultdict

import pytest

from basketlens.llm import collocations as co
from corpus_cases import SCHEMA, empty, odd

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            cuts = [(co.SCALE * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            longer = [c for p, c in f.items() if len(phrase) == 2 and len(p) == 3 and phrase in (p[:2], p[1:]) and c >= least]
            if any(100 * c >= co.COVERED * a for c in longer):
                continue
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def table(spark, rows, parts=4):
    full = [(i, t, g, "s", 1, 0.5, 1, 7, "b", 9, "w", "c", 3) for i, (t, g) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def found(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def prose(seed, many=300):
    rng = random.Random(seed)
    words = ["a", "b", "the", "The", "ä", "Ä", "é漢", "x1", "\U0001f600", "z z", "-"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "?! ", ";x:"]
    out = []
    for _ in range(many):
        n = rng.choice([0, 1, 2, 5, 30])
        out.append(("".join(rng.choice(words[: rng.choice([3, 11])]) + rng.choice(ends) for _ in range(n)), rng.choice(["en", "fr", None, "und", ""])))
    return [*out, (None, "en"), ("", None), (" \t ", "fr"), (".,;", "de"), ("one two", "it")]


@pytest.mark.parametrize("run,ranges", [(1_000_000, 8), (50, 40), (1, 3), (1000, 1)])
def test_against_brute_force(spark, run, ranges):
    rows = prose(run)
    assert found(co.collocations(table(spark, rows), run=run, ranges=ranges)) == brute(rows)


def test_few_rows_of_each_language_and_low_counts(spark):
    rows = prose(7, 200)
    assert found(co.collocations(table(spark, rows), top=5, least=2, run=30, ranges=10)) == brute(rows, 2, 5)


def test_one_pair_is_a_third_of_everything(spark):
    rng = random.Random(4)
    rows = [("hot pair " + f"w{rng.randrange(400)}", "en") for _ in range(1500)]
    rows += [(f"w{rng.randrange(30)} w{rng.randrange(30)} w{rng.randrange(30)}", "en") for _ in range(1500)]
    docs = table(spark, rows)
    assert found(co.collocations(docs, run=200, ranges=30)) == brute(rows)
    # The pair's records lie in more than one range.
    at = co.bounds(docs, 30)
    assert sum(b[:2] == (b"hot", b"pair") for b in at["en"]) > 1


def test_counts_beyond_64_bits_and_ties(spark):
    big = 4_000_000_000_000
    got = spark.range(1).select(co._score(co.F.lit(big), co.F.lit(big + 1), co.F.lit(big + 2))).first()[0]
    assert got == co.SCALE * big * big // ((big + 1) * (big + 2))
    rows = [("b a. a b. d c. c d", "en")] * 12
    assert found(co.collocations(table(spark, rows))) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    docs = odd(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(co.collocations(docs)) == brute(rows)
    assert co.collocations(empty(spark)).count() == 0


def test_runs_come_back(spark):
    words, records = co.run_of(co.tokens(b"A b, a b c. c\tB a"))
    back, same = co.unpacked(*co.packed(words, records))
    assert back == words and all((x == y).all() for x, y in zip(records, same))
    merged_words, merged = co.merged([(back, same), co.run_of(co.tokens(b"zz a b. a"))])
    assert merged_words == sorted(merged_words) and merged[3].sum() == 12
    for bound in [(b"", b"", b""), (b"a", b"b", b""), (b"a", b"b", b"bb"), (b"a", b"c", b""), (b"zzz", b"", b"")]:
        (at,) = co.cuts(merged_words, merged, [bound])
        keys = [tuple(merged_words[c[i]] for c in merged[:3]) for i in range(len(merged[0]))]
        assert keys == sorted(keys) and at == sum(k < bound for k in keys)
