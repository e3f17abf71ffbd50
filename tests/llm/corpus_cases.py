"""Small tables with everything that may go wrong, and brute-force versions of the operators."""

from __future__ import annotations

import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, "
    "predicted int, start int, bucket string, node bigint, words string, __content string, __row int"
)

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000
PASSAGE = (
    "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree "
    "near the river bank at midnight and nobody says a single word about it until the morning comes"
)
TEXTS = [
    (1, PASSAGE), (2, PASSAGE + " indeed"), (3, "Before. " + PASSAGE + "! After."), (4, PASSAGE), (5, ""), (6, None),
    (7, "   \n\t "), (8, "!!! ???"), (9, "a"), (10, LONG), (11, "by " * 300), (12, "ÄÖÜ straße naïve 漢字 \U0001f600 ▁x"),
    (13, "mail a.b@c.example.com or +1 (555) 555-1234, card 4539 1488 0343 6467, host 10.0.0.255, not 10.0.0.256"),
    (14, "x" * 3000), (14, "x" * 3000), (15, "tie tie tie"), (15, "tie tie tie"), (None, "no id here"), (16, "\x01 mark \x01"),
]


def rows(texts=TEXTS):
    return [
        (i, t, "en" if n % 3 else None, "s", len(t or ""), 0.5, 1, 7, "b", 9, "w", "c", 3)
        for n, (i, t) in enumerate(texts)
    ]


def odd(spark, texts=TEXTS):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash."""
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(sorted(r.items(), key=str)))


def one_for_each(docs, result):
    """One result row for each row, with the same ids."""
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in docs.select("doc_id").collect())
    found = result.collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in found) == ids
    return found


def split_words(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))
