import hashlib
import random
import re

import pytest
from pyspark.errors import AnalysisException

from basketlens.llm import pii
from basketlens.llm.queries import QUERIES
from conftest import SF_DIR
from corpus_cases import TEXTS, empty, odd, one_for_each

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    "a@b.c_d@e.f,x@y.z.@q.r", "1.2.3.4.5.6.7.8", "001.0255.0.0 999999999999.1.1.1", "4539148803436467 4539148803436468",
    "4539-1488-0343-6467-1", "+1 555 555 1234 5678 90123", "+123456789", "+1 (23) 45-67.89)", "1 2 3 4 5 6 7 8 9 0 1 2 8",
    "mail@@x.y a@b a@b.", "é1.2.3.4é +49 (30) 1234567x", "0" * 16, "1" * 5000 + " " + "1." * 3000, "%%%" + "a" * 9000, "+" * 50 + "1 2",
    "tel 555-123-4567 or (555) 123-4567", "user (at) host.example", "10.0.0.1:8080", "\x01+1 555 555 1234\x01",
]


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            twice = int(c) * 2
            total += int(c) if i % 2 == 0 else twice - 9 if twice > 9 else twice
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m[0])] for k, p in BASE.items()}


def printed(spans):
    return ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])


def check(docs, texts):
    found = one_for_each(docs, pii.pii_report(docs))
    for r in found:
        want = base(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in BASE], texts[r.doc_id][:80]
        assert r.base_sha256 == hashlib.sha256(printed(want).encode()).hexdigest()
        every = [s.split(":") for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{b}" for k in BASE for a, b in want[k]} <= {":".join(s) for s in every}
        assert every == sorted(every, key=lambda s: (list(BASE).index(s[0]), int(s[1])))
        assert len(every) == sum(map(len, want.values())) + r.n_added
    return found


def test_base_spans(spark):
    docs = odd(spark, list(enumerate(HARD)))
    check(docs, dict(enumerate(HARD)))
    check(odd(spark), dict(TEXTS))
    assert pii.pii_report(empty(spark)).count() == 0


def learnable():
    """Cards in one context, most of them right; long numbers elsewhere."""
    texts = []
    for i in range(400):
        body = f"{4000 + i % 1000} {1111 + i} {2222 + i}"
        last = next(f"{n:04}" for n in range(10_000) if valid("card", f"{body} {n:04}"))
        texts.append((i, f"pay with {body} {last} today"))
        texts.append((1000 + i, f"part no. A{i}-{i * 7919 % 10**9:09}/{i % 10} in stock, call +1 555 {100 + i % 900} {1000 + i}"))
    texts += [(5000, "pay with 4000 1234 5678 9011 today"), (5001, "part no. A7-000055433/7 in stock"), (5002, "nothing")]
    return texts


def test_trees_add_what_looks_alike(spark):
    texts = learnable()
    found = {r.doc_id: r for r in check(odd(spark, texts), dict(texts))}
    assert not valid("card", "4000 1234 5678 9011")
    assert found[5000].spans == "card:9:28" and found[5000].n_card == 0
    assert found[5001].spans == "" and found[5002].spans == ""


def test_redaction(spark):
    docs = odd(spark)
    new = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert new[13] == "mail [EMAIL] or [PHONE], card [CARD], host [IP], not 10.0.0.256"
    assert all(new[i] == t for i, t in TEXTS if i != 13)
    assert pii.redacted(docs).columns == docs.columns
    assert pii.redacted(empty(spark)).count() == 0


def test_nothing_leaves_the_jvm(spark):
    plan = QUERIES["op2_pii"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_redaction_changes_nothing_but_spans(spark):
    docs = odd(spark, [(1, "a\x01b mail x@y.zz \x01"), (2, "\x01\x01"), (3, None), (4, "x@y.zz\x02\x01")])
    found = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert found == {1: "a\x01b mail [EMAIL] \x01", 2: "\x01\x01", 3: None, 4: "[EMAIL]\x02\x01"}


def test_many_spans_in_one_text(spark):
    """Tens of thousands of base spans, added candidates and gaps, over many pieces of a text."""
    text = "é".join(f" +{i % 9 + 1}{i:09} x a{i}@b.cc, ({i:07}) 𝄞" for i in range(20_000))
    docs = odd(spark, [(1, text), (2, "x" * 5000 + " a@b.cc " + "é" * 5000 + " (1234567)")])
    scorer = pii.Scorer([(1.0, (0, 9.0, (1.0,), (-1.0,)))], dict.fromkeys(pii.KINDS, 0.5))  # short ones are accepted
    found = {r.doc_id: r for r in pii.with_spans(docs, scorer).select("doc_id", "__b_phone", "__b_email", "__b_added").collect()}
    want = base(text)
    assert [(s.start, s.stop) for s in found[1]["__b_phone"]] == want["phone"]
    assert [(s.start, s.stop) for s in found[1]["__b_email"]] == want["email"]
    assert all(text[s.start : s.stop] == s.value for s in found[1]["__b_added"]) and len(found[1]["__b_added"]) == 20_000
    new = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    gaps = re.sub(BASE["email"], "[EMAIL]", re.sub(BASE["phone"], "[PHONE]", text))
    assert new[1] == gaps
    assert new[2] == "x" * 5000 + " [EMAIL] " + "é" * 5000 + " (1234567)"


def test_overlaps_by_search_and_greedy_choice(spark):
    rng = random.Random(5)

    def spans(many):
        starts = [rng.randrange(60) for _ in range(many)]
        return [("card", s, s + rng.randrange(1, 9), "") for s in starts]

    rows = [(i, spans(rng.randrange(12)), sorted(spans(rng.randrange(30)), key=lambda s: (s[1], -s[2]))) for i in range(300)]
    kind = f"array<{pii.SPAN}>"
    table = spark.createDataFrame(rows, f"id int, base {kind}, open {kind}")
    untouched = pii._untouched(table.base, table.open)
    for r in table.select("base", "open", untouched.alias("free"), pii._in_a_row(table.open).alias("row")).collect():
        assert r.free == [c for c in r.open if all(b.stop <= c.start or c.stop <= b.start for b in r.base)]
        taken = []
        for c in r.open:
            if not taken or taken[-1].stop <= c.start:
                taken.append(c)
        assert r.row == taken


def test_a_shared_id_gives_one_training_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "with_base", lambda docs, *_: seen.append(docs) or docs.select("no such column"))
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id + 100) as doc_id", "concat('call ', id) as text")
    with pytest.raises(AnalysisException):
        pii.train(docs, most=50)
    assert seen[0].count() == 50 and seen[0].groupBy("__key").count().where("count > 1").count() == 0


def test_every_document_counts_in_training(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "with_base", lambda docs, *_: seen.append(docs) or docs.select("no such column"))
    docs = spark.range(25_000).selectExpr("if(id % 5 = 0, null, id div 2) as doc_id", "concat('call ', id) as text")
    with pytest.raises(AnalysisException):
        pii.train(docs)
    assert seen[0].count() == 25_000
