import hashlib
import re

import pytest

from plaudit.llm.pii import KINDS, personal_spans, sanitise, span_report
from tests.llm.cases import documents, edge_documents, empty_documents, prose

# The contract's patterns, as they stand.
BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


TEXTS = [
    "a@b.cd@e.f x.y+z@mail-1.example.com. @no a@b a@b. a@.b é@b.c a_b@c.d_e@f.g.h --@--.--", "a@b.c@d.e@f.g", "a@b.c_d@e.f",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 001.002.003.004 1.2.3 1..2.3.4 1.2.3.4a 99999999999999999999.1.1.1",
    "4539 1488 0343 6467 4539-1488-0343-6467 4539148803436467 4539  1488 0343 6467 12 34 5-6 0000000000000 000000000000",
    "+1 (212) 555-0187 ++49 30 901820 +123 +1234567890123456 +1 2 3 4 5 6 7 8 9. +1(((((2)))))345678901 4539148803436467+15551234567",
    "漢字 joe@mail.com 🙂 +44 20 7946 0958 é 10.0.0.1", "x" * 3000 + "@" + "y" * 3000, "1" * 4000, "1." * 3000, "+1" + "(" * 4000,
    "1 " * 3000, ("a@b.c " * 300), None, "", "4111111111111111 4111 1111 1111 1111 41111111111111111111",
]


def test_base_spans_same_as_by_hand(spark):
    rows = {r.doc_id: r for r in span_report(documents(spark, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    found = 0
    for i, text in enumerate(TEXTS):
        want = base(text)
        found += len(want)
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), text and text[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert set(joined(want).split(",")) - {""} <= set(r.spans.split(",")) - {""}
    assert found > 320


@pytest.fixture()
def corpus(spark):
    texts = [prose(i, 80) for i in range(60)]
    # One word stands by one address only; another is common.
    for i in range(4):
        texts[i] += f" seen {prose(500 + i, 3)} Zanzibarwhale common jo@x.example.com other{'abcd'[i] * 4} {prose(700 + i, 40)}"
    for i in range(10, 50):
        texts[i] += " common words"
    return documents(spark, texts), texts


def test_disclosing_terms(corpus):
    docs, texts = corpus
    rows = {r.doc_id: r.spans for r in personal_spans(docs).collect()}
    for i, text in enumerate(texts):
        terms = [text[s:e] for s, k, e in rows[i] if KINDS[k] == "term"]
        if i < 4:
            assert "Zanzibarwhale" in terms and "common" not in terms
            # seen in one surrounding only
            assert not any(t.startswith("other") for t in terms)
        else:
            assert terms == []


def test_sanitised_text(corpus):
    docs, texts = corpus
    got = {r.doc_id: r.text for r in sanitise(docs).collect()}
    for i, text in enumerate(texts):
        if i < 4:
            assert "jo@x" not in got[i] and "[EMAIL]" in got[i] and "Zanzibarwhale" not in got[i]
            assert "common" in got[i]
        else:
            assert got[i] == text


def test_overlapping_spans_are_masked_whole(spark):
    text = "call +4539148803436 or +1 212 555 0187.1.2.3 end 4539148803436467@x.com"
    got = sanitise(documents(spark, [text])).first().text
    assert not re.search("[0-9]{3}", got) and got.startswith("call ") and " end " in got


def test_edge_cases(spark):
    docs = edge_documents(spark)
    rows = span_report(docs).collect()
    assert len(rows) == docs.count()
    assert {r.spans for r in rows if r.doc_id in (0, 1, 2, 12)} == {""}
    out = sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert span_report(empty_documents(spark)).count() == 0
    assert sanitise(empty_documents(spark)).count() == 0


def test_terms_far_from_the_mention(spark):
    """Names near the address and far from it, short ones and in scripts without spaces,
    are masked at every place, but only in documents that mention the entity."""
    filler = [prose(i, 60).upper() for i in range(40)]
    texts = [f"{t} the {t[::-1]}" for t in filler]
    for i in range(4):
        texts[i] = (
            f"Quaggafar {filler[i]} wrote Li to jo@x.example.com with Zanzibarwhale today {prose(900 + i, 30).upper()} "
            f"and Zanzibarwhale again, 見{'東西南北'[i]}王小明{'一二三四'[i]}了 for LI."
        )
    docs = documents(spark, texts)
    rows = {r.doc_id: r.spans for r in personal_spans(docs).collect()}
    got = {r.doc_id: r.text for r in sanitise(docs).collect()}
    for i in range(4):
        terms = [texts[i][s:e] for s, k, e in rows[i] if KINDS[k] == "term"]
        assert terms.count("Zanzibarwhale") == 2 and "Quaggafar" in terms and {"Li", "LI", "王小", "小明"} <= set(terms)
        assert not re.search("Zanzibarwhale|Quaggafar|王|小|明|Li|LI\\.", got[i]) and "[EMAIL]" in got[i]
    for i in range(4, 40):
        assert got[i] == texts[i] and len(rows[i]) == 0


def test_copies_of_a_passage_are_no_evidence(spark):
    """One text four times, and an address twice in one text, disclose nothing."""
    texts = [f"Zanzibarwhale {prose(1, 40)} jo@x.example.com {prose(2, 40)}"] * 4
    texts += [f"Quaggafar a@b.example.org {prose(3, 40)} a@b.example.org {prose(4, 40)}"] + [prose(i, 60) for i in range(20, 50)]
    rows = personal_spans(documents(spark, texts)).collect()
    assert all(KINDS[s.kind] != "term" for r in rows for s in r.spans)
