"""Spans against plain regular expressions."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from linkledger.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(s[::-1])) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def base(text):
    return [s for s in pii.find_spans(text) if s[0] in PATTERNS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@.+- 0125()é9", max_size=60))
def test_same_as_regex(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize("text", [
    "", "a@b@c.de x@y", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+49 (30) 1234-5678 x", "256.1.1.1 001.002.3.4",
    "a@b.c@d.e", "+1" + " " * 50 + "2", "9" * 5000, "1." * 3000, "@" * 2000, "a" * 3000 + "@b.c", "+" * 500 + "123456789",
])
def test_edges(text):
    assert base(text) == brute(text)


def test_added_kinds():
    kinds = {k for k, *_ in pii.find_spans("see https://a.example/x?y=1. IBAN: DE44 5001 0517 5407 3249 31 ok")}
    assert {"url", "account"} <= kinds
    assert pii.find_spans("on account of the rain, no cue here") == []


def test_mask():
    assert pii.mask("mail me@x.org now") == "mail [EMAIL] now"
    assert pii.mask("plain") == "plain" and pii.mask(None) is None


def test_query(spark):
    rows = [(1, "a@b.co 1.2.3.4", 7), (2, None, None), (None, "", 1), (1, "a@b.co 1.2.3.4", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = pii.span_digests(docs).collect()
    assert len(got) == 4
    one = next(r for r in got if r.doc_id == 1)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 0, 0)
    want = "email:0:6,ip:7:14"
    assert one.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and one.spans == want
    empty = next(r for r in got if r.doc_id == 2)
    assert empty.spans == "" and empty.base_sha256 == hashlib.sha256(b"").hexdigest()
    out = pii.masked(docs.withColumnRenamed("spans", "masked_text"))
    assert out.columns == ["doc_id", "text", "masked_text"] and out.count() == 4
    assert pii.span_digests(docs.limit(0)).count() == 0
