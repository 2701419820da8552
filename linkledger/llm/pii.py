"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text and stops at anchors: at-signs, plus signs, digits, ``://`` and
cue words of accounts. A local parser per kind expands each anchor to its span and validates it. Every parser looks
at a stretch of text once, so the work is linear in the text whatever it holds.

Base kinds are email, ip, card and phone; per kind the spans are the leftmost matches that do not overlap, and a
span that fails its check is dropped without another try. The method adds ``url`` and ``account`` spans.
A null text has no spans, as an empty one. Offsets are code points, ends exclusive. Repeated rows are read each, very
long texts whole; an empty table gives no rows. Other columns play no part in spans, and pass through where texts are
masked.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import with_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "account")
#: Words in front of an account number or a similar identifier.
CUES = ("iban", "account", "acct", "routing", "passport", "ssn")

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_FOUR_PARTS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"[A-Za-z0-9\[][^\s<>\"'`{}|\\^]*")
_ACCOUNT = re.compile(r"(?:[ \t]?(?:number|no\.?|id))?[ \t]?[:#=]?[ \t]?([A-Z]{0,4}[0-9](?:[ -]?[0-9A-Z]){5,33})(?![0-9A-Za-z])")
_SCHEMES = ("https", "http", "ftps", "ftp")


@functools.cache
def _anchors() -> ahocorasick.Automaton:
    """One word per anchor; the value is its parser and its length."""
    automaton = ahocorasick.Automaton()
    words = [("@", "email"), ("+", "phone"), ("://", "url")] + [(d, "digit") for d in "0123456789"]
    words += [(form(c), "account") for c in CUES for form in (str.lower, str.upper, str.capitalize)]
    for word, kind in words:
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _part_ok(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by kind in the order of KINDS and then by start."""
    found = {kind: [] for kind in KINDS}
    email_from = ip_from = card_from = url_from = account_from = 0
    phone_from = 0
    text = text or ""
    for last, (kind, length) in _anchors().iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= card_from:
                card_from = _CARD.match(text, at).end()
                if card_from - at >= 13:
                    digits = _digits(text[at:card_from])
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        found["card"].append((at, card_from))
            if at >= ip_from:
                four = _FOUR_PARTS.match(text, at)
                ip_from = (four or _DOTTED.match(text, at)).end()
                if four and all(map(_part_ok, four[0].split("."))):
                    found["ip"].append((at, ip_from))
        elif kind == "email":
            start = at
            while start > email_from and text[start - 1] in _LOCAL_PART:
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                email_from = domain.end()
                found["email"].append((start, email_from))
        elif kind == "phone":
            match = _PHONE.match(text, at) if at >= phone_from else None
            if match:
                phone_from = match.end()
                if 9 <= len(_digits(match[0])) <= 15:
                    found["phone"].append(match.span())
        elif kind == "url":
            scheme = next((s for s in _SCHEMES if at >= len(s) and text[at - len(s):at].lower() == s), None)
            rest = _AUTHORITY.match(text, at + 3) if scheme and at - len(scheme) >= url_from else None
            if rest:
                url_from = at + 3 + len(rest[0].rstrip(".,;:!?)]*"))
                if url_from > at + 3:
                    found["url"].append((at - len(scheme), url_from))
        elif at >= account_from and not (at and text[at - 1].isalnum()):
            match = _ACCOUNT.match(text, last + 1)
            if match and sum(c.isdigit() for c in match[1]) >= 6:
                account_from = match.end(1)
                found["account"].append(match.span(1))
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def span_digests(docs: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans of each document."""
    def make(texts):
        found = [find_spans(t) for t in texts]
        base = [[s for s in spans if s[0] in BASE_KINDS] for spans in found]
        counts = [[sum(s[0] == kind for s in spans) for spans in base] for kind in BASE_KINDS]
        return [*counts, [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], [_joined(f) for f in found]]

    schema = ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return with_columns(docs.select("doc_id", "text"), "text", make, schema).drop("text")


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union goes, under the
    name of the one that begins first."""
    spans = sorted((a, -b, kind) for kind, a, b in find_spans(text))
    if not spans:
        return text
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, -b)
    return "".join(out) + text[done:]


def masked(docs: DataFrame, length: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``; only texts with personal data change, and with them the column ``length``, if
    it is named, which holds their characters."""
    name = "masked_text"
    while name in docs.columns:
        name += "_"
    done = with_columns(docs, "text", lambda texts: [[mask(t) for t in texts]], f"{name} string")
    changed = {"text": done[name].alias("text")}
    if length:
        kind = docs.schema[length].dataType
        same = done[name].eqNullSafe(done["text"])
        changed[length] = F.when(same, done[length]).otherwise(F.length(done[name]).cast(kind)).alias(length)
    return done.select([changed.get(c, done[c]) for c in docs.columns])
