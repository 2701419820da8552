"""Derivatives of WARC responses: linked metadata records and plain-text conversion records.

``responses`` makes response records of fetched pages, ``derive`` makes two records of every response:

* ``metadata``, as ``application/warc-fields``: title, language, number of links and one ``outlink`` line per link;
* ``conversion``, as ``text/plain``: the page without markup.

Both name their response in ``WARC-Refers-To`` and keep its target URI, date, HTTP headers and payload digest. Ids are
derived from the content of a row, so that a run can be repeated. ``serialized`` writes records in the format of the
standard. All steps are row by row in SQL functions; nothing is shuffled.

A null or empty payload gives an empty text, no title and no links; a null URI stays null and its header line is left
out. Repeated pages give repeated records with the same ids. A very long page is read whole, in its row; an empty table
gives no records. Other columns of the pages play no part.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

#: Date of records whose source does not say when it was fetched.
NO_DATE = "1970-01-01T00:00:00Z"

#: Elements whose content is not text, and elements that end a line.
_SILENT = ("script", "style", "noscript", "template", "head")
_LINE = ("p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|h1|h2|h3|h4|h5|h6|article|section|header|footer|nav|aside|main|"
         "blockquote|pre|form")
_CELL = "td|th"
#: Named character references, as written with their ampersand; frequent ones are found first.
_FREQUENT = ("&amp;", "&nbsp;", "&lt;", "&gt;", "&quot;", "&apos;", "&copy;", "&reg;", "&middot;", "&hellip;", "&ndash;",
             "&mdash;")
_NAMED = {name: html5[name[1:]] for name in _FREQUENT} | {f"&{name}": text for name, text in html5.items()}
_NAMED = {name: text.replace("\u00a0", " ") for name, text in _NAMED.items()}
#: Names that are references without a semicolon too, the longest first.
_BARE = "&(?:" + "|".join(sorted((n[1:] for n in _NAMED if n[-1] != ";"), key=len, reverse=True)) + ")"
_REFERENCE = "&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|" + _BARE
#: What the numbers 128 to 159 stand for.
_C1 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]
#: The value of the first href of a link, with its quotation marks if it has some; other attributes are passed over.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
_HREF = (rf"""(?is)<a[\s/]++(?:(?!href\s*=)[^\s>/][^\s=>/]*+(?:\s*+=\s*+{_VALUE})?+[\s/]*+)*+"""
         rf"""href\s*+=\s*+({_VALUE})""")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _numbered(reference: Column) -> Column:
    """The character of a numeric reference; U+FFFD for a number that is none."""
    digits = F.left(F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*)", 1), F.lit(9))
    number = F.when(digits == "", F.lit("0")).when(
        F.lower(F.substring(reference, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))

    def char(n: Column) -> Column:
        return (
            F.when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(n.between(128, 159), F.element_at(F.array(*map(F.lit, _C1)), (n - 127).cast("int")))
            .when(n == 160, F.lit(" "))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        )

    return F.transform(F.array(number.cast("long")), char)[0]


def _plain(text: Column, attribute: bool = False) -> Column:
    """Text with its character references decoded once. In attributes a name without a semicolon is a reference only
    where no letter, digit or equals sign follows."""
    pattern = _REFERENCE + ("(?![=A-Za-z0-9])" if attribute else "")
    named = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")

    def decoded(reference: Column) -> Column:
        bare = F.regexp_extract(reference, "^" + _BARE, 0)
        cut = F.concat(F.try_element_at(named, bare), F.substr(reference, F.length(bare) + 1))
        return F.when(F.startswith(reference, F.lit("&#")), _numbered(reference)).otherwise(
            F.coalesce(F.try_element_at(named, reference), *([] if attribute else [cut]), reference))

    def whole(x: Column) -> Column:
        parts = F.zip_with(F.split(x, pattern), F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda p, r: F.when(
            r.isNull(), p).otherwise(F.concat(p, decoded(r))))
        return F.when(F.contains(x, F.lit("&")), F.array_join(parts, "")).otherwise(x)

    return F.transform(F.array(text), whole)[0]


def plain_text(html: Column) -> Column:
    """Text of a page: one line per block element, a space around table cells, spaces and blank lines closed up."""
    silent = "|".join(_SILENT)
    text = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    text = F.regexp_replace(text, rf"(?is)<({silent})(?:\s[^>]*)?>.*?(?:</\1\s*>|\z)", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{_LINE})(?:[\s/][^>]*)?>", "\n")
    text = F.regexp_replace(text, rf"(?i)</?(?:{_CELL})(?:[\s/][^>]*)?>", " ")
    text = _plain(F.regexp_replace(text, r"</?[A-Za-z!?][^>]*>", ""))
    text = F.regexp_replace(text, r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]", " ")
    text = F.regexp_replace(text, r" \n[ \n]*|\n[ \n]+", "\n")
    return F.btrim(text, F.lit(" \n"))


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """Response records of pages (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n"),
    )
    return pages.select(
        F.col("page_id").alias("source_id"), _urn(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), head.alias("http_headers"),
        payload.alias("payload"), _digest(payload).alias("payload_digest"),
    )


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response record."""
    html = F.col("payload")
    links = F.transform(
        F.regexp_extract_all(html, F.lit(_HREF), 1),
        lambda x: F.regexp_replace(
            _plain(F.regexp_replace(x, r"""(?s)^(["'])(.*)\1$""", "$2"), attribute=True), r"[\r\n]+", ""))
    title = F.trim(F.regexp_replace(
        _plain(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)), r"[\s]+", " "))
    language = F.regexp_extract(html, r"""(?is)<html[^>]*\slang\s*=\s*["']?([A-Za-z-]+)""", 1)
    fields = F.concat(
        F.lit("title: "), title, F.lit("\r\nlanguage: "), language, F.lit("\r\nlinks: "),
        F.size(links).cast("string"), F.lit("\r\n"),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""),
    )
    made = F.explode(F.array(*(
        F.struct(F.lit(kind).alias("warc_type"), F.lit(mime).alias("content_type"), block.alias("block"))
        for kind, mime, block in (
            ("metadata", "application/warc-fields", fields), ("conversion", "text/plain", plain_text(html)))
    )))
    return records.select("*", made.alias("made")).select(
        "source_id", _urn(F.col("made.warc_type"), F.col("record_id")).alias("record_id"), "made.warc_type",
        F.col("record_id").alias("refers_to"), F.col("target_uri"), F.col("date").alias("refers_to_date"),
        "http_headers", "payload_digest", "made.content_type",
        F.octet_length("made.block").cast("long").alias("content_length"),
        _digest(F.col("made.block")).alias("block_digest"), "made.block",
    )


def serialized(derived: DataFrame) -> DataFrame:
    """Records as text in WARC format, keyed by record id."""
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def angle(value: Column) -> Column:
        return F.concat(F.lit("<"), value, F.lit(">"))

    source = F.regexp_replace("http_headers", r"\r\n(?!\z)", " | ")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", angle(F.col("record_id"))),
        line("WARC-Refers-To", angle(F.col("refers_to"))), line("WARC-Refers-To-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To-Date", F.col("refers_to_date")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("refers_to_date")), line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Payload-Digest-Source", F.col("payload_digest")),
        line("WARC-Source-Headers", F.regexp_replace(source, r"\r\n\z", "")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")),
    )
    return derived.select("record_id", F.concat(head, F.lit("\r\n"), "block", F.lit("\r\n\r\n")).alias("record"))
