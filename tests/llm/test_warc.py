"""Derived records: links to their response, digests and edge cases."""

import hashlib
from html import unescape
from html.entities import html5

from linkledger.llm import warc

PAGE = ('<html lang="fr"><head><title>A &amp;\n B</title><style>p{}</style></head><body><!-- no --><script>x</script>'
        '<p>one<br>two &lt;3</p><A class="k" HREF="/q?a=1&amp;b=2">link</A></body>')


def run(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block int, made string")
    response = warc.responses(pages)
    return response, warc.derive(response)


def test_records(spark):
    response, derived = run(spark, [(1, "http://a/", PAGE, 1, "x")])
    source = response.first()
    made = {r.warc_type: r for r in derived.collect()}
    assert made["conversion"].block == "one\ntwo <3\nlink"
    assert made["metadata"].block == "title: A & B\r\nlanguage: fr\r\nlinks: 1\r\noutlink: /q?a=1&b=2\r\n"
    for r in made.values():
        assert r.refers_to == source.record_id and r.http_headers == source.http_headers
        assert r.payload_digest == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode())
    text = {r.record_id: r.record for r in warc.serialized(derived).collect()}[made["conversion"].record_id]
    head, _, rest = text.partition("\r\n\r\n")
    assert f"WARC-Refers-To: <{source.record_id}>" in head and "Content-Length: 15" in head
    assert rest == "one\ntwo <3\nlink\r\n\r\n"


def test_edges(spark):
    rows = [(None, None, None, None, None), (2, "u", "", 0, ""), (3, "u", "plain " * 5000, 0, ""),
            (4, "u", "<script>never closed", 0, ""), (2, "u", "", 0, "")]
    _, derived = run(spark, rows)
    got = derived.filter("warc_type = 'conversion'").collect()
    assert sorted((r.source_id or 0, len(r.block)) for r in got) == [(0, 0), (2, 0), (2, 0), (3, 29999), (4, 0)]
    assert warc.serialized(derived).count() == 10
    assert "WARC-Target-URI" not in warc.serialized(derived.filter("source_id is null")).first().record
    assert run(spark, [])[1].count() == 0


def blocks(spark, html, kind):
    return [r.block for r in run(spark, [(1, "u", html, 0, "")])[1].filter(f"warc_type = '{kind}'").collect()]


def test_all_references(spark):
    names = sorted(html5) + ["notit;", "copy2020", "nosuch;", "amp;lt;", "#233;", "#x27;", "#X1F600;", "#0;", "#128;",
                             "#xD800;", "#1114112;", "#99999999999999999999;", "#00000000000065;", "#233", "#xe9", "#", "#x;"]
    got = blocks(spark, "|".join(f"x&{n}|" for n in names), "conversion")[0]
    assert got == " ".join("|".join(f"x{unescape(f'&{n}')}|" for n in names).replace("\xa0", " ").replace("\t", " ").split(
        " ")).replace("\r", " ")
    page = "<title>caf&eacute; &#x27;n&#39;</title><a href='?a=1&copy=2&amp;b=&uuml;&lt'>"
    assert blocks(spark, page, "metadata")[0] == (
        "title: caf\u00e9 'n'\r\nlanguage: \r\nlinks: 1\r\noutlink: ?a=1&copy=2&b=\u00fc<\r\n")


def test_cells_and_unquoted_links(spark):
    page = "<table><tr><td>a</td><td class=x>b</td><th>c</th></tr><TR><TD>d</TABLE><thead>e</thead>"
    assert blocks(spark, page, "conversion")[0].split("\n") == ["a b c", "d", "e"]
    links = ("<a href=/x>1</a><A class=k HREF = /y?a=1&amp;b=2 id=z>2</a><a title='no href=/n > 1' href=\"it's\">3</a>"
             "<a href>4</a><a data-href=/n>5</a><a x='y'href='/z'>6</a><abbr href=/n>7</abbr><a href=\"\">8</a>"
             "<a " + "b=c " * 20000 + "href=/long>9</a>")
    assert [x[9:] for x in blocks(spark, links, "metadata")[0].split("\r\n") if x[:9] == "outlink: "] == [
        "/x", "/y?a=1&b=2", "it's", "/z", "", "/long"]
