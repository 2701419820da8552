"""The operators' results as SQL for DuckDB, for those that SQL can express."""

from __future__ import annotations

#: Formatting is undone here by counting: what escapes add, and a header wherever a role begins.
OP6 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(role) + length(role) - length(replace(role, '\', ''))
      + length(role) - length(replace(role, ':', '')) + 6 AS header,
    length(text) + length(text) - length(replace(text, '\', ''))
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
      + len(regexp_extract_all(text, '</turn>')) + 8 AS body
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + CASE WHEN before IS NULL OR before <> role THEN header ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _decoded(text: str) -> str:
    for name, code in (("&nbsp;", 32), ("&lt;", 60), ("&gt;", 62), ("&quot;", 34), ("&#39;", 39), ("&apos;", 39),
                       ("&copy;", 169), ("&reg;", 174), ("&middot;", 183), ("&hellip;", 8230), ("&ndash;", 8211),
                       ("&mdash;", 8212), ("&amp;", 38)):
        text = f"replace({text}, '{name}', chr({code}))"
    return text


def _urn(parts: str) -> str:
    return (f"regexp_replace(md5({parts}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', "
            r"'urn:uuid:\1-\2-\3-\4-\5')")


def _without(text: str, pattern: str, put: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {put}, 'g')"


_TEXT = _without("html", r"(?s)<!--.*?(?:-->|\z)")
for _name in ("script", "style", "noscript", "template", "head"):
    _TEXT = _without(_TEXT, rf"(?is)<{_name}(?:\s[^>]*)?>.*?(?:</{_name}\s*>|\z)", "' '")
_TEXT = _without(
    _TEXT, r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|h1|h2|h3|h4|h5|h6|article|section|header|footer|nav|"
    r"aside|main|blockquote|pre|form)(?:[\s/][^>]*)?>", "chr(10)")
_TEXT = _decoded(_without(_TEXT, r"</?[A-Za-z!?][^>]*>"))
_TEXT = _without(_without(_TEXT, r"[ \t\r\f\x0B]+", "' '"), r" ?\n[ \n]*", "chr(10)")
_TEXT = _without(_TEXT, r"^[ \n]+|[ \n]+\z")

OP1 = rf"""
WITH response AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    {_urn("'response' || chr(10) || coalesce(page_id::VARCHAR, '-') || chr(10) || coalesce(url, '-')")} AS rid
  FROM pages
), parts AS (
  SELECT *,
    list_transform(
      regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"''>]*)["'']', 1),
      lambda x: regexp_replace({_decoded("x")}, '[\r\n]+', '', 'g')) AS links,
    trim(regexp_replace({_decoded(r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")}, '\s+', ' ', 'g')) AS title,
    regexp_extract(html, '(?is)<html[^>]*\slang\s*=\s*["'']?([A-Za-z-]+)', 1) AS language
  FROM response
), blocks AS (
  SELECT page_id, url, html, rid, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    'title: ' || title || chr(13) || chr(10) || 'language: ' || language || chr(13) || chr(10)
      || 'links: ' || len(links) || chr(13) || chr(10)
      || array_to_string(list_transform(links, lambda x: 'outlink: ' || x || chr(13) || chr(10)), '') AS block
  FROM parts
  UNION ALL
  SELECT page_id, url, html, rid, 'conversion', 'text/plain', {_TEXT} FROM parts
)
SELECT page_id AS source_id, {_urn("warc_type || chr(10) || rid")} AS record_id, warc_type, rid AS refers_to,
  url AS target_uri, '1970-01-01T00:00:00Z' AS refers_to_date,
  'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) AS http_headers,
  'sha256:' || sha256(html) AS payload_digest, content_type, strlen(block)::BIGINT AS content_length,
  'sha256:' || sha256(block) AS block_digest, block
FROM blocks
"""

#: A full comparison.
OP4 = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed value: the polynomial of crc32, reversed. ``crc32(x)`` of a text's UTF-8 bytes, as a table over distinct texts.
_CRC_TABLE = """
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))"""


def _crc(text: str) -> str:
    """crc32 of a text column, with ``t`` in scope."""
    hexed = f"hex(encode({text}))"
    byte = f"(strpos('0123456789ABCDEF', substr({hexed}, CAST(2 * k + 1 AS BIGINT), 1)) - 1) * 16 + " \
           f"strpos('0123456789ABCDEF', substr({hexed}, CAST(2 * k + 2 AS BIGINT), 1)) - 1"
    return (f"xor(list_reduce([4294967295] || list_transform(range(CAST(length({hexed}) // 2 AS BIGINT)), lambda k: {byte}), "
            "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)")


def _words(table: str, column: str) -> str:
    return (f"SELECT {column}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), "
            f"'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {table}")


OP11 = f"""
WITH crc AS ({_CRC_TABLE}),
own AS MATERIALIZED ({_words('documents', 'doc_id')}),
wanted AS MATERIALIZED ({_words('benchmark', 'item_id')}),
names AS (SELECT DISTINCT w FROM (SELECT w FROM own UNION ALL SELECT w FROM wanted)),
buckets AS MATERIALIZED (SELECT w, {_crc('w')} % 10000 AS b FROM names, crc),
s AS (SELECT b, count(*) AS n FROM own JOIN buckets USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM wanted JOIN buckets USING (w) GROUP BY b),
sums AS (SELECT (SELECT count(*) FROM own) AS s, (SELECT count(*) FROM wanted) AS t),
gains AS (
    SELECT b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * (sums.s + 10000)::DOUBLE
                                   / ((coalesce(s.n, 0) + 1) * (sums.t + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s FULL JOIN t USING (b), sums),
per AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM own JOIN buckets USING (w) JOIN gains USING (b) GROUP BY doc_id),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM documents LEFT JOIN per USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n AS n_features, weight, score,
       CASE WHEN n >= 20 AND place <= (SELECT count(*) FROM scored WHERE n >= 20) * 10 // 100 THEN place END AS rank
FROM ranked
"""

#: Letters beyond ASCII as one byte each, as DuckDB's distance counts bytes.
_BEYOND = "".join(map(chr, range(0xC0, 0x100)))
_AS_BYTES = "".join(map(chr, range(33, 97))).replace("'", "''")

OP13 = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS MATERIALIZED (
    SELECT doc_id, translate(run, '{_UPPER}', '{_SMALL}') AS run, count(*) AS uses
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, uses, {_crc("doc_id || ':' || run")} AS h FROM runs, crc),
words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
                ELSE run END AS word, uses FROM hashed),
vocabulary AS MATERIALIZED (
    SELECT word, CAST(sum(uses) AS BIGINT) AS n, translate(word, '{_BEYOND}', '{_AS_BYTES}') AS bytes
    FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(uses) >= 5),
pairs AS (
    SELECT a.word AS word, b.word AS near, b.n AS near_n FROM vocabulary a JOIN vocabulary b ON left(a.bytes, 3) = left(b.bytes, 3)
    WHERE abs(length(a.bytes) - length(b.bytes)) <= 1 AND levenshtein(a.bytes, b.bytes) = 1
    UNION
    SELECT a.word, b.word, b.n FROM vocabulary a JOIN vocabulary b ON right(a.bytes, 3) = right(b.bytes, 3)
    WHERE abs(length(a.bytes) - length(b.bytes)) <= 1 AND levenshtein(a.bytes, b.bytes) = 1),
best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, encode(near))) AS near FROM pairs GROUP BY word),
formed AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN near END AS form,
           CASE WHEN most >= 5 * n THEN most END AS form_n
    FROM vocabulary LEFT JOIN best USING (word)),
chains AS (
    SELECT word, word AS reached, 0 AS steps FROM formed
    UNION ALL
    SELECT c.word, f.form, steps + 1 FROM chains c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(reached, steps) AS root FROM chains GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
"""
