"""WARC derivatives: metadata and plain-text conversion records.

A response record (the fetched page with its HTTP head) gives two linked
records: ``metadata`` (application/warc-fields: the response's status, header
fields and digests, title, language, links) and ``conversion`` (text/plain).
Both name the response in WARC-Refers-To, repeat its target, date, payload
digest, block digest and content type, and have digests of their own. Record
ids are derived from the source record, so a rerun gives the same files.

A page is read in a worker: hidden elements and comments go first (each up to
its own closing tag), block elements end lines, other tags go, then character
references are decoded (all names of HTML 5 that a semicolon ends, decimal and
hexadecimal numbers). A tag begins with a letter, "/", "!" or "?" after the
"<"; any other "<" is text. No shuffle, and whole pages are read.

Defined cases: a null page counts as an empty payload; a null url leaves
WARC-Target-URI out; a hidden element that is never closed is a tag like
others, and its content is text; a reference without a semicolon, or with an
unknown name, stays; a number that is no character becomes U+FFFD; rows that
repeat give records that repeat (with the same ids); an empty table gives no
records. Other columns are not read.
"""

from __future__ import annotations

import re
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import map_arrow

CRLF = "\r\n"

#: Elements without text, and elements that end a line.
HIDDEN = ["script", "style", "noscript", "template", "head"]
BREAKS = ["address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol",
          "p", "pre", "section", "table", "td", "th", "tr", "ul"]
#: Named references, and what the numbers 128 to 159 stand for.
NAMED = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
WINDOWS = [bytes([n]).decode("cp1252", "replace") for n in range(128, 160)]

#: Regular expressions (ASCII classes, alike in both engines) and what
#: replaces them, in order.
SPACE = r"[ \t\n\r\f]"
TEXT_RULES = [
    (r"(?is)<!--.*?-->|" + "|".join(rf"<{x}(?:[ \t\n\r\f/][^>]*)?>.*?</{x}{SPACE}*>" for x in HIDDEN), ""),
    (rf"(?i)</?(?:{'|'.join(BREAKS)})(?:[ \t\n\r\f/][^>]*)?>", "\n"),
    (r"<[A-Za-z/!?][^>]*>", ""),
]
SPACE_RULES = [("\u00a0", " "), (r"[ \t\r\f]{2,}|[\t\r\f]", " "), (r" ?\n[ \n]+| \n", "\n")]
TITLE = rf"(?is)<title(?:{SPACE}[^>]*)?>(.*?)</title"
LANGUAGE = rf"""(?i)<html[^>]*{SPACE}lang=["']?([a-z][a-z0-9-]*)"""
LINK = rf"""(?i)<a{SPACE}(?:[^>]*?{SPACE})?href{SPACE}*={SPACE}*("[^"]*"|'[^']*'|[^ \t\n\r\f"'>]+)"""
REFERENCE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

_RULES = [(re.compile(p, re.ASCII), to) for p, to in TEXT_RULES]
_TITLE, _LANGUAGE, _LINK, _REFERENCE = (re.compile(p, re.ASCII) for p in (TITLE, LANGUAGE, LINK, REFERENCE))


def _character(m: re.Match) -> str:
    name = m[1]
    if name[0] != "#":
        return NAMED.get(name, m[0])
    digits, base = (name[2:], 16) if name[1] in "xX" else (name[1:], 10)
    digits = digits.lstrip("0")
    n = int(digits, base) if 0 < len(digits) <= 7 else 0
    if not 0 < n <= 0x10FFFF or 0xD800 <= n <= 0xDFFF:
        return "�"
    return WINDOWS[n - 128] if 128 <= n <= 159 else chr(n)


def decoded(text: str) -> str:
    """``text`` with its character references as characters."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _tidy(text: str) -> str:
    """What ``SPACE_RULES`` do, without a pass for each blank."""
    for c in "\u00a0\t\r\f":
        text = text.replace(c, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    text = text.replace(" \n", "\n").replace("\n ", "\n")
    while "\n\n" in text:
        text = text.replace("\n\n", "\n")
    return text.strip(" \n")


def plain_text(html: str) -> str:
    """The text of a page, one line for each block."""
    for rule, to in _RULES:
        html = rule.sub(to, html)
    return _tidy(decoded(html))


def outlinks(html: str) -> list[str]:
    """The targets of the page's links, decoded, in their order."""
    found = (decoded(x[1:-1] if x[0] in "\"'" else x) for x in _LINK.findall(html))
    return [y for x in found if (y := re.sub(r"[\t\n\r\f]", "", x).strip(" "))]


def metadata(html: str, http_head: str, payload_digest: str, block_digest: str) -> str:
    """The metadata block of a response, as warc-fields."""
    status, *fields = http_head.strip(CRLF).split(CRLF)
    title, language = _TITLE.search(html), _LANGUAGE.search(html)
    lines = [("http-status", status), *(("http-header", f) for f in fields), ("sourcePayloadDigest", payload_digest),
             ("sourceBlockDigest", block_digest),
             ("title", re.sub("[ \t\n\r\f]+", " ", decoded(title[1])).strip(" ") if title else ""),
             ("languageOfContent", language[1].lower() if language else ""),
             ("contentLength", len(html.encode())), *(("outlink", x) for x in outlinks(html))]
    return "".join(f"{name}: {value}{CRLF}" for name, value in lines)


def _digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def _record_id(*parts: Column) -> Column:
    """A name-based id (version 8 of RFC 9562) in URN form."""
    h = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"),
                    F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
                    F.lit(">"))


MEDIA = "text/html; charset=utf-8"


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Response records: ``(page_id, record_id, target_uri, warc_date,
    http_head, payload, payload_digest, block_digest)``."""
    payload = F.coalesce(pages[html_col], F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: {MEDIA}{CRLF}Content-Length: "),
                    F.octet_length(payload).cast("string"), F.lit(CRLF + CRLF))
    out = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("target_uri"),
                       payload.alias("payload"), head.alias("http_head"), F.lit(date).alias("warc_date"))
    out = out.withColumn("payload_digest", _digest(F.col("payload")))
    return out.select(
        "page_id", _record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                              F.coalesce("target_uri", F.lit("")), F.col("payload_digest")).alias("record_id"),
        "target_uri", "warc_date", "http_head", "payload", "payload_digest",
        _digest(F.concat("http_head", "payload")).alias("block_digest"))


def _head(kind: Column, record_id: Column, media: Column, block: Column) -> Column:
    """The WARC head of a derived record, with what the source record says."""
    target = F.col("target_uri")
    uri = F.when(target.isNull(), F.lit("")).otherwise(F.concat(F.lit("WARC-Target-URI: "), target, F.lit(CRLF)))
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", F.col("refers_to")),
             ("WARC-Date", F.col("warc_date")), ("WARC-Refers-To-Date", F.col("warc_date")),
             ("WARC-Refers-To-Block-Digest", F.col("source_digest")),
             ("WARC-Refers-To-Content-Type", F.col("source_type")),
             ("WARC-Payload-Digest", F.col("payload_digest")), ("WARC-Block-Digest", F.col("block_digest")),
             ("Content-Type", media), ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), uri,
                    *(x for name, value in lines for x in (F.lit(f"{name}: "), value, F.lit(CRLF))), F.lit(CRLF))


def derive(source: DataFrame) -> DataFrame:
    """Two records for each response: ``(page_id, warc_type, record_id,
    refers_to, target_uri, content_type, payload_digest, source_digest,
    block_digest, content_length, head, block)``; ``source_digest`` is the
    response's block digest."""
    carried = ["page_id", "record_id", "target_uri", "warc_date", "payload_digest", "block_digest"]
    rows = source.select(*carried, "http_head", "payload")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                held = [part.column(c).to_pylist() for c in ("payload", "http_head", "payload_digest", "block_digest")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried),
                     pa.array([m[1] if (m := _MEDIA.search(h)) else "" for h in held[1]], pa.string()),
                     pa.array([metadata(*x) for x in zip(*held, strict=True)], pa.string()),
                     pa.array([plain_text(x) for x in held[0]], pa.string())],
                    names=[*carried, "source_type", "fields", "text"])

    rows = map_arrow(rows, run, f"page_id {kind}, record_id string, target_uri string, warc_date string, "
                                "payload_digest string, block_digest string, source_type string, fields string, text string")
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                 F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("text").alias("block")))
    rows = rows.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "payload_digest",
                       F.col("block_digest").alias("source_digest"), "source_type", F.inline(kinds))
    rows = rows.withColumn("record_id", _record_id(F.col("warc_type"), F.col("refers_to"))).withColumn(
        "block_digest", _digest(F.col("block")))
    head = _head(F.col("warc_type"), F.col("record_id"), F.col("content_type"), F.col("block"))
    return rows.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "payload_digest",
                       "source_digest", "block_digest", F.octet_length("block").cast("long").alias("content_length"),
                       head.alias("head"), "block")


_MEDIA = re.compile(r"(?im)^content-type:[ \t]*([^\r\n]*)", re.ASCII)


def record_bytes(records: DataFrame) -> DataFrame:
    """``records`` plus ``record``: head, block and closing lines as a WARC
    file holds them."""
    return records.withColumn("record", F.encode(F.concat("head", "block", F.lit(CRLF + CRLF)), "utf-8"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def derive_sql(date: str) -> str:
    """The same records in one statement for a second engine."""
    def apply(expr: str, rules) -> str:
        for pattern, to in rules:
            expr = f"regexp_replace({expr}, {_q(pattern)}, {_q(to)}, 'g')"
        return expr

    def uuid(expr: str) -> str:
        return (f"(SELECT '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-8' || h[14:16] || '-a' || h[18:20] || '-' "
                f"|| h[21:32] || '>' FROM (SELECT md5({expr}) AS h))")

    def decode(expr: str) -> str:
        # Split at "&"; each part begins with a reference or not.
        name = f"regexp_extract(x, '^({REFERENCE[2:-2]});', 1)"
        n = f"TRY_CAST(CASE WHEN lower(x[2]) = 'x' THEN '0x' || {name}[3:] ELSE {name}[2:] END AS BIGINT)"
        char = (f"CASE WHEN x[1] <> '#' THEN names[{name}] WHEN coalesce({n}, 0) NOT BETWEEN 1 AND 1114111 "
                f"OR {n} BETWEEN 55296 AND 57343 THEN chr(65533) WHEN {n} BETWEEN 128 AND 159 THEN windows[{n} - 127] "
                f"ELSE chr(CAST({n} AS INTEGER)) END")
        part = (f"CASE WHEN i = 1 THEN x WHEN {name} = '' OR (x[1] <> '#' AND names[{name}] IS NULL) THEN '&' || x "
                f"ELSE ({char}) || substr(x, length({name}) + 2) END")
        return f"array_to_string(list_transform(string_split({expr}, '&'), lambda x, i: {part}), '')"

    text = f"trim({apply(decode(apply('payload', TEXT_RULES)), SPACE_RULES)}, ' ' || chr(10))"
    title = f"trim({apply(decode(f'regexp_extract(payload, {_q(TITLE)}, 1)'), [('[ \t\n\r\f]+', ' ')])}, ' ')"
    bare = "CASE WHEN y[1] IN ('\"', '''') THEN y[2:-2] ELSE y END"
    links = f"list_transform(regexp_extract_all(payload, {_q(LINK)}, 1), lambda y: {bare})"
    links = f"list_transform({links}, lambda z: trim(regexp_replace({decode('z')}, '[\t\n\r\f]', '', 'g'), ' '))"
    crlf, lf = "chr(13) || chr(10)", "chr(10)"
    names = ", ".join(f"{_q(k)}: {_q(v)}" for k, v in sorted(NAMED.items()))
    windows = ", ".join(_q(c) for c in WINDOWS)
    return f"""
WITH tables AS (SELECT MAP {{{names}}} AS names, [{windows}] AS windows),
src AS (
  SELECT page_id, url AS target_uri, coalesce(html, '') AS payload,
         'sha256:' || sha256(coalesce(html, '')) AS payload_digest,
         'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: {MEDIA}' || {crlf} || 'Content-Length: '
           || strlen(coalesce(html, '')) || {crlf} || {crlf} AS http_head
  FROM pages),
res AS (
  SELECT *, 'sha256:' || sha256(http_head || payload) AS source_digest,
         {uuid(f"'response' || {lf} || coalesce(CAST(page_id AS VARCHAR), '') || {lf} || coalesce(target_uri, '') "
               f"|| {lf} || payload_digest")} AS refers_to
  FROM src),
parts AS (
  SELECT page_id, target_uri, payload_digest, source_digest, refers_to, 'metadata' AS warc_type,
         'application/warc-fields' AS content_type,
         'http-status: HTTP/1.1 200 OK' || {crlf} || 'http-header: Content-Type: {MEDIA}' || {crlf}
         || 'http-header: Content-Length: ' || strlen(payload) || {crlf}
         || 'sourcePayloadDigest: ' || payload_digest || {crlf} || 'sourceBlockDigest: ' || source_digest || {crlf}
         || 'title: ' || {title} || {crlf} || 'languageOfContent: ' || lower(regexp_extract(payload, {_q(LANGUAGE)}, 1))
         || {crlf} || 'contentLength: ' || strlen(payload) || {crlf}
         || coalesce(array_to_string(list_transform(list_filter({links}, lambda w: w <> ''),
                                                    lambda w: 'outlink: ' || w || {crlf}), ''), '') AS block
  FROM res, tables
  UNION ALL
  SELECT page_id, target_uri, payload_digest, source_digest, refers_to, 'conversion', 'text/plain; charset=utf-8', {text}
  FROM res, tables),
ids AS (
  SELECT *, {uuid(f"warc_type || {lf} || refers_to")} AS record_id, 'sha256:' || sha256(block) AS block_digest
  FROM parts)
SELECT page_id, warc_type, record_id, refers_to, target_uri, content_type, payload_digest, source_digest, block_digest,
       CAST(strlen(block) AS BIGINT) AS content_length,
       sha256('WARC/1.1' || {crlf} || coalesce('WARC-Target-URI: ' || target_uri || {crlf}, '')
              || 'WARC-Type: ' || warc_type || {crlf} || 'WARC-Record-ID: ' || record_id || {crlf}
              || 'WARC-Refers-To: ' || refers_to || {crlf} || 'WARC-Date: {date}' || {crlf}
              || 'WARC-Refers-To-Date: {date}' || {crlf}
              || 'WARC-Refers-To-Block-Digest: ' || source_digest || {crlf}
              || 'WARC-Refers-To-Content-Type: {MEDIA}' || {crlf} || 'WARC-Payload-Digest: ' || payload_digest || {crlf}
              || 'WARC-Block-Digest: ' || block_digest || {crlf} || 'Content-Type: ' || content_type || {crlf}
              || 'Content-Length: ' || strlen(block) || {crlf} || {crlf}) AS head_sha256
FROM ids"""
