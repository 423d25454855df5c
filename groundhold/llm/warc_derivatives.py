"""WARC derivatives: metadata and plain-text conversion records that refer to their response records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CRLF = "\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
# Elements whose contents are no text, and elements that end a line.
HIDDEN = "script|style|noscript|template|svg|iframe|textarea|select|title"
BLOCKS = (
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul"
).split()

TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.I | re.S)
LANGUAGE = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
META_CHARSET = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", re.I)
UNSEEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({HIDDEN})\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)", re.I | re.S)
TAG = re.compile(r"<(/?)([A-Za-z!?][^\s/>\"']*)(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+>", re.S)
_BLOCKS = frozenset(BLOCKS)

RESPONSE_SCHEMA = (
    "id long, record_id string, target_uri string, date string, content_type string, block binary, "
    "block_digest string, payload_digest string"
)
DERIVED_SCHEMA = (
    "id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, block_digest string, payload_digest string, source_payload_digest string, "
    "content_length long, n_links long, record string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(map(str, parts)))}>"


def one_line(value: object) -> str:
    """A header's value; line ends would end the header."""
    return re.sub(r"[\r\n]+", " ", str(value)).strip()


def record_text(headers: list[tuple[str, object]], block: str) -> str:
    """A record without the two line ends that close it; headers without a value are left out."""
    lines = [VERSION, *(f"{name}: {one_line(value)}" for name, value in headers if value is not None)]
    return CRLF.join(lines) + CRLF + CRLF + block


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of stored pages, as a crawler would have written them at ``date``.

    A null page is an empty body, a null address gives no target. Rows that repeat all three values give equal records.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for page, url, text in rows.itertuples(index=False):
                page, body = None if pd.isna(page) else int(page), b"" if text is None else text.encode()
                head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(body)}{CRLF}{CRLF}"
                block = head.encode() + body
                own = record_id("response", page, url, digest(block))
                kind = "application/http; msgtype=response"
                out.append((page, own, url, date, kind, block, digest(block), digest(body)))
            columns = [x.split(" ")[0] for x in RESPONSE_SCHEMA.split(", ")]
            yield pd.DataFrame(out, columns=columns).astype({"id": "Int64"})

    slim = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return slim.mapInPandas(build, RESPONSE_SCHEMA)


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status, headers, body as it was before transfer and content coding); broken codings leave the body as it is."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split(CRLF)
    headers = [(n.strip(), v.strip()) for n, mark, v in (line.partition(":") for line in lines) if mark]
    named = {n.lower(): v.lower() for n, v in headers}
    if "chunked" in named.get("transfer-encoding", ""):
        body = _unchunked(body)
    try:
        if named.get("content-encoding") in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif named.get("content-encoding") == "deflate":
            body = zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass
    parts = first.split(" ")
    return parts[1] if len(parts) > 1 else "", headers, body


def _unchunked(body: bytes) -> bytes:
    out, rest = [], body
    while True:
        size, mark, rest = rest.partition(b"\r\n")
        try:
            n = int(size.split(b";")[0], 16)
        except ValueError:
            return b"".join(out) if out else body
        if not n or not mark:
            return b"".join(out)
        out.append(rest[:n])
        rest = rest[n + 2 :]


def decoded(headers: list[tuple[str, str]], body: bytes) -> tuple[str, str]:
    """(text, charset): by the header, else the page's own declaration, else UTF-8; bad bytes are replaced."""
    kind = next((v for n, v in headers if n.lower() == "content-type"), "")
    found = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", kind, re.I)
    own = META_CHARSET.search(body[:4096])
    charset = found[1] if found else own[1].decode() if own else "utf-8"
    try:
        return body.decode(charset, "replace"), charset.lower()
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace"), "utf-8"


def plain_text(page: str) -> str:
    """The page's text: hidden elements and comments go, block elements end lines, entities are resolved."""
    seen = UNSEEN.sub(" ", page)
    seen = re.sub(r"\s+", " ", seen)
    seen = TAG.sub(lambda m: "\n" if m[2].lower() in _BLOCKS else "", seen)
    lines = (" ".join(line.split()) for line in html.unescape(seen).replace("\r", "\n").split("\n"))
    return "\n".join(line for line in lines if line)


def derive(records: DataFrame) -> DataFrame:
    """Two rows per response: a metadata and a conversion record, with the record's text in ``record``.

    ``records`` has the columns that ``responses`` returns. Both derivatives refer to the response, its address and its
    date and carry its payload digest. The metadata block (warc-fields) holds the status, the source's headers, its block
    and payload digests, title, language, charset and links, and names the conversion; the conversion's block is the plain
    text. Ids follow from the response's id and the blocks, so a rerun gives the same ones.

    An empty or null block gives a conversion with an empty text. Null ids, addresses and dates stay null and their headers
    are left out. An empty table gives no rows; other columns are ignored.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [x.split(" ")[0] for x in DERIVED_SCHEMA.split(", ")]
        for rows in batches:
            out = []
            for r in rows.astype(object).where(rows.notna(), None).itertuples(index=False):
                block = bytes(r.block or b"")
                status, headers, body = parse_http(block)
                page, charset = decoded(headers, body)
                text = plain_text(page)
                links = [html.unescape(next(filter(None, m.groups()), "")) for m in LINK.finditer(page)]
                title, language = TITLE.search(page), LANGUAGE.search(page)
                own = record_id("conversion", r.record_id, digest(text.encode()))
                fields = [
                    ("http-status", status or None),
                    *(("source-header", f"{n}: {v}") for n, v in headers),
                    ("source-block-digest", r.block_digest), ("source-payload-digest", r.payload_digest),
                    ("charset", charset), ("language", language and language[1]),
                    ("title", title and " ".join(html.unescape(title[1]).split())), ("conversion", own),
                    *(("outlink", link) for link in links),
                ]
                facts = "".join(f"{n}: {one_line(v)}{CRLF}" for n, v in fields if v is not None)
                about = record_id("metadata", r.record_id, digest(facts.encode()))
                for kind, name, mime, content, n in (
                    ("metadata", about, "application/warc-fields", facts, len(links)),
                    ("conversion", own, "text/plain; charset=utf-8", text, 0),
                ):
                    raw = content.encode()
                    top = [
                        ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", r.date),
                        ("WARC-Target-URI", r.target_uri), ("WARC-Refers-To", r.record_id),
                        ("WARC-Refers-To-Target-URI", r.target_uri), ("WARC-Refers-To-Date", r.date),
                        ("WARC-Block-Digest", digest(raw)), ("WARC-Payload-Digest", digest(raw)),
                        ("WARC-Source-Payload-Digest", r.payload_digest),
                        ("Content-Type", mime), ("Content-Length", len(raw)),
                    ]
                    out.append((
                        None if r.id is None else int(r.id), kind, name, r.record_id, r.target_uri, r.date, mime, digest(raw),
                        digest(raw), r.payload_digest, len(raw), n, record_text(top, content),
                    ))
            yield pd.DataFrame(out, columns=columns).astype({"id": "Int64"})

    columns = [x.split(" ")[0] for x in RESPONSE_SCHEMA.split(", ")]
    return records.select(*columns).mapInPandas(build, DERIVED_SCHEMA)


def write_records(derived: DataFrame, path: str) -> None:
    """Writes the records as WARC files, one per task: the text writer's line end is the close of a record."""
    derived.select("record").write.option("lineSep", CRLF + CRLF).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record; a block ends where Content-Length says."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode().split(CRLF)[1:]
        headers = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
        low = end + 4
        high = low + int(headers["content-length"])
        yield headers, data[low:high]
        at = high + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """headers (map) and block (binary) of every record in the WARC files of a folder; a task reads whole files."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for content in rows["content"]:
                yield pd.DataFrame(list(parse_records(bytes(content))), columns=["headers", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, "headers map<string,string>, block binary")
