"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response gives two records that name it in WARC-Refers-To and each other in
WARC-Concurrent-To.  Both keep the source's target URI and date
(WARC-Refers-To-Target-URI, WARC-Refers-To-Date), and, under the same names with a
leading ``Source-``, its payload and block digests, IP address and record headers that
the derivative would otherwise lose.  The metadata record lists the HTTP status and
headers, the title and the outgoing links; the conversion record is the page's visible
text, or another text (text/*, JSON, XML) as it is.  Bodies are put together from chunks and unpacked (gzip, deflate) first, the
digests stay those of the source; a body that only claims to be packed is taken as it is, and bytes behind the end of a packed one are left out.  The charset is that of
a byte order mark, else of the header, else of a meta element in the first 4,096 bytes, else UTF-8; bytes that it doesn't have become U+FFFD.  Identifiers are version-5 UUIDs of the source's identifier and the record type, so
a task that runs again makes the same records.

A record that is no response, or not well formed, or whose payload is no text (a PDF, an image, an unknown packing) or unpacks to more than MOST_UNPACKED bytes, gives no derivative but a row with its
error.  Nulls: a null record gives an error row; a page with null url or html becomes a
response with an empty target URI or payload.  Repeated rows are one record given more than once: equal in all bytes, the identifier too.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import tidy
from tessera.llm.sitetree import host_of, walk
from tessera.llm.words import slices

VERSION = "WARC/1.1"
HREF = re.compile(r"(?<![\w-])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Media types with text, and those of it that are pages.
PAGES = frozenset(["text/html", "application/xhtml+xml"])
TEXTS = re.compile(r"text/.+|application/(?:xml|json|javascript|x-ndjson|.+\+(?:xml|json))")
CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:\-]+)", re.I)
META = re.compile(rb"<meta[^>]*?charset\s*=\s*[\"']?\s*([\w.:\-]+)", re.I)
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
#: Names under which pages are, by the usage of browsers, in another charset.
MEANT = {"iso-8859-1": "cp1252", "iso8859-1": "cp1252", "latin1": "cp1252", "latin-1": "cp1252", "us-ascii": "cp1252", "ascii": "cp1252", "x-sjis": "shift_jis", "gb2312": "gb18030"}
#: A payload that unpacks to more bytes is an error: a small record can claim any size.
MOST_UNPACKED = 64 << 20
#: Bytes of records that are worked on at once.
RECORD_BYTES = 4 << 20
CARRIED = ("WARC-Payload-Digest", "WARC-Block-Digest", "WARC-IP-Address", "WARC-Identified-Payload-Type")


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(headers.get("content-length", "-1"))
    if not 0 <= n <= len(rest):
        raise ValueError("the block is shorter than Content-Length")
    return headers, rest[:n]


def _line(value: str) -> str:
    return " ".join(value.split())


def response(page_id: int | None, url: str | None, source: str | None, date: str) -> bytes:
    """A response record for a stored page."""
    payload = (source or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest(payload)}")
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", _line(url or "")), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")]
    return record(headers, block)


def derive(raw: bytes) -> dict[str, object]:
    """The two derivatives of a response record and what links them to it."""
    headers, block = parse(raw)
    if headers.get("warc-type") != "response":
        raise ValueError("no response record")
    source_id, uri, date = headers.get("warc-record-id", ""), headers.get("warc-target-uri", ""), headers.get("warc-date", "")
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("iso-8859-1").split("\r\n")
    named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http)}
    body, kind = unpacked(payload, named), named.get("content-type", "")
    media = kind.partition(";")[0].strip().lower() or ("application/octet-stream" if b"\0" in body[:1024] or body.startswith(b"%PDF-") else "text/html")
    if not TEXTS.fullmatch(media):
        raise ValueError(f"no text in {media}")
    page = decoded(body, kind, media in PAGES)
    titles, hrefs = [], []

    def note(tag: str, told: str) -> None:
        if tag == "title":
            titles.append(told)
        elif m := HREF.search(told):
            hrefs.append(m[1] or m[2] or m[3] or "")

    text = ("\n".join(t for t, *_ in walk(page, host_of(uri), note=note)[0]) if media in PAGES else page).encode()
    title = titles[0] if titles else ""
    links = list(dict.fromkeys(urljoin_safe(uri, html.unescape(x)) for x in hrefs))
    ids = {t: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source_id} {t}')}>" for t in ("metadata", "conversion")}
    fields = [("source-status", status), *(("source-header", x) for x in http), ("title", html.unescape(title)), *(("outlink", x) for x in links)]
    body = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode()
    kept = [(f"Source-{n}", headers[n.lower()]) for n in CARRIED if n.lower() in headers]
    out: dict[str, object] = {"source_id": source_id, "source_digest": headers.get("warc-payload-digest", digest(payload)), "n_outlinks": len(links), "n_chars": len(text.decode())}
    for name, content, block in (("metadata", "application/warc-fields", body), ("conversion", "text/plain; charset=utf-8", text)):
        other = ids["conversion" if name == "metadata" else "metadata"]
        own = [("WARC-Type", name), ("WARC-Record-ID", ids[name]), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source_id), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Concurrent-To", other), *kept, ("WARC-Block-Digest", digest(block)), ("Content-Type", content)]
        out |= {f"{name}_id": ids[name], f"{name}_digest": digest(block), name: record(own, block)}
    return out


def decoded(body: bytes, kind: str, is_page: bool = True) -> str:
    """The text of a body; kind: its Content-Type.  An unknown charset is UTF-8."""
    for mark, name in MARKS:
        if body.startswith(mark):
            return body[len(mark) :].decode(name, "replace")
    told = CHARSET.search(kind)
    said = META.search(body[:4096]) if is_page and not told else None
    name = told[1].lower() if told else said[1].decode("ascii", "replace").lower() if said else "utf-8"
    if said and name.startswith("utf-16"):  # what could be read as ASCII isn't
        name = "utf-8"
    try:
        return body.decode(MEANT.get(name, name), "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


def joined(payload: bytes) -> bytes:
    """The chunks of a payload put together; a payload that doesn't begin with a chunk's size, as it is."""
    if not re.match(rb"[0-9A-Fa-f]+[ \t]*(?:;[^\r\n]*)?\r\n", payload):
        return payload
    parts, at = [], 0
    while True:
        end = payload.find(b"\r\n", at)
        try:
            size = int(payload[at:end].partition(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size > len(payload):
            raise ValueError("a chunk is not whole")
        if not size:
            return b"".join(parts)
        parts.append(payload[end + 2 : end + 2 + size])
        at = end + 4 + size


def inflated(payload: bytes, packing: str, most: int) -> bytes:
    """The members of a gzip body, or a deflate body; no more than most bytes are ever unpacked."""
    zipped = packing != "deflate"
    if zipped and not payload.startswith(b"\x1f\x8b"):
        return payload
    parts, left = [], most
    while True:
        engine = zlib.decompressobj(zlib.MAX_WBITS | 16 if zipped else zlib.MAX_WBITS if payload[:1] == b"x" else -zlib.MAX_WBITS)
        parts.append(engine.decompress(payload, left + 1))
        left -= len(parts[-1])
        if left < 0:
            raise ValueError(f"the body unpacks to more than {most} bytes")
        if not engine.eof:
            raise ValueError(f"the {packing} body is not whole")
        payload = engine.unused_data
        if not zipped or not payload.startswith(b"\x1f\x8b\x08"):
            return b"".join(parts)


def unpacked(payload: bytes, http: dict[str, str], most: int = MOST_UNPACKED) -> bytes:
    """The body of a payload: its chunks put together, its packing undone.  http: headers, names in lower case."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        payload = joined(payload)
    for packing in reversed([x.strip().lower() for x in http.get("content-encoding", "").split(",")]):
        if packing in ("gzip", "x-gzip", "deflate"):
            try:
                payload = inflated(payload, packing, most)
            except zlib.error as e:
                raise ValueError(f"the {packing} body is not whole") from e
        elif packing not in ("", "identity"):
            raise ValueError(f"unknown packing {packing}")
    return payload


def urljoin_safe(base: str, link: str) -> str:
    try:
        return urljoin(base, link.strip())
    except ValueError:
        return link.strip()


FIELDS = "source_id string, source_digest string, n_outlinks long, n_chars long, metadata_id string, metadata_digest string, metadata binary, conversion_id string, conversion_digest string, conversion binary, error string"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """page_id, url and a WARC response record of every page."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                raw = [response(*x, date) for x in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], names=["page_id", "url", "record"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(tidy(task), "page_id long, url string, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """The columns of records but its record, then the derivatives and their links; columns with these names give way."""
    keys = [c for c in records.columns if c != "record" and c not in NAMES]
    kept = records.select(*[F.col(f"`{c}`") for c in keys], "record")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(len(keys)), RECORD_BYTES):
                part = batch.slice(lo, hi - lo)
                rows = []
                for raw in part.column(len(keys)).to_pylist():
                    try:
                        rows.append(derive(raw or b""))
                    except ValueError as e:
                        rows.append({"error": str(e)})
                made = [pa.array([r.get(n) for r in rows], TYPES[f.split()[1]]) for n, f in zip(NAMES, FIELDS.split(", "), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *made], names=[*keys, *NAMES])

    return kept.mapInArrow(tidy(task), ", ".join(([kept.drop("record").schema.toDDL()] if keys else []) + [FIELDS]))


def write_warcs(derived: DataFrame, folder: str, pages_of_file: int = 20_000) -> DataFrame:
    """Writes the derivatives as gzipped WARC files (a member for each record) under folder, a URI all executors reach."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        part, files, n, out, draft = TaskContext.get().partitionId(), [], 0, None, ""

        def finish() -> None:
            out.close()
            name = f"part-{part:06d}-{len(files):04d}.warc.gz"
            store.move(draft, f"{path}/{name}")
            files.append((f"{folder}/{name}", n))

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    draft, n = f"{path}/.{uuid.uuid4().hex}", 0
                    out = store.open_output_stream(draft, compression=None)
                for raw in (a, b):
                    if raw is not None:
                        out.write(gzip.compress(raw, mtime=0))
                        n += 1
                if n >= 2 * pages_of_file:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"file": pa.array([f for f, _ in files], pa.string()), "records": pa.array([k for _, k in files], pa.int64())})

    return derived.select("metadata", "conversion").mapInArrow(tidy(task), "file string, records long")
