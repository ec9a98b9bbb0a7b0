"""ARC archives to WARC archives.

An ARC file opens with a version block, whose first line ends in the block's length, whose second
names the version and whose third names the fields of the header lines:

    filedesc://name 0.0.0.0 20240101000000 text/plain 76
    1 0 shardtally
    URL IP-address Archive-date Content-type Archive-length

Version 1 has these five fields, version 2 adds result code, checksum, location, offset and file name.
Each further record is a header line, as many bytes as its last field declares, and a line end. An
archive is a row: its name, and its bytes in a binary column, of about ``ARCHIVE_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import lean, longs
from shardtally.sources.workspace import stored

ARCHIVE_BYTES = 8_000_000
SLICE = 16_384
#: Fixed by the ARC format: the fields of a header line in either version.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed by the WARC format.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_FIELD = "X-Page-Id"
RECORD = "page_id long, url string, ip string, archived string, mime string, payload binary, payload_digest string, error string"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str | None) -> str:
    """A header field cannot hold blanks or line ends."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "") or "-"


def arc_record(version: int, url: str | None, date: str, block: bytes, name: str, offset: int) -> bytes:
    line = [_field(url), "0.0.0.0", date, "text/html"]
    if version == 2:
        line += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), name]
    return " ".join([*line, str(len(block))]).encode() + b"\n" + block + b"\n"


def arc_head(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 shardtally\n{FIELDS[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode() + body + b"\n"


def _http(page_id: int | None, payload: bytes) -> bytes:
    page = b"" if page_id is None else f"{PAGE_FIELD}: {page_id}\r\n".encode()
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + page + f"Content-Length: {len(payload)}\r\n\r\n".encode()


def _arcs(date: str):
    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        held: dict[int, list[bytes]] = {}
        sizes: dict[int, int] = {}

        def done() -> pd.DataFrame:
            names = [x[0].split(b" ", 1)[0].decode().removeprefix("filedesc://") for x in held.values()]
            out = pd.DataFrame({"archive": names, "content": [b"".join(x) for x in held.values()]})
            held.clear()
            sizes.clear()
            return out

        for batch in batches:
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                page_id = None if page_id is None else int(page_id)
                version = 1 + (page_id or 0) % 2
                payload = (html or "").encode()
                name = f"pages-{task}-{number}-v{version}.arc"
                if version not in held:
                    held[version] = [arc_head(version, name, date)]
                    sizes[version] = len(held[version][0])
                record = arc_record(version, url, date, _http(page_id, payload) + payload, name, sizes[version])
                held[version].append(record)
                sizes[version] += len(record)
                if sum(sizes.values()) > ARCHIVE_BYTES:
                    yield done()
                    number += 1
        if held:
            yield done()

    return rows


def _text_id(column: str) -> Column:
    """An id as decimal text: pandas would turn a nullable long into a double."""
    return F.col(column).cast("long").cast("string").alias(column)


def write_arc(pages: DataFrame, date: str = "20240101000000") -> DataFrame:
    """``archive, content`` of ``pages`` (page_id, url, html); even page_ids in version 1, odd ones in version 2."""
    own = pages.select(_text_id("page_id"), "url", "html")
    return own.mapInPandas(_arcs(date), "archive string, content binary")


def _http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and body; a block without an HTTP head is all body."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, _, body = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, body


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of one ARC file. What does not fit its declaration ends the file with an ``error`` record."""
    at, names, opened = 0, FIELDS[1].lower().split(), False
    while at < len(content):
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].rstrip(b"\r").decode("utf-8", "replace")
        if not line.strip():  # line ends between records
            at = end + 1 if end >= 0 else len(content)
            continue
        fields = line.split(" ")
        length = fields[-1]
        if end < 0 or not length.isdecimal():
            yield {"error": f"no header line: {line[:80]}"}
            return
        block = content[end + 1 : end + 1 + int(length)]
        at = end + 1 + int(length)
        if line.startswith("filedesc://") and not opened:
            lines = block.decode("utf-8", "replace").splitlines()
            opened = True
            names = (lines[1] if len(lines) > 1 else FIELDS[2 if lines and lines[0].startswith("2") else 1]).lower().split()
            continue
        if len(block) < int(length):
            yield {"error": f"declared {length} bytes, found {len(block)}"}
            return
        if len(fields) != len(names):
            yield {"error": f"{len(fields)} fields, {len(names)} declared"}
            continue
        found = dict(zip(names, fields))
        head, payload = _http_parts(block)
        page = head.get(PAGE_FIELD.lower())
        yield {
            "page_id": int(page) if page else None,
            "url": found.get("url"),
            "ip": found.get("ip-address"),
            "archived": found.get("archive-date"),
            "mime": found.get("content-type"),
            "payload": payload,
            "payload_digest": digest_of(payload),
            "error": None,
        }


@lean
def _read_arcs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            records = list(arc_records(content or b""))
            yield pd.DataFrame({c: longs([r.get(c) for r in records]) if c == "page_id" else pd.Series([r.get(c) for r in records], dtype=object) for c in columns})


@lean
def _read_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            sound = [r for r in arc_records(content or b"") if r["error"] is None]
            ids, sizes = longs([r["page_id"] for r in sound]), [len(r["payload"]) for r in sound]
            yield pd.DataFrame({"page_id": ids, "payload_digest": pd.Series([r["payload_digest"] for r in sound], dtype=object), "payload_bytes": longs(sizes)})


def read_arc(archives: DataFrame) -> DataFrame:
    """One row per record of ARC ``archives`` (content binary); broken records have an ``error`` and nothing else."""
    return archives.select("content").mapInPandas(_read_arcs, RECORD)


def read_digests(archives: DataFrame) -> DataFrame:
    """page_id, digest and size of each sound record: what the choice of responses needs, without payloads."""
    return archives.select("content").mapInPandas(_read_digests, "page_id long, payload_digest string, payload_bytes long")


def record_uuid(digest: str, page_id: int | None) -> str:
    """A record's identifier follows from what it holds, so a rerun writes the same archives."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest}/{page_id}')}"


def warc_date(archived: str | None) -> str:
    """ARC's 14 digits (fewer are filled up) as WARC's timestamp."""
    digits = "".join(c for c in archived or "" if c.isdecimal())[:14]
    digits += "00000101000000"[len(digits) :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def warc_record(row) -> bytes:
    page_id = None if row.page_id is None else int(row.page_id)
    revisit = row.record_type == "revisit"
    block = _http(page_id, row.payload) + (b"" if revisit else row.payload)
    lines = [
        "WARC/1.0",
        f"WARC-Type: {row.record_type}",
        f"WARC-Record-ID: <{record_uuid(row.payload_digest, page_id)}>",
        f"WARC-Date: {warc_date(row.archived)}",
        f"WARC-Target-URI: {row.url}",
        f"WARC-IP-Address: {row.ip}",
        f"WARC-Payload-Digest: sha1:{row.payload_digest}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_uuid(row.payload_digest, int(row.first_id))}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@lean
def _warcs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            held.append(_gzip(warc_record(row)))
            size += len(held[-1])
            if size > ARCHIVE_BYTES:
                yield pd.DataFrame({"content": [b"".join(held)]})
                held, size = [], 0
    if held:
        yield pd.DataFrame({"content": [b"".join(held)]})


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each gzip member of a WARC file, which is fed in slices: what a member leaves over is copied."""
    content, at = memoryview(content), 0
    while at < len(content):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(content):
                raise ValueError("the archive ends within a record")
            parts.append(unpacker.decompress(content[at : at + SLICE]))
            at = min(at + SLICE, len(content))
        at -= len(unpacker.unused_data)
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        pairs = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
        fields = {name: value for name, _, value in pairs}
        yield fields, rest[: int(fields["Content-Length"])]


@lean
def _read_warcs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["page_id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to_id"]
    for batch in batches:
        for content in batch["content"]:
            out = []
            for fields, block in warc_records(content):
                http, payload = _http_parts(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and digest_of(payload) != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
                page = http.get(PAGE_FIELD.lower())
                refers = fields.get("WARC-Refers-To")
                out.append((int(page) if page else None, fields["WARC-Record-ID"].strip("<>"), fields["WARC-Type"], int(http["content-length"]), digest, refers and refers.strip("<>")))
            frame = {c: pd.Series([r[i] for r in out], dtype=object) for i, c in enumerate(columns)}
            yield pd.DataFrame(frame | {c: longs(frame[c]) for c in ("page_id", "payload_bytes")})


def convert(archives: DataFrame, least: int = 0) -> DataFrame:
    """WARC archives (content binary) of the records of ARC ``archives``; broken ones are left out.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is the
    response and others revisit it; smaller ones are all responses. Null ids revisit the largest
    other id, and are responses where there is none; repeated rows of the largest id are responses.
    Digests are read in a pass of their own, which hands on no payloads; only payloads that occur more
    than once are looked up in its outcome.
    """
    digests = read_digests(archives).where(F.col("payload_bytes") >= least)
    firsts = digests.groupBy("payload_digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = read_arc(archives).where("error is null").join(firsts, "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    columns = [_text_id("page_id"), "url", "ip", "archived", "payload", "payload_digest", _text_id("first_id")]
    return joined.select(*columns, F.when(revisit, "revisit").otherwise("response").alias("record_type")).mapInPandas(_warcs, "content binary")


def read_warc(archives: DataFrame) -> DataFrame:
    """One row per record; revisits are resolved to the page_id of the response they refer to."""
    schema = "page_id long, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to_id string"
    records = stored(archives.select("content").mapInPandas(_read_warcs, schema), "records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    targets = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()
    revisits = records.where("record_type = 'revisit'").join(targets, "refers_to_id", "left").select(*columns, "refers_to")
    return revisits.union(records.where("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to")))


def through_warc(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of ``pages`` written as ARC, converted and read back.

    Repeated rows are records of their own: those of the largest id are all responses, others all revisits.
    Null html is an empty payload, null urls are written as ``-``; other columns are not looked at; an
    empty table gives an empty result.
    """
    return read_warc(stored(convert(write_arc(pages), least), "warc"))
