"""WARC archives of web pages: writing, and a sequential reader (operator 1).

**Writing.** One gzip member per record. Of records with equal payloads of at least
``LEAST`` bytes, that with the smallest id is a response and the others revisit it
(their block has the HTTP head only); smaller ones are all responses. Equal payloads
meet by digest in a grouped minimum, so the payloads themselves aren't shuffled for
it unless the table of repeated digests is too large to broadcast. Each task writes
volumes of about ``VOLUME`` bytes under names of its own and reports them when they
are closed; what a lost task wrote is in no report.

**Reading.** A volume is read front to back in pieces of 1 MB: a member is inflated
as far as needed, the head ends at a blank line, Content-Length frames the block, and
the member must end with it. Digests of block and payload are checked; a wrong one,
or a cut or damaged volume, raises an error with the volume's name and record.

Archives lie in the folder of ``spark.checkpoint.dir`` (any store that pyarrow
opens).

Defined cases: a null payload is empty; a null or blank URL is left out, control
characters in it are escaped; URLs may be of any length and ids any text; rows with the smallest id of their group are all
responses; a null id is read back as null, and is a response only if no row of the
group has an id; extra columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.llm.common import materialize
from pricewise.session import ensure_checkpoint_dir

LEAST = 100
VOLUME = 32 << 20
PIECE = 1 << 20
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    head: dict[str, str]
    block: bytes


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def member(head: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = {**head, "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Length": str(len(block))}
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _urn(page_id: str | None) -> str:
    """The name of a page's record: its id with escapes, so any id comes back."""
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(page_id, safe='')}>"


def _page(urn: str | None) -> str | None:
    return None if urn in (None, "<urn:page>") else unquote(urn[len("<urn:page:"):-1])


def page_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """The member of a page: a response, or a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _urn(page_id), "WARC-Date": DATE}
    if url and url.strip():
        head["WARC-Target-URI"] = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url.strip())
    head["WARC-Payload-Digest"] = f"sha256:{digest}"
    if refers_to is not None:
        head |= {"WARC-Refers-To": _urn(refers_to), "WARC-Profile": _PROFILE}
    head["Content-Type"] = "application/http; msgtype=response"
    return member(head, http + payload if refers_to is None else http)


class _Member:
    """Inflates one gzip member of a stream piece by piece."""

    def __init__(self, stream: BinaryIO, rest: bytes):
        self.stream, self.raw, self.z, self.out = stream, rest, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Inflate another piece; False at the member's end."""
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail or self.raw or self.stream.read(PIECE)
        if not data:
            raise ValueError("the volume ends inside a record")
        if not self.z.unconsumed_tail:
            self.raw = b""
        self.out += self.z.decompress(data, PIECE)
        return True

    def take(self, n: int) -> bytes:
        while len(self.out) < n and self.more():
            pass
        if len(self.out) < n:
            raise ValueError("the record is shorter than its Content-Length")
        got = bytes(self.out[:n])
        del self.out[:n]
        return got

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark, of any length; each byte is searched once."""
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark) + 1))) < 0:
            seen = len(self.out)
            if not self.more():
                raise ValueError("the record has no end of its head")
        return self.take(at + len(mark))[:-len(mark)]

    def finish(self) -> bytes:
        """What the stream holds after the member, as far as it is read."""
        while self.more():
            pass
        if self.out:
            raise ValueError("the record goes on after its end")
        return self.z.unused_data or self.raw


def _digest_ok(stated: str | None, data: bytes) -> bool:
    return stated is None or stated == f"sha256:{hashlib.sha256(data).hexdigest()}"


def records(stream: BinaryIO) -> Iterator[Record]:
    """The records of a volume in order, digests checked."""
    rest = stream.read(PIECE)
    k = 0
    while rest:
        try:
            one = _Member(stream, rest)
            version, *lines = one.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError("not a WARC record")
            head = dict(line.split(": ", 1) for line in lines)
            block = one.take(int(head["Content-Length"]))
            if one.take(4) != b"\r\n\r\n":
                raise ValueError("the block isn't followed by an empty line")
            rest = one.finish() or stream.read(PIECE)
            if not _digest_ok(head.get("WARC-Block-Digest"), block):
                raise ValueError("wrong block digest")
            if head["WARC-Type"] == "response" and not _digest_ok(head.get("WARC-Payload-Digest"), block.partition(b"\r\n\r\n")[2]):
                raise ValueError("wrong payload digest")
        except (ValueError, KeyError, zlib.error) as error:
            raise ValueError(f"record {k}: {error}") from error
        yield Record(head, block)
        k += 1


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows; returns the volumes (path, n_records, n_bytes)."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    repeated = rows.where(F.octet_length("payload") >= LEAST).groupBy("digest") \
        .agg(F.min("id").alias("first"), F.count("*").alias("k")).where("k > 1").select("digest", "first")
    ready = rows.join(repeated, "digest", "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"))

    def run(batches):
        store, at = _open(folder)
        out, done = None, 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{at}/{path.rsplit('/', 1)[1]}", compression=None)
                    out.write(member({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE,
                                      "Content-Type": "application/warc-fields"}, b"format: WARC file version 1.1\r\n"))
                raw = page_record(r["id"], r["url"], r["payload"], r["digest"], r["refers_to"])
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= VOLUME:
                    out.close()
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size])], names=["path", "n_records", "n_bytes"])
                    out, done = None, done + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size])], names=["path", "n_records", "n_bytes"])

    store, at = _open(folder)
    store.create_dir(at, recursive=True)
    return materialize(ready.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-volumes")


def read_archives(volumes: DataFrame, id_type: str = "long") -> DataFrame:
    """Per page record of the volumes (path): page_id, target_uri, payload_bytes,
    payload_digest, record_type, refers_to, payload (null for a revisit)."""

    names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                store, at = _open(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as stream:
                    try:
                        for head, block in records(stream):
                            kind = head["WARC-Type"]
                            if kind not in ("response", "revisit"):
                                continue
                            http, _, payload = block.partition(b"\r\n\r\n")
                            length = next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
                            rows.append((_page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), int(length.split(":")[1]),
                                         head["WARC-Payload-Digest"].split(":")[1], kind, _page(head.get("WARC-Refers-To")),
                                         payload if kind == "response" else None))
                            size += len(block)
                            if size > 8 << 20:
                                yield batch(rows)
                                rows, size = [], 0
                    except ValueError as error:
                        raise ValueError(f"{path}: {error}") from error
                if rows:
                    yield batch(rows)

    n = max(1, volumes.count())
    read = volumes.select("path").repartition(n).mapInArrow(
        run, "page_id string, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return read.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_and_read(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    folder = f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder, id_col), pages.schema[id_col].dataType.simpleString())


ORACLE_SQL = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g
"""
