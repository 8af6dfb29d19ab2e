"""WARC archives: one gzip member for each record, written by partition and read in sequence.

Writing: records of equal payload (SHA-1) of ``min_revisit`` bytes or more are stored once, in the
record with the largest id; the others are ``revisit`` records that refer to it and carry only the
HTTP header (which has the payload's length) and its digest.  Each task writes one file; the files
of the attempts that succeeded make up the manifest, so files of lost attempts are never read.

Reading: the file is inflated piece by piece; a record is framed by its Content-Length, its block
and payload digests are recomputed while it streams past and a mismatch raises ``ValueError``.

Defined cases: a null payload is empty; a null url gives an empty target, one of any length is kept
whole; an empty text as id comes back null; a null id is kept null and is never referred to unless nothing else is there, in which case all records are responses; rows
repeating both id and payload of the largest id are all responses; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import arrow_map, cut, filesystem
from quillspark.session import scratch_dir

PIECE = 1 << 16
_URN = "urn:x-page:"


def _sha1(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _hex(labelled: str) -> str:
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def record_bytes(key: str, url: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One record as a gzip member."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers is not None else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers is not None else "response"),
        ("WARC-Record-ID", f"<{_URN}{key}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", "".join(url.split())),
        ("WARC-Payload-Digest", _sha1(digest)),
        ("WARC-Block-Digest", _sha1(hashlib.sha1(block).hexdigest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_URN}{refers}>"),
        ]
    header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(header.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


class Members:
    """The gzip members of a file as one byte stream that knows where each member ends."""

    def __init__(self, source):
        self.source, self.z, self.raw, self.held = source, None, b"", b""

    def begin(self) -> bool:
        """Move to the next member; False at the end of the file."""
        if self.held or self.z is not None and not self.z.eof:
            raise ValueError("a record does not end with its gzip member")
        if not self.raw:
            self.raw = self.source.read(PIECE)
        self.z = zlib.decompressobj(31) if self.raw else None
        return self.z is not None

    def _more(self) -> bool:
        while not self.z.eof:
            if not self.raw and not self.z.unconsumed_tail:
                self.raw = self.source.read(PIECE)
                if not self.raw:
                    raise ValueError("a gzip member is cut off")
            data = self.z.decompress(self.z.unconsumed_tail or self.raw, PIECE)
            if self.z.eof:
                self.raw = self.z.unused_data
            elif self.z.unconsumed_tail:
                self.raw = b""
            else:
                self.raw = b""
            if data:
                self.held += data
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What comes before the next ``mark``, however long it is."""
        pieces, joint = [], b""  # a mark may lie across two pieces
        while True:
            at = (joint + self.held).find(mark)
            if at >= 0:
                break
            pieces.append(self.held)
            joint = (joint + self.held)[1 - len(mark) :]
            self.held = b""
            if not self._more():
                raise ValueError("a header does not end")
        cut_at = at - len(joint)  # below 0 where the mark begins in the pieces before
        found = b"".join([*pieces, self.held[: max(cut_at, 0)]])
        self.held = self.held[cut_at + len(mark) :]
        return found[:cut_at] if cut_at < 0 else found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise ValueError("a block is shorter than its Content-Length")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part

    def end(self) -> None:
        tail = b"".join(self.take(4))
        if tail != b"\r\n\r\n" or self._more() or self.held:
            raise ValueError("a record does not end where its Content-Length says")


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_records(source, payloads: bool = False) -> Iterator[dict]:
    """The records of an open archive, verified; with ``payloads``, the payload of responses."""
    stream = Members(source)
    while stream.begin():
        f = _fields(stream.until(b"\r\n\r\n"))
        block, body, kept = hashlib.sha1(), hashlib.sha1(), []
        http, length = b"", None
        for part in stream.take(int(f["content-length"])):
            block.update(part)
            if length is None:
                http += part
                head, mark, part = http.partition(b"\r\n\r\n")
                if not mark:
                    continue
                length = int(_fields(head)["content-length"])
            body.update(part)
            if payloads:
                kept.append(part)
        stream.end()
        if _sha1(block.hexdigest()) != f["warc-block-digest"]:
            raise ValueError(f"{f['warc-record-id']}: block digest")
        revisit = f["warc-type"] == "revisit"
        if not revisit and _sha1(body.hexdigest()) != f["warc-payload-digest"]:
            raise ValueError(f"{f['warc-record-id']}: payload digest")
        yield {
            "key": f["warc-record-id"][1 + len(_URN) : -1],
            "url": f.get("warc-target-uri", ""),
            "type": f["warc-type"],
            "bytes": length,
            "digest": _hex(f["warc-payload-digest"]) if revisit else body.hexdigest(),
            "refers": f["warc-refers-to"][1 + len(_URN) : -1] if revisit else None,
            "payload": b"".join(kept) if payloads and not revisit else None,
        }


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the archives under ``folder``; the manifest (path, records) is a table there too.  Ids may
    be whole numbers or text."""
    data = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        data.alias("payload"),
        F.sha1(data).alias("digest"),
    )
    large = rows.where(F.octet_length("payload") >= min_revisit)
    groups = large.groupBy("digest").agg(F.max("id").alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Only one narrow row for each repeated payload on the right; a hot payload is split by AQE.
    records = rows.join(groups, "digest", "left").select(
        "id", "url", "payload", "digest",
        F.expr("CASE WHEN octet_length(payload) >= {0} AND NOT (id <=> main) THEN main END".format(int(min_revisit))).alias("refers"),
    )

    def write(rows):
        out = name = None
        n = 0
        for r in rows:
            if out is None:
                where, base = filesystem(folder)
                where.create_dir(base, recursive=True)
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
                out = where.open_output_stream(f"{base}/{name}", compression=None)
            out.write(record_bytes(_key(r["id"]), r["url"], r["payload"], r["digest"], None if r["refers"] is None else _key(r["refers"])))
            n += 1
        if out is not None:
            out.close()
            yield f"{folder}/{name}", n

    return cut(arrow_map(records, write, "path string, records long"), "warc-manifest")


def _key(value) -> str:
    """An id as part of a URN; a null one is empty."""
    return "" if value is None else quote(str(value), safe="")


def read_archives(manifest: DataFrame, payloads: bool = False, id_type: str = "long") -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of all archives;
    ids come back as ``id_type``."""

    def read(rows):
        for r in rows:
            where, path = filesystem(r["path"])
            with where.open_input_stream(path, compression=None) as source:
                found = 0
                for x in read_records(source, payloads):
                    found += 1
                    row = (unquote(x["key"]) or None, x["url"], x["bytes"], x["digest"], x["type"], unquote(x["refers"] or "") or None)
                    yield (*row, x["payload"]) if payloads else row
                if found != r["records"]:
                    raise ValueError(f"{r['path']}: {found} records, {r['records']} were written")

    schema = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    spark = manifest.sparkSession
    spread = manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    found = arrow_map(spread, read, schema + (", payload binary" if payloads else ""))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("id", "refers_to")})


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    kind = pages.schema[options.get("id_col", "page_id")].dataType.simpleString()
    return read_archives(write_archives(pages, scratch_dir(pages.sparkSession, "warc"), **options), id_type=kind)
