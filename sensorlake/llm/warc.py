"""WARC archives: one gzip member per record, written and read by Spark tasks.

Records with equal payloads of at least ``SMALLEST`` bytes are stored once: the one with
the smallest page_id is a response, the others are revisits that refer to it and hold no
payload. The groups are found by digest: counts and smallest ids are combined before the
shuffle. A group with more than a ten-thousandth of all rows is broadcast (there are
fewer than ten thousand of those); the rest is joined by shuffle, and rows that need no
partner are spread over all tasks.

The reader goes through a file in order with bounded memory: it decompresses bit by bit,
frames each block by its content length, and verifies block and payload digests and the
end of each member. A damaged archive raises ``ValueError``.

Null html is an empty payload. Null url is written as the record's own id. Equal payloads
with the same smallest page_id (repeated rows) are all responses; a page without id is a
revisit only of a page that has one. Other columns are left out.
"""

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.files import listed, new_file, new_folder, opened

SMALLEST = 100
DATE = "1970-01-01T00:00:00Z"
#: Groups with more than this share of the rows are hot.
HOT_SHARE = 1e-4
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 20
_END = b"\r\n\r\n"


def with_first(pages, smallest=SMALLEST):
    """page_id, url, html, digest, n_bytes, and ``first``: the page to refer to, or null."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumns(
        {"digest": F.sha2("html", 256), "n_bytes": F.octet_length("html").cast("long")}
    )
    groups = (
        pages.where(F.col("n_bytes") >= smallest)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
    )
    limit = max(1000, int(pages.count() * HOT_SHARE))
    hot = groups.where(F.col("n") > limit).select("digest", F.col("first").alias("hot_first"))
    cold = groups.where(F.col("n") <= limit).select(F.col("digest").alias("key"), "first")
    alone = F.col("hot_first").isNotNull() | (F.col("n_bytes") < smallest)
    spread = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    first = F.coalesce("hot_first", "first")
    return (
        pages.join(F.broadcast(hot), "digest", "left")
        .withColumn("key", F.when(alone, spread).otherwise(F.col("digest")))
        .join(cold, "key", "left")
        .select(
            "page_id", "url", "html", "digest", "n_bytes",
            F.when(~F.col("page_id").eqNullSafe(first), first).alias("first"),
        )
    )


def _record_id(page_id):
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _uri(text):
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id, url, payload, digest, first=None, date=DATE):
    """Header and block of one record, as bytes."""
    own = _record_id(page_id)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url) if url else own[1:-1]}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if first is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(first)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def member(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages, folder=None, smallest=SMALLEST, date=DATE):
    """Writes archives; a table of their paths and numbers of records."""
    folder = folder or new_folder(pages.sparkSession, "warc")

    def archive(batches):
        n, file = 0, None
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        with new_file(folder, ".warc.gz") as (path, out):
            while head is not None:
                for row in zip(*(head[c] for c in ("page_id", "url", "html", "digest", "first"))):
                    page_id, url, html, digest, first = (x.as_py() for x in row)
                    out.write(member(record(page_id, url, html.encode(), digest, first, date)))
                    n += 1
                head = next(batches, None)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    files = with_first(pages, smallest).mapInArrow(archive, "path string, records long")
    return listed(files, "warc-files")


class _Member:
    """The bytes of one gzip member after another."""

    def __init__(self, stream):
        self.stream, self.raw, self.data, self.at_end = stream, b"", b"", False

    def begin(self):
        """False at the end of the file."""
        self.raw = self.raw or self.stream.read(_PIECE)
        self.unpack, self.data = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self):
        """Decompresses some more; False at the end of the member."""
        while not self.unpack.eof:
            if not self.raw:
                self.raw = self.stream.read(_PIECE)
                if not self.raw:
                    raise ValueError("the archive ends inside a member")
            got = self.unpack.decompress(self.raw, _PIECE)
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if got:
                self.data += got
                return True
        return False

    def until(self, mark):
        """The bytes before a mark, which is dropped."""
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self.more():
                raise ValueError("a record ends inside its header")
        head, self.data = self.data[:at], self.data[at + len(mark) :]
        return head

    def take(self, n):
        """Exactly n bytes, in pieces."""
        while n:
            if not self.data and not self.more():
                raise ValueError("a record is shorter than its content length")
            piece, self.data = self.data[:n], self.data[n:]
            n -= len(piece)
            yield piece

    def end(self):
        tail = b"".join(self.take(len(_END)))
        if tail != _END or self.data or self.more():
            raise ValueError("a record is longer than its content length")


def _fields(head):
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records(stream, keep_payload=False):
    """Dictionaries of the records of an open archive."""
    member = _Member(stream)
    while member.begin():
        head = member.until(_END)
        if not head.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        head = _fields(head)
        block, payload, kept = hashlib.sha256(), hashlib.sha256(), []
        http, n = b"", 0
        inside = False
        for piece in member.take(int(head["content-length"])):
            block.update(piece)
            if not inside:
                http += piece
                at = http.find(_END)
                if at < 0:
                    continue
                inside, piece, http = True, http[at + 4 :], http[:at]
            payload.update(piece)
            n += len(piece)
            if keep_payload:
                kept.append(piece)
        member.end()
        kind, digest = head["warc-type"], head["warc-payload-digest"].partition(":")[2]
        size = int(_fields(http).get("content-length", n))
        if block.hexdigest() != head["warc-block-digest"].partition(":")[2]:
            raise ValueError(f"{head['warc-record-id']}: the block does not match its digest")
        if kind == "response" and (payload.hexdigest() != digest or n != size):
            raise ValueError(f"{head['warc-record-id']}: the payload does not match its digest")
        yield {
            "page_id": _page(head["warc-record-id"]),
            "url": head["warc-target-uri"],
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": _page(head.get("warc-refers-to", "")),
            "payload": b"".join(kept) if keep_payload and kind == "response" else None,
        }


def _page(record_id):
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id)
    return int(found[1]) if found else None


_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read(files, keep_payload=False, rows=256):
    """The records of the archives whose paths are in ``files``; one task per archive."""

    def scan(batches):
        for batch in batches:
            for path in batch["path"]:
                with opened(path.as_py()) as stream:
                    some = []
                    for x in records(stream, keep_payload):
                        some.append(x)
                        if len(some) >= rows:
                            yield pa.RecordBatch.from_pylist(some, _SCHEMA)
                            some = []
                    yield pa.RecordBatch.from_pylist(some, _SCHEMA)

    kinds = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary"
    )
    found = files.select("path").mapInArrow(scan, kinds)
    return found if keep_payload else found.drop("payload")
