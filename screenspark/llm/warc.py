"""Operator 6: WARC archives, written from pages and read back by byte ranges.

Each record is a gzip member of its own.  Spark's text writer puts the members into
files, so that its commit protocol guards against lost executors; the separator that
it writes after each row is an empty gzip member, which any reader passes over.

The reader is splittable.  Spark cuts the files into byte ranges and reads them by any file
system that it knows, as text whose lines end at gzip's magic bytes: a task scans its range
for the magic, owns what starts behind one inside of it, and reads beyond the range's end
to finish the last.  Each such piece is a candidate member, validated by decoding its
header; a member that holds a WARC header is a record.  Magic bytes can also stand inside
of a member, which then comes in several pieces: they are decoded on, one after the other,
and what of them lies in the ranges of two tasks is brought together by file.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from screenspark.llm.common import Scratch, dealt, map_batches, stored

MAGIC = b"\x1f\x8b\x08"
#: A gzip member of nothing, of fixed bytes.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + bytes(8)
VERSION = b"WARC/1."
#: Settings of one read by which files named .gz are taken as they are, and so in ranges.  The
#: reader looks for the codec whose ending sorts last before a file's name, both read backwards,
#: and takes none if the name doesn't end so: this one stands between .gz and all such names.
#: Spark's own build of Hadoop has another name for the setting of the ending.
AS_THEY_ARE = {"io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec"}
AS_THEY_ARE |= {f"{p}io.compress.passthrough.extension": "!.gz" for p in ("", "org.apache.hadoop.shaded.")}
PAGE = "urn:page:"


@dataclass(frozen=True)
class WarcParams:
    #: Payloads of fewer bytes are always written whole.
    least_revisit: int = 100
    level: int = 6


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha: str, refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to``) has the HTTP head alone, with the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + (payload or b"")
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE}{'none' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{PAGE}{refers_to}>"]
    return VERSION + b"1\r\n" + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, path: str, params: WarcParams = WarcParams()) -> None:
    """Write a record for each row of (page_id, url, html) into archives below ``path``.

    Of equal payloads of at least ``least_revisit`` bytes the one with the smallest
    page_id is a response; the others revisit it.  A null html is an empty payload.
    Rows without page_id are responses.  Of rows that repeat the smallest page_id with
    an equal payload each is a response.  Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    # Who revisits is told by ids and digests alone; a digest that many pages share is many keys of the join.
    ids = rows.filter((F.col("size") >= params.least_revisit) & F.col("page_id").isNotNull()).select("sha", "page_id")
    first = ids.groupBy("sha").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first <> last")
    revisits = ids.join(dealt(first), "sha").filter("page_id <> first").select("sha", "page_id", F.col("first").alias("refers_to")).distinct()
    known = rows.join(dealt(revisits), ["sha", "page_id"], "left")
    known = known.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "sha", "refers_to")

    def make():
        def step(cols):
            fields = (cols[k] for k in ("page_id", "url", "payload", "size", "sha", "refers_to"))
            return {"member": [member(record(*row), params.level) for row in zip(*fields)]}

        return step

    members = map_batches(known, make, "member binary")
    writer = members.select(F.col("member").cast("string").alias("value")).write
    writer.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("compression", "none").text(path)


class Member:
    """A gzip member that is decoded as its bytes come; ``record`` if it holds one."""

    def __init__(self):
        self.decoder, self.content, self.raw = zlib.decompressobj(31), b"", []
        self.done = self.record = False

    def feed(self, data: bytes) -> bool:
        """Whether the bytes can be what comes next of a record or of a whole member;
        ``done`` if nothing is missing then."""
        self.raw.append(data)
        try:
            if not self.record:
                self.content += self.decoder.decompress(data, len(VERSION) - len(self.content))
                data = self.decoder.unconsumed_tail
                self.record = self.content == VERSION
                if self.content and not VERSION.startswith(self.content):
                    return False
            if self.record and not self.decoder.eof:
                self.content += self.decoder.decompress(data)
        except zlib.error:
            return False
        self.done = self.decoder.eof
        return True

    def goes_on(self, data: bytes) -> bool:
        """As ``feed``, but bytes that don't fit leave the member as it is."""
        before = self.decoder.copy(), self.content, list(self.raw), self.record
        if self.feed(data):
            return True
        self.decoder, self.content, self.raw, self.record = before
        return False


class Range:
    """The records of one byte range, from its pieces in their order."""

    def __init__(self, start: int):
        self.skip = start == 0  # what stands before a file's first magic bytes
        self.begun = start == 0  # whether all that comes now is of members that start here
        self.tail, self.open = [], None

    def add(self, piece: bytes) -> bytes | None:
        """The record that the piece ends, if it does."""
        if self.skip:
            self.skip = False
            return None
        data, member = MAGIC + piece, self.open
        if member is not None and not member.feed(data):
            # Bytes that looked alike; at first they may go on what the range before has begun.
            self.tail += [] if self.begun else member.raw[:-1]
            member = None
        if member is None:
            member = Member()
            if not member.feed(data):
                self.tail += [] if self.begun else [data]
                self.open = None
                return None
        self.begun = self.begun or member.record or member.done
        self.open = None if member.done else member
        return member.content if member.done and member.record else None

    def dangling(self) -> list[tuple[int, bytes]]:
        """What other ranges' bytes belong to: 0 with a member's end, 1 with a start, 2 with
        either."""
        found = [(0, b"".join(self.tail))] if self.tail else []
        return found + ([(1 if self.begun else 2, b"".join(self.open.raw))] if self.open else [])


FIELDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def parse(data: bytes) -> dict:
    """Headers and payload of a record; the digest of a payload is computed anew.

    Records of other makers than ``write_archives`` have no page_id.  One without type or
    length, or with less than its length, is of the type ``malformed``, all else null.
    """
    nothing = dict.fromkeys(("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"))
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.partition(":")[::2] for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
    kind, length = fields.get("warc-type"), fields.get("content-length", "")
    if not kind or not length.isdecimal() or len(block) < int(length):
        return nothing | {"record_type": "malformed"}
    payload, size = block[: int(length)], None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = payload.partition(b"\r\n\r\n")
        sizes = [x.split(b":")[1].strip() for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:")]
        size = int(sizes[0]) if sizes and sizes[0].isdigit() else None

    def page(name: str) -> int | None:
        text = fields.get(name, "").strip("<>")
        number = text.removeprefix(PAGE)
        return int(number) if text.startswith(PAGE) and number.lstrip("-").isdecimal() else None

    revisit = kind == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return nothing | {
        "page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": page("warc-refers-to"),
        "payload_bytes": size if revisit else len(payload), "payload_digest": digest if revisit else hashlib.sha256(payload).hexdigest(), "payload": None if revisit else payload,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``; payloads only on request.

    The rows are a table in the shared folder.  Spark's setting for the size of input
    partitions is that of the byte ranges.  Files named .gz are read in ranges as others are;
    names by which Spark would decompress a file as a whole (.bz2 and others) are refused.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    conf = jvm.org.apache.hadoop.conf.Configuration(spark.sparkContext._jsc.hadoopConfiguration())
    for name, value in AS_THEY_ARE.items():
        conf.set(name, value)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    if packed := [f.getPath().getName() for f in root.getFileSystem(conf).listStatus(root) if codecs.getCodec(f.getPath()) is not None]:
        raise ValueError(f"Spark would decompress {packed[0]}; archives need names without such an ending")
    pieces = spark.read.options(**AS_THEY_ARE).option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = pieces.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    fields = FIELDS + (", payload binary" if payloads else "")
    plain, schema = StructType.fromDDL(fields), StructType.fromDDL(f"{fields}, file string, start bigint, part int, raw binary")

    def batch_of(rows: list[dict], kind: StructType) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kind)
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], type=f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now, rows, size = None, None, [], 0
        for batch in batches:
            for piece, *place in zip(*(c.to_pylist() for c in batch.columns)):
                if place != at:
                    rows += [{"file": at[0], "start": at[1], "part": k, "raw": raw} for k, raw in (now.dangling() if now else [])]
                    at, now = place, Range(place[1])
                data = now.add(piece)
                if data is not None:
                    rows.append(parse(data))
                    size += len(data)
                    if len(rows) >= 2000 or payloads and size > 8 << 20:
                        yield batch_of(rows, schema)
                        rows, size = [], 0
        rows += [{"file": at[0], "start": at[1], "part": k, "raw": raw} for k, raw in (now.dangling() if now else [])]
        yield batch_of(rows, schema)

    def joined(table: pa.Table) -> pa.Table:
        rows, member = [], None
        for row in sorted(table.to_pylist(), key=lambda r: (r["start"], r["part"])):
            if member is None or row["part"] == 1 or not member.goes_on(row["raw"]):
                member = Member() if row["part"] else None
                member = member if member and member.feed(row["raw"]) else None
            if member and member.done:
                rows += [parse(member.content)] if member.record else []
                member = None
        return pa.Table.from_batches([batch_of(rows, plain)])

    with Scratch(spark) as tmp:
        found = tmp.stored(pieces.mapInArrow(run, schema), "warc-ranges")
        whole = found.filter("part IS NULL").select(plain.names)
        rest = found.filter("part IS NOT NULL").select("file", "start", "part", "raw").groupBy("file").applyInArrow(joined, fields)
        return stored(whole.unionByName(rest), "warc")
