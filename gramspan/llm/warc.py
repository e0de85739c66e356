"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding a few whole
WARC records, followed by a skippable frame with the seek table (compressed
and plain size of each frame, and a fixed trailer that gives the table's
length from the end). Any Zstandard reader can decompress a bundle; a seeking
reader loads the footer, finds a frame and decompresses that one alone. The
index maps a record identifier to bundle, frame and the record's place in the
frame's plain bytes.

Bundles are stored as binary rows of a Parquet table, so that every store that
Spark can write to can hold them.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import scratch

# Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
_ENTRY, _FOOTER = "<II", "<IBI"
_ENTRY_SIZE, _FOOTER_SIZE = struct.calcsize(_ENTRY), struct.calcsize(_FOOTER)
_EPOCH = "1970-01-01T00:00:00Z"

BUNDLE_SCHEMA = "bundle string, data binary, index array<struct<record_id:string,frame:int,start:int,length:int>>"
RECORD_SCHEMA = (
    "record_id string, page_id long, url string, record_type string, payload_digest string, "
    "refers_id string, refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, url: str | None, payload: bytes, sha: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has an empty block and the identifier of its response."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {_EPOCH}",
        f"WARC-Payload-Digest: sha1:{sha}",
    ]
    if url is not None:
        # A line break would end the header.
        head.append("WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers of one record by lower-case name, and its ``block``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {}
    for line in lines:
        name, _, value = line.partition(":")
        out[name.lower()] = value.strip()
    length = int(out["content-length"])
    if len(rest) < length + 4 or rest[length : length + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    out["block"] = rest[:length]
    return out


class BundleWriter:
    """Collects records, closing a frame after ``frame_bytes`` plain bytes."""

    def __init__(self, frame_bytes: int, level: int = 3):
        self.frame_bytes = frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.sizes, self.index, self.open, self.held, self.size = [], [], [], [], 0, 0

    def add(self, record_id: str, data: bytes) -> None:
        self.index.append((record_id, len(self.frames), self.held, len(data)))
        self.open.append(data)
        self.held += len(data)
        if self.held >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        frame = self.packer.compress(b"".join(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), self.held))
        self.size += len(frame)
        self.open, self.held = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        entries = b"".join(struct.pack(_ENTRY, *s) for s in self.sizes)
        footer = struct.pack(_FOOTER, len(self.sizes), 0, SEEKABLE)
        table = struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer
        return b"".join(self.frames) + table


class BundleReader:
    """Random access to the frames of a bundle, from its footer alone."""

    def __init__(self, data: bytes):
        frames, _, magic = struct.unpack_from(_FOOTER, data, len(data) - _FOOTER_SIZE)
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        at = len(data) - _FOOTER_SIZE - frames * _ENTRY_SIZE
        self.data, self.places, place = data, [], 0
        for i in range(frames):
            packed, plain = struct.unpack_from(_ENTRY, data, at + i * _ENTRY_SIZE)
            self.places.append((place, packed, plain))
            place += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        place, packed, plain = self.places[number]
        return self.unpacker.decompress(self.data[place : place + packed], max_output_size=plain)

    def record(self, frame: int, start: int, length: int) -> dict:
        return parse(self.frame(frame)[start : start + length])


def _keyed(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, sha, size, row``: ``row`` names what the row says; equal rows share it."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"sha": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    content = F.substring(F.sha2(F.concat_ws("|", "sha", F.hex(F.col("url"))), 256), 1, 32)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    return rows.withColumn("row", F.concat_ws(":", F.lit("urn:page"), page, content))


def record_plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A row per record: ``row, record_id, page_id, url, sha, refers_id`` (null for a response).

    The least row of a page_id is ``urn:page:<page_id>``; other rows of it, rows
    without page_id and equal rows have longer identifiers. The response of a
    payload is that of the least page_id, none last, then url.
    """
    slim = _keyed(pages).groupBy("row", "page_id", "url", "sha", "size").agg(F.count(F.lit(1)).alias("n"))
    least = slim.filter("page_id is not null").groupBy("page_id").agg(F.min("row").alias("least"))
    plain = F.concat(F.lit("urn:page:"), F.col("page_id").cast("string"))
    known = slim.filter("page_id is not null").join(least, "page_id")
    known = known.withColumn("name", F.when(F.col("row") == F.col("least"), plain).otherwise(F.col("row"))).drop("least")
    named = known.unionByName(slim.filter("page_id is null").withColumn("name", F.col("row")))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("bare"), "url", "name")
    first = named.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min(order).alias("first"))
    marked = named.join(first.select("sha", "size", F.col("first.name").alias("response")), ["sha", "size"], "left")
    copies = marked.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    again = F.col("response").isNotNull() & ((F.col("name") != F.col("response")) | (F.col("copy") > 0))
    name = F.when(F.col("copy") == 0, F.col("name")).otherwise(F.concat_ws(":", "row", "copy"))
    return copies.select(
        "row", name.alias("record_id"), "page_id", "url", "sha", F.when(again, F.col("response")).alias("refers_id")
    )


def write_bundles(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    frame_bytes: int = 1 << 18,
    bundle_bytes: int = 16 << 20,
) -> None:
    """Archive ``page_id, url, html`` as a table of bundles with their indexes.

    Every row has a record, rows that are equal, share a page_id or have none
    too. A null html is an empty payload and a null url has no target header.
    Further columns are ignored. A bundle is closed once its frames hold
    ``bundle_bytes``, so a task holds one bundle.
    """
    plan = record_plan(pages, min_bytes)
    payloads = _keyed(pages).select("row", "html").dropDuplicates(["row"])
    shape = ("record_id", "url", "html", "sha", "refers_id")
    responses = plan.filter("refers_id is null").join(payloads, "row").select(*shape)
    revisits = plan.filter("refers_id is not null").withColumn("html", F.lit(b"")).select(*shape)
    marked = responses.unionByName(revisits)

    def pack(batches):
        schema = pa.schema(
            [
                ("bundle", pa.string()),
                ("data", pa.binary()),
                (
                    "index",
                    pa.list_(
                        pa.struct(
                            [
                                ("record_id", pa.string()),
                                ("frame", pa.int32()),
                                ("start", pa.int32()),
                                ("length", pa.int32()),
                            ]
                        )
                    ),
                ),
            ]
        )
        writer, name = BundleWriter(frame_bytes), None

        def closed():
            index = [dict(zip(("record_id", "frame", "start", "length"), x, strict=True)) for x in writer.index]
            return pa.RecordBatch.from_pylist(
                [{"bundle": f"pages-{name}", "data": writer.finish(), "index": index}], schema
            )

        for batch in batches:
            for record_id, url, html, sha, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sha = base64.b32encode(bytes.fromhex(sha)).decode()
                # The record that opens a bundle names it: the same in every run of the task.
                name = record_id.removeprefix("urn:page:") if name is None else name
                writer.add(record_id, record(record_id, url, html, sha, refers_to))
                if writer.size >= bundle_bytes:
                    yield closed()
                    writer, name = BundleWriter(frame_bytes), None
        if name is not None:
            yield closed()

    marked.mapInArrow(pack, BUNDLE_SCHEMA).write.parquet(path)


def read_records(bundles: DataFrame, record_ids: Sequence[str] | None = None) -> DataFrame:
    """The records of a table of bundles, all or those named, by way of index and seek table."""
    wanted = None if record_ids is None else frozenset(record_ids)

    def unpack(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("record_id", pa.string()),
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("record_type", pa.string()),
                ("payload_digest", pa.string()),
                ("refers_id", pa.string()),
                ("refers_to", pa.int64()),
                ("payload", pa.binary()),
            ]
        )

        def number(urn):
            page = "none" if urn is None else urn.split(":")[2]
            return None if page == "none" else int(page)

        for batch in batches:
            for data, index in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, rows, held, now, plain = BundleReader(data), [], 0, None, b""
                for x in index:
                    if wanted is not None and x["record_id"] not in wanted:
                        continue
                    if x["frame"] != now:
                        now, plain = x["frame"], reader.frame(x["frame"])
                    got = parse(plain[x["start"] : x["start"] + x["length"]])
                    if got["warc-record-id"] != f"<{x['record_id']}>":
                        raise ValueError("the index points at another record")
                    refers_id = got.get("warc-refers-to", "").strip("<>") or None
                    rows.append(
                        {
                            "record_id": x["record_id"],
                            "page_id": number(x["record_id"]),
                            "url": got.get("warc-target-uri"),
                            "record_type": got["warc-type"],
                            "payload_digest": got["warc-payload-digest"].removeprefix("sha1:"),
                            "refers_id": refers_id,
                            "refers_to": number(refers_id),
                            "payload": got["block"],
                        }
                    )
                    held += len(got["block"])
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return bundles.select("data", "index").mapInArrow(unpack, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as bundles in the shared folder and read what the archives say.

    A revisit takes size and full digest from the response that it refers to,
    which is checked against its own digest header.
    """
    spark = pages.sparkSession
    path = f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    write_bundles(pages, path, min_bytes)
    bundles = spark.read.parquet(path)
    records = read_records(bundles).select(
        "record_id",
        "page_id",
        F.octet_length("payload").cast("long").alias("own"),
        "payload_digest",
        "record_type",
        "refers_id",
        "refers_to",
    )
    full = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("own").alias("full"), F.col("payload_digest").alias("digest")
    )
    # Responses name no other record and stay out of the join, where their nulls would share a key.
    visits = records.filter("record_type = 'revisit'").join(full, "refers_id", "left")
    wrong = F.raise_error(F.lit("a revisit refers to another payload")).cast("long")
    size = F.when(F.col("digest") == F.col("payload_digest"), F.col("full")).otherwise(wrong)
    rows = records.filter("record_type = 'response'").unionByName(visits.withColumn("own", size).select(*records.columns))
    return rows.withColumnRenamed("own", "payload_bytes").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"
    )
