"""WARC archives as seekable Zstandard bundles: files in the shared folder, with an index written along with them.

A bundle is one archive: independent Zstandard frames, each of whole WARC records, and behind them a skippable
frame with the seek table (the public seekable format: compressed and decompressed size of each frame, then
the number of frames, a descriptor byte and the magic number). A record is found by archive, frame and its
offset in the decompressed frame, so a lookup decompresses one frame. Spark's own writers put the files down, on
any store, and its commit keeps what lost executors left half done from being seen.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import lean, materialise, scratch, shared_folder, sifted

#: Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = "archive string, content binary, entries array<struct<page_id: long, frame: int, offset: long, length: long>>"
RECORDS = "page_id long, archive string, frame int, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Bundle:
    """Collects records into frames of about frame_bytes, and gives the archive's bytes."""

    def __init__(self, frame_bytes: int, level: int = 3) -> None:
        self.frame_bytes, self.coder = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.open: list[bytes] = []
        self.entries: list[dict[str, int | None]] = []
        self.open_bytes = self.raw = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        self.entries.append({"page_id": page_id, "frame": len(self.frames), "offset": self.open_bytes, "length": len(record)})
        self.open.append(record)
        self.open_bytes += len(record)
        self.raw += len(record)
        if self.open_bytes >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            self.parts.append(packed := self.coder.compress(b"".join(self.open)))
            self.frames.append((len(packed), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def close(self) -> bytes:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(self.parts) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer."""
    n, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the archive")
    out, start = [], 0
    for i in range(n):
        packed, raw = struct.unpack_from("<II", content, len(content) - 9 - 8 * (n - i))
        out.append((start, packed, raw))
        start += packed
    return out


def frame(content: bytes, at: tuple[int, int, int]) -> bytes:
    start, packed, raw = at
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=raw) if raw else b""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response with HTTP block, or a revisit without payload."""
    name = lambda x: f"<urn:page:{'none' if x is None else x}>"
    uri = "".join(c if 32 < ord(c) != 127 else f"%{ord(c):02X}" for c in url or "") or "about:blank"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is not None:
        head += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", name(refers_to))]
        payload = b""
    block = http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload of the record at an offset, and the next record's offset."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = raw[end + 4 : (stop := end + 4 + int(head["Content-Length"]))]
    return head, block[block.index(b"\r\n\r\n") + 4 :], stop + 4


def _number(name: str) -> int | None:
    tail = name[:-1].rpartition(":")[2]
    return None if tail == "none" else int(tail)


def first_seen(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, url, payload, digest, refers_to: null for responses, else the smallest page_id with that payload.

    Payloads are told apart by digest in narrow rows. Pages that are certainly no revisits are not moved; the others are looked up.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = lean(pages).select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    narrow = materialise(own.where(F.octet_length("payload") >= least).select("page_id", "digest"))
    seen = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").drop("n")
    revisits = materialise(narrow.join(seen, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct())
    key = F.xxhash64("page_id", "digest")
    own = sifted(own, key, revisits.select(key), "maybe")
    asked = own.where("maybe").drop("maybe")
    found = asked.join(revisits.withColumnsRenamed({"page_id": "rid", "digest": "rd"}), F.col("page_id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rd")), "left").drop("rid", "rd")
    return own.where("not maybe").drop("maybe").withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)


def bundles(pages: DataFrame, least: int = 100, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 22, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archives of one record per row of pages (page_id, url, html), as rows of BUNDLES, kept in the shared folder.

    Of records with equal payloads of at least `least` bytes the one with the smallest page_id holds it, the others
    revisit it; a row that repeats that page_id is a response too. Null html is an empty payload, a null url is
    about:blank, null page_ids never hold for others. An empty table makes no archive. Other columns are ignored.
    A record is never split: one above the frame's size has a frame of its own.
    """

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, bundle = TaskContext.get().partitionId(), 0, Bundle(frame_bytes)
        kind = pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))

        def done() -> pa.RecordBatch:
            content = bundle.close()
            return pa.RecordBatch.from_arrays([pa.array([f"part-{part:06d}-{n:04d}.warc.zst"]), pa.array([content], pa.binary()), pa.array([bundle.entries], kind)], ["archive", "content", "entries"])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                bundle.add(page_id, record(page_id, url, payload, digest, refers_to, date))
                if bundle.raw >= bundle_bytes:
                    yield done()
                    n, bundle = n + 1, Bundle(frame_bytes)
        if bundle.raw:
            yield done()

    return materialise(first_seen(pages, least).mapInArrow(bundled, BUNDLES))


#: The last byte of every archive, that of SEEKABLE.
_LAST = chr(SEEKABLE >> 24)


def store(pages: DataFrame, folder: str, **how: int | str) -> None:
    """Write the archives of bundles() as files <folder>/archives/archive=<name>/*, and their index as Parquet, <folder>/index.

    Spark's text writer puts bytes down as they are and ends each row with a separator, for which an archive's last byte is taken.
    """
    with scratch(pages.sparkSession):
        made = bundles(pages, **how)
        body = F.substring("content", F.lit(1), F.octet_length("content") - 1).cast("string")
        made.select("archive", body.alias("value")).write.partitionBy("archive").option("lineSep", _LAST).option("encoding", "ISO-8859-1").text(f"{folder}/archives")
        made.select("archive", F.explode("entries").alias("e")).select("e.page_id", "archive", "e.frame", "e.offset", "e.length").write.parquet(f"{folder}/index")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, content) of the files that store() wrote."""
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    # Files that begin with "." or "_" are no archives; where there is none, there is no folder of one either.
    return files.option("recursiveFileLookup", "true").load(f"{folder}/archives").select(F.regexp_extract("path", "/archive=([^/]*)/", 1).alias("archive"), "content").where("archive <> ''")


def offsets(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, archive, frame, offset, length) of every record, from the index that store() wrote."""
    return spark.read.parquet(f"{folder}/index")


def write(pages: DataFrame, **how: int | str) -> DataFrame:
    """store() in a new folder of the shared one, and the archives() in it. The folder stays, since they are read later."""
    spark = pages.sparkSession
    store(pages, folder := f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}", **how)
    return archives(spark, folder)


def read(archives: DataFrame) -> DataFrame:
    """Every record of the archives, as RECORDS: where it lies, and what it says. Responses' digests are checked."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out: list[tuple] = []
                content = content.as_py()
                for i, at in enumerate(seek_table(content)):
                    raw, here = frame(content, at), 0
                    while here < len(raw):
                        head, payload, end = parse(raw, here)
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(head["X-Payload-Length"])):
                            raise ValueError(f"{archive}: {head['WARC-Record-ID']} is damaged")
                        out.append((_number(head["WARC-Record-ID"]), archive, i, here, end - here, int(head["X-Payload-Length"]), digest, kind, _number(head["WARC-Refers-To"]) if kind == "revisit" else None))
                        here = end
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in RECORDS.split(", ")])

    return archives.select("archive", "content").mapInArrow(records, RECORDS)


def lookup(archives: DataFrame, found: DataFrame) -> DataFrame:
    """page_id, payload of the records at (archive, frame, offset) of `found`. An archive's records are asked for together, each of their frames decompressed once."""

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(*batch.columns, strict=True):
                content, at, raw = content.as_py(), None, b""
                table = seek_table(content)
                for x in sorted(asked.as_py(), key=lambda x: (x["frame"], x["offset"])):
                    if x["frame"] != at:
                        at, raw = x["frame"], frame(content, table[x["frame"]])
                    yield pa.RecordBatch.from_pydict({"page_id": pa.array([x["page_id"]], pa.int64()), "payload": pa.array([parse(raw, x["offset"])[1]], pa.binary())})

    asked = found.groupBy("archive").agg(F.collect_list(F.struct("page_id", "frame", "offset")).alias("asked"))
    return lean(archives).select("archive", "content").join(asked, "archive").select("content", "asked").mapInArrow(payloads, "page_id long, payload binary")


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive to a folder that all executors mount, under a name that appears when it is whole."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with open(f"{folder}/.{archive}.{os.getpid()}", "wb") as f:
                    f.write(content.as_py())
                os.replace(f.name, f"{folder}/{archive}")
                yield pa.RecordBatch.from_pydict({"archive": [archive], "bytes": pa.array([os.path.getsize(f"{folder}/{archive}")], pa.int64())})

    return archives.select("archive", "content").mapInArrow(put, "archive string, bytes long")
