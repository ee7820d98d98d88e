"""Seekable Zstandard bundles of WARC records.

Records are grouped into independent Zstandard frames of about ``frame_bytes``.
A bundle's frames, one after the other, are a plain ``.warc.zst`` stream; behind
them stands a seek table in a skippable frame (compressed and raw size of each
frame, and a footer), so that a reader seeks to one frame and decompresses only
that.  The index gives each record's bundle, frame, offset in the frame and length.

A bundle is a row: its name, the bytes of its file, seek table and all, and its index
(frame, offset in the frame and length of each record).  Spark writes the rows, so an
archive lies wherever Spark writes and a lost task is simply run again; a task holds one
bundle of ``BUNDLE_FRAMES`` frames.  Readers find a bundle's frames by its seek table and
cut its records at the indexed offsets; both are checked against what lies there.

Equal payloads are stored once: the smallest page id is a ``response``, the others
are ``revisit`` records that name it.

Rows: null html is an empty payload; a null page id is stored without one and is
a response only if no row with an id has its payload; of repeated page ids with
the payload all with the smallest id are responses; a null url is empty; an
empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType,
                               StructField, StructType)

from .common import ship, slices, written

FRAME_BYTES = 1 << 20
BUNDLE_FRAMES = 16
DATE = "1970-01-01T00:00:00Z"     # the tables hold no capture time

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

RECORD = StructType([StructField("frame", IntegerType()), StructField("page_id", LongType()),
                     StructField("offset", LongType()), StructField("length", LongType())])
BUNDLES = StructType([StructField("bundle", StringType()), StructField("file", BinaryType()),
                      StructField("records", ArrayType(RECORD))])


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _line(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(kind: str, page_id, url: str, size: int, digest: str, payload: bytes, refers_to=None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    head = [f"WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_name(refers_to)}"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def info(bundle: str) -> bytes:
    body = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:bundle:{bundle}>\r\nWARC-Date: {DATE}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame that lists (compressed, raw) sizes of the frames before it."""
    body = b"".join(struct.pack("<II", c, r) for c, r in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of each frame, from a bundle's last bytes."""
    count, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    sizes = struct.iter_unpack("<II", tail[len(tail) - 9 - 8 * count:-9])
    out, at = [], 0
    for c, r in sizes:
        out.append((at, c, r))
        at += c
    return out


def split_records(raw: bytes):
    """(offset, headers, block) of each record of a frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in raw[at:end].decode().split("\r\n")[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield at, head, raw[start:stop]
        at = stop + 4


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, size, sha1, refers_to``: of equal payloads all but the
    smallest id refer to it and drop theirs.  Only payloads seen twice or more
    are in the joined table; a payload with very many copies is one row there,
    and Spark splits its other side.  That table is hashed, so that the payloads
    need not be sorted, which would hold a task's share of them in memory."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload")
                        ).withColumn("sha1", F.sha1("payload"))
    twice = (rows.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and first is not null").select("sha1", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(twice.hint("shuffle_hash"), "sha1", "left")
            .select("page_id", "url", F.octet_length("payload").cast("long").alias("size"), "sha1",
                    F.when(~revisit, F.col("payload")).alias("payload"),
                    F.when(revisit, F.col("first")).alias("refers_to")))


def bundled(rows: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_frames: int = BUNDLE_FRAMES) -> DataFrame:
    """Rows of :func:`deduplicated` as bundles; each task writes its own."""
    ship(rows.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3).compress
        part = TaskContext.get().partitionId()
        bundle, sizes, made = 0, [], []
        raw, body, index = bytearray(), bytearray(), []
        entry = pa.struct([("frame", pa.int32()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])

        def name():
            return f"part-{part:06d}-{bundle:05d}"

        def close_frame():
            nonlocal raw
            packed = squeeze(bytes(raw))
            body.extend(packed)
            sizes.append((len(packed), len(raw)))
            raw = bytearray()

        def close_bundle():
            nonlocal bundle, sizes, body, index
            made.append((name(), bytes(body) + seek_table(sizes), index))
            bundle, sizes, body, index = bundle + 1, [], bytearray(), []

        def take():
            nonlocal made
            cols = list(zip(*made))
            made = []
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(
                cols, (pa.string(), pa.binary(), pa.list_(entry)))], names=BUNDLES.names)

        for batch in batches:
            for piece in slices(batch, "payload"):
                for x in piece.to_pylist():
                    if not raw and not sizes:
                        raw += info(name())
                    kind = "response" if x["refers_to"] is None else "revisit"
                    rec = record(kind, x["page_id"], x["url"], x["size"], base32(x["sha1"]), x["payload"] or b"",
                                 x["refers_to"])
                    index.append({"frame": len(sizes), "page_id": x["page_id"], "offset": len(raw), "length": len(rec)})
                    raw += rec
                    if len(raw) >= frame_bytes:
                        close_frame()
                        if len(sizes) >= bundle_frames:
                            close_bundle()
                if made:
                    yield take()
        if raw:
            close_frame()
        if sizes:
            close_bundle()
        if made:
            yield take()

    return rows.mapInArrow(run, BUNDLES)


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The bundles of ``pages``, written to the shared folder."""
    return written(bundled(deduplicated(pages, id_col, url_col, html_col), frame_bytes), "warc", "none")


def index(bundles: DataFrame) -> DataFrame:
    """``page_id, bundle, frame, offset, length`` of each record (offset within its frame)."""
    return bundles.select("bundle", F.explode("records").alias("r")) \
        .select("r.page_id", "bundle", "r.frame", "r.offset", "r.length")


READ = StructType([
    StructField("page_id", LongType()), StructField("url", StringType()), StructField("record_type", StringType()),
    StructField("refers_to", LongType()), StructField("payload", BinaryType()),
    StructField("payload_bytes", LongType()), StructField("payload_digest", StringType())])


def _id(name: str):
    digits = name[len("<urn:page:"):-1]
    return int(digits) if digits else None


def _parsed(head: dict, block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != stated:
            raise ValueError(f"{head['WARC-Record-ID']}: payload does not match its digest")
        return _id(head["WARC-Record-ID"]), head["WARC-Target-URI"], "response", None, payload, stated, found
    return (_id(head["WARC-Record-ID"]), head["WARC-Target-URI"], "revisit", _id(head["WARC-Refers-To"]), None,
            stated, digest)


def _rows(got: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], k) for i, k in enumerate(kinds)],
                                      names=READ.names)


def _cut(file: bytes, entries: list[dict], plain) -> list[tuple]:
    """The indexed records of one bundle: only their frames are decompressed, found by the
    seek table, and each record is cut out at its offset."""
    table = read_seek_table(file)
    out = []
    by_frame: dict[int, list[dict]] = {}
    for e in entries:
        by_frame.setdefault(e["frame"], []).append(e)
    for frame, own in sorted(by_frame.items()):
        at, packed, size = table[frame]
        raw = plain(file[at:at + packed])
        if len(raw) != size:
            raise ValueError(f"frame {frame}: the seek table says {size} bytes, there are {len(raw)}")
        for e in own:
            (_, head, block), *more = split_records(raw[e["offset"]:e["offset"] + e["length"]])
            if more or _id(head["WARC-Record-ID"]) != e["page_id"]:
                raise ValueError(f"{head['WARC-Record-ID']}: the index says {e['page_id']}")
            out.append(_parsed(head, block))
    return out


def _read(rows: DataFrame) -> DataFrame:
    """Records of rows ``file, records``."""
    ship(rows.sparkSession)

    def run(batches):
        plain = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for piece in slices(batch, "file", 1 << 20, 1):
                for file, entries in zip(piece.column("file").to_pylist(), piece.column("records").to_pylist()):
                    for frame in sorted({e["frame"] for e in entries}):      # a frame's payloads at a time
                        yield _rows(_cut(file, [e for e in entries if e["frame"] == frame], plain))

    return rows.select("file", "records").mapInArrow(run, READ)


def read_archive(bundles: DataFrame) -> DataFrame:
    """Every indexed record of the bundles; payload digests are checked."""
    return _read(bundles)


def read_records(bundles: DataFrame, ids: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records of some pages only: the index names their bundles and frames, and no
    other frame is decompressed."""
    wanted = index(bundles).join(ids.select(F.col(id_col).alias("page_id")).distinct(), "page_id", "left_semi")
    spans = wanted.groupBy("bundle").agg(F.collect_list(F.struct("frame", "page_id", "offset", "length")).alias("records"))
    return _read(bundles.select("bundle", "file").join(spans, "bundle"))


def bundle_file(bundles: DataFrame, name: str) -> bytes:
    """One bundle as the bytes of its ``.warc.zst`` file."""
    return bytes(bundles.filter(F.col("bundle") == name).first().file)
