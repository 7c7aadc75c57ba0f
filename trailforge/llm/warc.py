"""WARC archives as seekable Zstandard bundles.

write(): each partition becomes one bundle `part-NNNNN.warc.zst` in a shared folder: WARC/1.1 records are grouped into
independent Zstandard frames (a frame closes at FRAME_BYTES), and the seek table of the Zstandard seekable format (a
skippable frame of compressed and decompressed sizes) is the footer. The returned index maps each record to its bundle,
frame and the offset and length inside that frame. A bundle is written under a name of its own task attempt and then
renamed, so that a repeated task leaves the same file.

read(): the seek table gives each frame's place; only the frames that the index asks for are fetched and decompressed.

Records with equal payloads (SHA-256) of at least `least` bytes: that with the smallest page_id is a response, the
others are revisits that refer to it.

Defined cases: null html is an empty payload (a response); null page_id never becomes the referred record unless all of a
group are null (then all are responses); repeated rows of the first page_id are all responses; an empty table gives no
records. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, new_path, slices, written

FRAME_BYTES = 1 << 20
LEAST = 100
SALTS = 16
FEW = 100_000
# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = "page_id long, bundle string, frame int, start int, length int"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def typed(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, digest, n_bytes, refers_to (null for responses).

    Groups of copies are counted on digests alone and written. FEW groups at most are broadcast, and no page leaves its task;
    beyond, pages and groups meet by a shuffle on digest and salt."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(raw, 256).alias("digest"), F.octet_length(raw).cast("long").alias("n_bytes"))
    found = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    copied = written(found.where("n > 1").select("digest", "first"), "warc-copied")
    if copied.count() <= FEW:
        met = rows.join(F.broadcast(copied), "digest", "left")
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
        copied = copied.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        met = rows.join(copied, ["digest", "salt"], "left")
    return met.select("page_id", "url", "html", "digest", "n_bytes", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit has no payload but its digest and length."""
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    found = dict((k.lower(), v) for k, _, v in (x.partition(": ") for x in lines[1:]))
    block = rest[: int(found["content-length"])]
    return found | {"payload": block.partition(b"\r\n\r\n")[2]}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frame_places(file) -> list[tuple[int, int, int]]:
    """Offset, compressed and decompressed size of each frame, from the footer of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * n)
    places, at = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * n)):
        places.append((at, packed, plain))
        at += packed
    return places


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        bundle = f"part-{task.partitionId():05d}.warc.zst"
        temporary = f"{root}/.{bundle}.{task.taskAttemptId()}"
        out, frames, held, size, rows = None, [], [], 0, []
        packer = zstandard.ZstdCompressor(level=3)

        def close_frame():
            nonlocal held, size
            packed = packer.compress(b"".join(held))
            out.write(packed)
            frames.append((len(packed), size))
            held, size = [], 0

        for batch, htmls in slices(batches, "html"):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(temporary)
            for html, page_id, url, digest, refers_to in zip(htmls, *(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")), strict=True):
                data = record(page_id, url, (html or "").encode(), digest, refers_to)
                rows.append((page_id, bundle, len(frames), size, len(data)))
                held.append(data)
                size += len(data)
                if size >= FRAME_BYTES:
                    close_frame()
        if out is None:
            return
        if held:
            close_frame()
        out.write(seek_table(frames))
        out.close()
        if fs.get_file_info(f"{root}/{bundle}").type != pyarrow.fs.FileType.NotFound:
            fs.delete_file(f"{root}/{bundle}")
        fs.move(temporary, f"{root}/{bundle}")
        schema = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("start", pa.int32()), ("length", pa.int32())])
        for i in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 10_000], strict=True), schema.types, strict=True)], schema=schema)

    return write


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write the bundles into folder (a URI that pyarrow's file systems know) and return the index, itself a written table."""
    return written(in_arrow(typed(pages, least).sortWithinPartitions("page_id"), _writer(folder), INDEX), "warc-index")


def read(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the index, read from the bundles: its own headers and the digest of the payload found there."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, file, places, number, plain = None, None, [], -1, b""
        for batch in batches:
            out = []
            for bundle, frame, start, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "start", "length")), strict=True):
                if bundle != name:
                    name, file, number = bundle, fs.open_input_file(f"{root}/{bundle}"), -1
                    places = frame_places(file)
                if frame != number:
                    at, packed, size = places[frame]
                    file.seek(at)
                    number, plain = frame, zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)
                x = parse(plain[start : start + length])
                revisit = x["warc-type"] == "revisit"
                said = x["warc-payload-digest"].removeprefix("sha256:")
                found = said if revisit else hashlib.sha256(x["payload"]).hexdigest()
                if found != said:
                    raise ValueError(f"{bundle}: the payload of {x['warc-record-id']} has another digest than its header")
                ids = [None if v is None or v[10:-1] == "null" else int(v[10:-1]) for v in (x["warc-record-id"], x.get("warc-refers-to"))]
                out.append((ids[0], int(x["warc-payload-length"]) if revisit else len(x["payload"]), found, x["warc-type"], ids[1], *([x["payload"]] if payloads else [])))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.binary()] if payloads else [])]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return in_arrow(index, fetch, RECORDS + (", payload binary" if payloads else ""))


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write pages and read them back."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return read(write(pages, folder, least), folder)
