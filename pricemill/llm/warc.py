"""WARC records in seekable Zstandard bundles, with an index from record to frame and offset.

Records are grouped into frames that are compressed independently.  A bundle is a sequence of frames and, at its end, a
skippable frame with the seek table of the Zstandard seekable format (compressed and decompressed size of every
frame, number of frames, descriptor, magic).  The index maps a record's id to (bundle, frame, offset in the
decompressed frame, length); reading a record needs the seek table and one frame.

Bundles are rows of a table in the shared folder that ``spark.checkpoint.dir`` names.  So they are committed like any
Spark output: a lost executor or a second attempt leaves no part of a bundle.  A row's bytes are a complete file:
written out as it is, any reader of the seekable format opens it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from pricemill.session import checkpoint_dir

FRAME_BYTES = 256 << 10  # a frame is closed once it holds as much
BUNDLE_BYTES = 8 << 20  # a bundle is closed once its frames hold as much, compressed
LEAST_BYTES = 0  # payloads of fewer bytes are never revisits
LEVEL = 3
# fixed values of the Zstandard seekable format
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
CAPTURED = datetime(2020, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of WARC 1.1


def record_id(page_id: int | None, digest: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}/{row}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, row: int, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """A response record with the payload, or a revisit record that names the response and has no payload."""
    kind = "revisit" if revisit else "response"
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A").strip()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest, row)}", f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    if revisit:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}",
            f"X-Refers-To-Page: {'' if refers_to is None else refers_to}",
        ]
    head += [f"X-Page: {'' if page_id is None else page_id}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    body = rest[: int(warc["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    http, _, payload = body.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class Bundle:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, data: bytes):
        frames, descriptor, magic = struct.unpack("<IBI", data[-9:])
        if magic != SEEKABLE_MAGIC or descriptor:
            raise ValueError("not a seekable bundle")
        at, self.data, self.starts = len(data) - 9 - 8 * frames, data, []
        start = 0
        for i in range(frames):
            packed, plain = struct.unpack_from("<II", data, at + 8 * i)
            self.starts.append((start, packed, plain))
            start += packed
        if struct.unpack_from("<II", data, at - 8) != (SKIPPABLE_MAGIC, 8 * frames + 9) or start != at - 8:
            raise ValueError("seek table does not fit the bundle")

    def frame(self, i: int) -> bytes:
        start, packed, plain = self.starts[i]
        return zstandard.ZstdDecompressor().decompress(self.data[start : start + packed], max_output_size=max(1, plain))

    def read(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]


BUNDLES = "bundle string, data binary, records array<struct<id: string, frame: int, offset: int, length: int>>"
ENTRY = pa.struct([("id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])


def _bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    frames: list[bytes] = []
    sizes: list[tuple[int, int]] = []
    index: list[dict] = []
    frame = bytearray()

    def close_frame():
        if frame:
            packed = squeeze.compress(bytes(frame))
            frames.append(packed)
            sizes.append((len(packed), len(frame)))
            frame.clear()

    def close_bundle() -> pa.RecordBatch:
        close_frame()
        data = b"".join(frames) + seek_table(sizes)
        name = hashlib.sha256(data).hexdigest()[:32]
        out = pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([data], pa.binary()), pa.array([index], pa.list_(ENTRY))], names=["bundle", "data", "records"])
        frames.clear(), sizes.clear(), index.clear()
        return out

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "row", "url", "html", "revisit", "refers_to")]
        for page_id, row, url, html, revisit, refers_to in zip(*columns, strict=True):
            payload = (html or "").encode("utf-8", "surrogatepass")
            digest = digest_of(payload)
            raw = record(page_id, row, url, payload, digest, revisit, refers_to)
            index.append({"id": record_id(page_id, digest, row), "frame": len(frames), "offset": len(frame), "length": len(raw)})
            frame += raw
            if len(frame) >= FRAME_BYTES:
                close_frame()
            if sum(s[0] for s in sizes) >= BUNDLE_BYTES:
                yield close_bundle()
    if index:
        yield close_bundle()


def write_bundles(pages: DataFrame, path: str) -> None:
    """Write ``pages(page_id, url, html)`` as a table of bundles at ``path``.

    Of the pages with equal payloads of at least LEAST_BYTES bytes, the one with the largest page_id is the response (a
    null page_id comes below all others) and the others revisit it; of rows that repeat its page_id as well, one is the
    response.  Payloads are compared by SHA-1, as WARC does.
    """
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", "html", F.sha1(payload).alias("_sha"), F.octet_length(payload).alias("_bytes"))
    # the response of each payload that repeats: one row per payload, combined before the shuffle
    largest = pages.where(F.col("_bytes") >= LEAST_BYTES).groupBy("_sha").agg(
        F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
    largest = largest.where("_n > 1").select(F.col("_sha").alias("_of"), "_top")
    joined = pages.join(largest, F.col("_sha") == F.col("_of"), "left")
    turn = Window.partitionBy("page_id", "_sha").orderBy("url")
    ranked = joined.withColumn("row", F.row_number().over(turn) - 1)
    response = F.col("_of").isNull() | (F.col("page_id").eqNullSafe(F.col("_top")) & (F.col("row") == 0))
    ranked.select(
        "page_id", "row", "url", "html", (~response).alias("revisit"), F.when(~response, F.col("_top")).alias("refers_to")
    ).mapInArrow(_bundle, BUNDLES).write.parquet(path)


PARSED = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
    "record_id string, payload binary"
)


def _unbundle(with_payload: bool):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, records in zip(batch.column("data"), batch.column("records"), strict=True):
                bundle = Bundle(data.as_py())
                by_frame: dict[int, list[dict]] = {}
                for entry in records.as_py():
                    by_frame.setdefault(entry["frame"], []).append(entry)
                for number, entries in by_frame.items():
                    plain = bundle.frame(number)
                    rows = []
                    for e in entries:
                        warc, http, payload = parse(plain[e["offset"] : e["offset"] + e["length"]])
                        digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                        if warc["WARC-Record-ID"] != e["id"]:
                            raise ValueError("index points to another record")
                        if warc["WARC-Type"] == "response" and (digest_of(payload) != digest or len(payload) != int(http["Content-Length"])):
                            raise ValueError("payload does not fit its digest")
                        page, refers = warc["X-Page"], warc.get("X-Refers-To-Page")
                        rows.append((
                            int(page) if page else None, int(http["Content-Length"]), digest, warc["WARC-Type"],
                            int(refers) if refers else None, warc["WARC-Target-URI"], e["id"], payload if with_payload else None,
                        ))
                    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                    names = [c.split()[0] for c in PARSED.split(", ")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return read


def read_bundles(df: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of a table of bundles, checked against index, lengths and digests on the way."""
    return df.mapInArrow(_unbundle(with_payload), PARSED)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write every row of ``pages(page_id, url, html)`` to bundles and read them back.

    A null html is the empty payload; a null url an empty target.  Repeated rows get a record each.  An empty table gives
    an empty result; further columns of ``pages`` are ignored.
    """
    spark = pages.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/bundles-{uuid.uuid4().hex}"
    write_bundles(pages, path)
    records = read_bundles(spark.read.schema(BUNDLES).parquet(path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
