"""WARC archives as seekable Zstandard bundles.

Records are grouped into Zstandard frames of bounded size, which are independent of each other. A bundle is one file: the
frames, then two skippable frames, the map of its records (identifier, frame, offset and length within the unpacked frame) and
the seek table of the seekable format (sizes of all frames, packed and unpacked, and a footer). A record is read by
unpacking one frame and cutting it out.

Bundles are written and committed by Spark's text writer, one row a file, so a retried task leaves no
half-written file and any store that Spark reaches will do. The writer ends each row with its line
separator; the separator is set to the four bytes that end a seek table.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the seekable format and of the record format.
SKIPPABLE = 0x184D2A5E
MAP_FRAME = 0x184D2A5D
FOOTER_MAGIC = bytes([0xB1, 0xEA, 0x92, 0x8F])
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are always stored.
MIN_REVISIT_BYTES = 1000
# A frame is closed at this many unpacked bytes, a bundle at this many packed ones; a larger record has one of its own.
FRAME_BYTES = 128 << 10
BUNDLE_BYTES = 4 << 20
# In the map of a bundle, a record without an identifier.
NO_ID = -(1 << 63)
LEVEL = 3
# Pages with equal payloads are joined to their first record in this many parts.
SALTS = 16
WARC_DATE = "2024-01-01T00:00:00Z"

PLACE = "bundle string, frame int, frame_offset long, frame_bytes long, offset long, record_bytes long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          f"refers_to long, {PLACE}")


def with_record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, payload, payload_digest, refers_to): which page a revisit refers to.

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is the
    response; rows that share that id are all responses. A page without an id can only revisit.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
                         F.sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    first = (pages.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 AND keeper IS NOT NULL")
             .select("payload_digest", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(first, ["payload_digest", "salt"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def _uuid(kind: str, digest: str, page_id: int | None) -> str:
    h = hashlib.sha1(f"{kind} {digest} {page_id}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record; a revisit has no block, and keeps the length of its payload in a header."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _uuid(kind, digest, page_id)), ("WARC-Date", WARC_DATE),
               ("WARC-Target-URI", "".join(url.split()) or "about:blank"), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("X-Page-ID", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _uuid("response", digest, refers_to)),
                    ("X-Refers-To-Page-ID", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record that starts at ``at``, and where the next one does."""
    until = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:until].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    end = until + 4 + int(headers["Content-Length"])
    if raw[end: end + 4] != b"\r\n\r\n":
        raise ValueError("a record of the wrong length")
    return headers, raw[until + 4: end], end + 4


def record_map(places: list[tuple[int, int, int, int]]) -> bytes:
    """The skippable frame that maps records (identifier, frame, offset, length) to their places."""
    entries = b"".join(struct.pack("<qIII", *place) for place in places)
    return struct.pack("<II", MAP_FRAME, len(entries)) + entries


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame for frames (packed, unpacked bytes), but for the four bytes that end it."""
    entries = b"".join(struct.pack("<II", packed, unpacked) for packed, unpacked in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IB", len(frames), 0)


def read_seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """Offset, packed and unpacked bytes of each frame, from the end of a bundle."""
    if bundle[-4:] != FOOTER_MAGIC:
        raise ValueError("no seek table")
    count, = struct.unpack_from("<I", bundle, len(bundle) - 9)
    at = len(bundle) - 9 - 8 * count
    frames, offset = [], 0
    for k in range(count):
        packed, unpacked = struct.unpack_from("<II", bundle, at + 8 * k)
        frames.append((offset, packed, unpacked))
        offset += packed
    return frames


def read_record_map(bundle: bytes) -> list[tuple[int, int, int, int]]:
    """Identifier, frame, offset and length of each record, from the end of a bundle; nothing is unpacked."""
    frames = read_seek_table(bundle)
    at = sum(packed for _, packed, _ in frames)
    magic, size = struct.unpack_from("<II", bundle, at)
    if magic != MAP_FRAME:
        raise ValueError("no record map")
    return list(struct.iter_unpack("<qIII", bundle[at + 8: at + 8 + size]))


class _Packer:
    """Records into frames, and frames into a bundle."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes = frame_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.parts, self.frames, self.places, self.size = [], [], [], 0
        self.open, self.open_bytes = [], 0

    def add(self, page_id: int | None, raw: bytes) -> None:
        if self.open and self.open_bytes + len(raw) > self.frame_bytes:
            self.close_frame()
        self.places.append((NO_ID if page_id is None else page_id, len(self.frames), self.open_bytes, len(raw)))
        self.open.append(raw)
        self.open_bytes += len(raw)

    def close_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.parts.append(frame)
            self.frames.append((len(frame), self.open_bytes))
            self.size += len(frame)
            self.open, self.open_bytes = [], 0

    def bundle(self) -> bytes:
        """What there is as a bundle, but for the four bytes that end it; the packer starts anew."""
        self.close_frame()
        out = b"".join([*self.parts, record_map(self.places), seek_table(self.frames)])
        self.parts, self.frames, self.places, self.size = [], [], [], 0
        return out


def _bundles(bundle_bytes: int, frame_bytes: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = _Packer(frame_bytes)
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(
                    batch["page_id"], batch["url"], batch["payload"], batch["payload_digest"], batch["refers_to"], strict=True):
                page_id = None if pd.isna(page_id) else int(page_id)
                packer.add(page_id, record_bytes(page_id, url, bytes(payload), digest, None if pd.isna(refers_to) else int(refers_to)))
                if packer.size >= bundle_bytes:
                    yield pd.DataFrame({"bundle": [packer.bundle()]})
        if packer.places:
            yield pd.DataFrame({"bundle": [packer.bundle()]})
    return pack


def write_bundles(pages: DataFrame, path: str, bundle_bytes: int = BUNDLE_BYTES, frame_bytes: int = FRAME_BYTES) -> None:
    """Write pages (page_id, url, html) as bundle files into a new folder ``path``.

    NULL html is an empty payload, NULL url is written as ``about:blank``; white space within a URL is left out, since
    it would end its header. Repeated rows are records like others. A record is held in memory whole, so it and its
    frame stay below 2 GB, the size of a cell. An empty table gives a folder without bundles.
    """
    # Arrow carries ids that may be missing as text, since a missing long would turn the others into floats.
    typed = with_record_types(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    (typed.mapInPandas(_bundles(bundle_bytes, frame_bytes), "bundle binary")
     .select(F.col("bundle").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", FOOTER_MAGIC.decode("latin-1"))
     .option("maxRecordsPerFile", 1).text(path))


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            for number, (frame_offset, packed, _) in enumerate(read_seek_table(content)):
                raw, at, out = unpacker.decompress(content[frame_offset: frame_offset + packed]), 0, []
                while at < len(raw):
                    headers, block, after = parse_record(raw, at)
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(headers["X-Payload-Length"])
                    if kind == "response":
                        size = len(block)
                        if hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"a payload of {path} does not match its digest")
                    out.append((headers["X-Page-ID"] or None, headers["WARC-Target-URI"], size, digest, kind,
                                headers.get("X-Refers-To-Page-ID"), path, number, frame_offset, packed, at, after - at))
                    at = after
                yield pd.DataFrame(out, columns=[field.split()[0] for field in RECORD.split(", ")])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles in ``path``, read back and checked, with its place.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to, bundle, frame, frame_offset, frame_bytes, offset,
    record_bytes); ``offset`` is that of the record within its unpacked frame. The payload of a response is
    measured; that of a revisit, which is not stored, is what its header says.
    """
    loose = RECORD.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    records = _files(spark, path).mapInPandas(_read, loose)
    return records.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def _read_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            frames = read_seek_table(content)
            rows = [(page_id, path, frame, *frames[frame][:2], offset, size) for page_id, frame, offset, size in read_record_map(content)]
            yield pd.DataFrame(rows, columns=["page_id", *[field.split()[0] for field in PLACE.split(", ")]])


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, bundle, frame, frame_offset, frame_bytes, offset, record_bytes) from the bundles' maps; no frame is unpacked."""
    found = _files(spark, path).mapInPandas(_read_maps, f"page_id long, {PLACE}")
    return found.withColumn("page_id", F.when(F.col("page_id") != NO_ID, F.col("page_id")))


def records_at(bundle: bytes, places: list[tuple[int, int, int, int]]) -> Iterator[bytes]:
    """Blocks of the records at (frame_offset, frame_bytes, offset, record_bytes), sorted; each frame is unpacked once."""
    unpacker, last, raw = zstandard.ZstdDecompressor(), None, b""
    for frame_offset, packed, offset, size in places:
        if frame_offset != last:
            last, raw = frame_offset, unpacker.decompress(bundle[frame_offset: frame_offset + packed])
        yield parse_record(raw[offset: offset + size])[1]


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content, places in zip(batch["content"], batch["places"], strict=True):
            at = [(p["frame_offset"], p["frame_bytes"], p["offset"], p["record_bytes"]) for p in places]
            yield pd.DataFrame({"page_id": [p["page_id"] for p in places], "payload": list(records_at(content, at))})


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Payloads (page_id, payload) of the records ``wanted`` (rows of the map or index); only their frames are unpacked.

    A bundle goes to one task once, whatever the number of its records that are wanted; a revisit's payload is empty.
    """
    place = F.struct("frame_offset", "offset", F.col("page_id").cast("string").alias("page_id"), "frame_bytes", "record_bytes")
    places = wanted.groupBy("bundle").agg(F.sort_array(F.collect_list(place)).alias("places"))
    files = _files(spark, path).withColumnRenamed("path", "bundle").join(places, "bundle").select("content", "places")
    return files.mapInPandas(_cut_out, "page_id string, payload binary").withColumn("page_id", F.col("page_id").cast("long"))
