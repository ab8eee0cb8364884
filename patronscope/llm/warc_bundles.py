"""WARC archives as seekable Zstandard bundles: independent frames of records, a seek table at the end of each file.

A bundle follows the seekable Zstandard format: frames that can be decompressed alone, then a skippable frame with the
compressed size, the size and the checksum of each. Any Zstandard tool reads it as one stream; with the seek table, a
record is read by decompressing its frame alone. Archives are written and read by Spark's own file sources, so they may
lie in any store, and a task that is tried again leaves no half-written file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .staging import staged

#: Records are gathered until a frame holds so many bytes; one longer record is a frame of its own.
FRAME_BYTES = 1 << 18
#: Frames are gathered until a bundle holds so many compressed bytes. A bundle is one file and one row of a task.
BUNDLE_BYTES = 32 << 20
LEVEL = 3
#: Fixed values of the formats: skippable and seekable magic numbers, descriptor of a seek table with checksums.
SKIPPABLE, SEEKABLE, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The last bytes of every bundle. Spark's text writer puts them after the only row of a file, as its line separator.
_TAIL = struct.pack("<BI", WITH_CHECKSUMS, SEEKABLE)
_ID = "urn:page:"

RECORD = ("file string, frame int, frame_start bigint, frame_bytes bigint, offset bigint, length bigint, record_id string, record_type string, "
          "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None).encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header of the full payload, and no payload."""
    own = f"{_ID}{'' if page_id is None else page_id}"
    block = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    if refers_to is None:
        block += payload
    target = own if url is None else re.sub("[\\x00-\\x20\\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = _fields([
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{own}>"), ("WARC-Date", date),
        ("WARC-Target-URI", target), ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<{_ID}{refers_to}>"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Frames of whole records, then the seek table without its last bytes (``_TAIL``)."""

    def __init__(self, frame_bytes: int):
        import zstandard

        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=LEVEL)
        self.clear()

    def clear(self) -> None:
        self.frames, self.table, self.open, self.open_bytes, self.size = [], [], [], 0, 0

    def add(self, one: bytes) -> None:
        if self.open and self.open_bytes + len(one) > self.frame_bytes:
            self.cut()
        self.open.append(one)
        self.open_bytes += len(one)

    def cut(self) -> None:
        import xxhash

        data = b"".join(self.open)
        frame = self.compressor.compress(data)
        self.frames.append(frame)
        self.table.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open, self.open_bytes, self.size = [], 0, self.size + len(frame)

    def close(self) -> bytes:
        if self.open:
            self.cut()
        entries = b"".join(self.table)
        head = struct.pack("<II", SKIPPABLE, len(entries) + 9)
        found = b"".join([*self.frames, head, entries, struct.pack("<I", len(self.table))])
        self.clear()
        return found


def seek_table(content: bytes) -> list[tuple[int, int, int, int]]:
    """(start, compressed size, size, checksum) of each frame of a bundle."""
    if not content:
        return []
    count, descriptor, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE or descriptor != WITH_CHECKSUMS:
        raise ValueError("not a seekable bundle with checksums")
    entries = content[-9 - 12 * count:-9]
    if struct.unpack("<II", content[-17 - 12 * count:-9 - 12 * count]) != (SKIPPABLE, len(entries) + 9):
        raise ValueError("the seek table is damaged")
    table, start = [], 0
    for packed, size, checksum in struct.iter_unpack("<III", entries):
        table.append((start, packed, size, checksum))
        start += packed
    return table


def open_frame(content: bytes, entry: tuple[int, int, int, int]) -> bytes:
    import xxhash
    import zstandard

    start, packed, size, checksum = entry
    data = zstandard.ZstdDecompressor().decompress(content[start:start + packed], max_output_size=max(size, 1))
    if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame is damaged")
    return data


def parse(data: bytes, at: int) -> tuple[int, tuple]:
    """The record that starts at ``at``: its end, and what ``RECORD`` has from record_id on. Digests are verified."""
    cut = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:cut].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a record")
    head = dict(line.split(": ", 1) for line in lines)
    begin, size = cut + 4, int(head["Content-Length"])
    block = data[begin:begin + size]
    if data[begin + size:begin + size + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, payload = block.split(b"\r\n\r\n", 1)
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    full = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    response = head["WARC-Type"] == "response"
    if response and (len(payload) != full or base32_sha1(payload) != digest):
        raise ValueError("a payload differs from its digest")
    refers = head.get("WARC-Refers-To")
    found = (head["WARC-Record-ID"][1:-1], head["WARC-Type"], head["WARC-Target-URI"], refers and refers[1:-1], digest, full,
             payload if response else None)
    return begin + size + 4, found


def judged(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to: of equal payloads of ``min_payload`` bytes or more all but the row with the
    largest page_id refer to it.

    A null html is an empty payload. Rows that repeat the largest page_id are all responses. A null page_id is smaller than
    every other; rows of a payload that has null ids only are all responses. A shared payload is one row of the table
    of copies, however many pages have it, and that table is written first, so that adaptive execution may split the join.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    copies = rows.where(F.octet_length("payload") >= min_payload).groupBy("digest").agg(
        F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "top")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("top")), None).otherwise(F.col("top"))
    return rows.join(staged(copies, "copies"), "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_payload: int = 0, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row of ``pages`` (page_id, url, html) to bundles in the folder ``path``.

    ``judged`` says which rows are responses. Other columns are not stored. A null url gives the record's own id as target;
    control characters and blanks of an url are percent-encoded. A table without rows gives a folder without records.
    """
    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(frame_bytes)
        row = lambda: pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], ["bundle"])
        for batch in batches:
            for one in zip(*(batch.column(n) for n in ("page_id", "url", "payload", "refers_to"))):
                page_id, url, payload, refers_to = (x.as_py() for x in one)
                bundle.add(record(page_id, url, payload, base32_sha1(payload), refers_to, date))
                if bundle.size >= bundle_bytes:
                    yield row()
        if bundle.open or bundle.frames:
            yield row()

    bundles = judged(pages, min_payload).mapInArrow(bundled, "bundle binary").select(F.col("bundle").cast("string").alias("value"))
    (bundles.write.option("maxRecordsPerFile", 1).option("compression", "none").option("encoding", "ISO-8859-1")
     .option("lineSep", _TAIL.decode("latin-1")).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4, *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [part.split()[0] for part in RECORD.split(", ")]
    columns = list(zip(*found)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _frame_rows(file: str, content: bytes, k: int, entry: tuple, payloads: bool) -> list[tuple]:
    data, at, found = open_frame(content, entry), 0, []
    while at < len(data):
        end, fields = parse(data, at)
        found.append((file, k, entry[0], entry[1], at, end - at, *fields[:-1], fields[-1] if payloads else None))
        at = end
    return found


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles in ``path``, with its place (``RECORD``): file, number, start and compressed size of its
    frame, and its offset and length within the decompressed frame. Frames are checked against the seek table, payloads
    against their digests. Without ``payloads`` that column is null."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                content = content.as_py()
                for k, entry in enumerate(seek_table(content)):
                    yield _rows(_frame_rows(file, content, k, entry, payloads))

    return _files(spark, path).mapInArrow(read, RECORD)


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """record_id and the place of each record: what a reader needs to fetch it with one read and one frame."""
    return read_records(spark, path, payloads=False).select("record_id", "file", "frame", "frame_start", "frame_bytes", "offset", "length")


def fetch(spark: SparkSession, path: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose record_id is in ``ids``, as ``read_records`` has them. Only frames that hold one are decompressed."""
    wanted = index.join(ids.select("record_id").distinct(), "record_id").groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("frame", "offset"))).alias("places"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table, places = seek_table(row["content"]), {(p["frame"], p["offset"]) for p in row["places"]}
                for k in sorted({frame for frame, _ in places}):
                    yield _rows([r for r in _frame_rows(row["file"], row["content"], k, table[k], True) if (k, r[4]) in places])

    return _files(spark, path).join(wanted, "file").mapInArrow(read, RECORD)


def page_id(record_id: str):
    """The page_id that a record id names, as a column; null for the id of a page without one."""
    return F.expr(f"try_cast(substring({record_id}, {len(_ID) + 1}) AS BIGINT)")


def restored(records: DataFrame) -> DataFrame:
    """page_id, target_uri and html of every page, revisits resolved to the payload of the response they refer to."""
    full = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload").alias("full")).dropDuplicates(["refers_to"])
    found = records.join(full, "refers_to", "left")
    return found.select(page_id("record_id").alias("page_id"), "target_uri", F.decode(F.coalesce("payload", "full"), "UTF-8").alias("html"))


def _base32(hexadecimal: str) -> str:
    """SQL: eight groups of five hexadecimal digits give four letters each."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letter = lambda g, shift: (f"substr('{alphabet}', 1 + ((('0x' || substr({hexadecimal}, {5 * g + 1}, 5))::INT >> {shift}) & 31), 1)")
    return " || ".join(letter(g, shift) for g in range(8) for shift in (15, 10, 5, 0))


def oracle_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, {_base32('hex')} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM d
"""
