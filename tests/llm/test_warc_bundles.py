"""WARC bundles: round trip, seek tables, index and revisits, on odd pages too."""

import random
import struct

import pytest
import xxhash
import zstandard
from odd_rows import FOLDER
from pyspark.sql import functions as F

from patronscope.llm import queries, warc_bundles as warc

SCHEMA = "page_id bigint, url string, html string, record_type string, payload int"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("ab <>é\r\n\0日") for _ in range(n))
    rows = [(i, f"http://h/{i}", text(rng.randint(0, 4000))) for i in range(40)]
    rows += [(100 + i, "http://h/same", "<p>\r\n\r\nWARC/1.1\r\n</p>") for i in range(30)]
    rows += [(200, None, None), (201, "", ""), (202, "a b\r\nX: y\té", "x"), (203, "u", text(900_000)), (None, "u", "x"), (None, None, "only without ids"),
             (None, "v", "only without ids"), (204, "u", "twice"), (204, "u", "twice"), (3, "w", "twice")]
    return spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA).repartition(3).cache()


def judged(rows):
    top = {}
    for r in rows:
        if r["page_id"] is not None:
            top[r["html"] or ""] = max(r["page_id"], top.get(r["html"] or "", r["page_id"]))
    own = lambda r: top.get(r["html"] or "")
    return sorted([(str(r["page_id"]), str(None if own(r) == r["page_id"] else own(r)), warc.base32_sha1((r["html"] or "").encode()), len((r["html"] or "").encode()))
                   for r in rows])


@pytest.mark.parametrize("frame_bytes,bundle_bytes", [(1, 1), (3000, 5000), (warc.FRAME_BYTES, warc.BUNDLE_BYTES)])
def test_archives_come_back_whole(spark, odd_pages, tmp_path, frame_bytes, bundle_bytes):
    path = f"{tmp_path}/archives"
    warc.write_archives(odd_pages, path, 0, frame_bytes, bundle_bytes)
    records = warc.read_records(spark, path).cache()
    rows = odd_pages.collect()
    back = records.select(warc.page_id("record_id").alias("page_id"), warc.page_id("refers_to").alias("refers_to"), "payload_digest", "payload_bytes").collect()
    assert sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in back) == judged(rows)
    assert records.where("(record_type = 'revisit') <> (payload IS NULL) OR (record_type = 'revisit') <> (refers_to IS NOT NULL)").count() == 0
    html = warc.restored(records).select("page_id", "html").collect()
    assert sorted((str(r[0]), r[1]) for r in html) == sorted((str(r["page_id"]), r["html"] or "") for r in rows)

    files = [r["content"] for r in spark.read.format("binaryFile").load(path).collect() if r["length"]]
    whole = b""
    for content in files:  # an independent reader: the bundle is one Zstandard stream, its table adds up to its size
        table = warc.seek_table(content)
        assert sum(e[1] for e in table) + 8 + 12 * len(table) + 9 == len(content)
        assert struct.unpack("<I", content[-4:])[0] == 0x8F92EAB1
        for start, packed, size, checksum in table:
            data = zstandard.ZstdDecompressor().decompress(content[start:start + packed], max_output_size=max(size, 1))
            assert xxhash.xxh64_intdigest(data) & 0xFFFFFFFF == checksum
        whole += zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert whole.count(b"\r\nWARC-Record-ID: <urn:page:") == len(rows)

    index = warc.record_index(spark, path)
    wanted = spark.createDataFrame([("urn:page:203",), ("urn:page:105",), ("urn:page:204",), ("urn:page:999",), ("urn:page:203",)], "record_id string")
    got = warc.fetch(spark, path, index, wanted).collect()
    assert sorted(r["record_id"] for r in got) == ["urn:page:105", "urn:page:203", "urn:page:204", "urn:page:204"]
    assert all(r["target_uri"] == "u" for r in got if r["record_id"] != "urn:page:105")
    for r in index.where("frame > 0").limit(5).collect():
        content = next(x["content"] for x in spark.read.format("binaryFile").load(r["file"]).collect())
        data = zstandard.ZstdDecompressor().decompressobj().decompress(content[r["frame_start"]:r["frame_start"] + r["frame_bytes"]])
        assert data[r["offset"]:r["offset"] + r["length"]].startswith(b"WARC/1.1\r\n") and f"<{r['record_id']}>".encode() in data[r["offset"]:]


def test_no_pages_and_smaller_payloads(spark, odd_pages, tmp_path):
    warc.write_archives(odd_pages.limit(0), f"{tmp_path}/none")
    assert warc.read_records(spark, f"{tmp_path}/none").count() == 0 and warc.record_index(spark, f"{tmp_path}/none").count() == 0
    warc.write_archives(odd_pages, f"{tmp_path}/some", min_payload=10)
    short = warc.read_records(spark, f"{tmp_path}/some").where("payload_bytes < 10")
    assert short.count() > 2 and short.where("record_type <> 'response'").count() == 0


def test_damage_is_found(spark, odd_pages, tmp_path):
    warc.write_archives(odd_pages, f"{tmp_path}/a")
    content = max((r["content"] for r in spark.read.format("binaryFile").load(f"{tmp_path}/a").collect()), key=len)
    broken = bytearray(content)
    broken[len(content) // 3] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for entry in warc.seek_table(bytes(broken)):
            warc.open_frame(bytes(broken), entry)
    with pytest.raises(ValueError):
        warc.seek_table(content[:-1])


def test_query_reads_every_page(spark):
    found = queries.queries()["op11_warc_bundles"](spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    assert found.where(F.length("payload_digest") != 32).count() == 0
