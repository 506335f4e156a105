import struct
import zlib

import zstandard

from casestar.llm import warc_zstd as W
from casestar.session import scratch_path

SCHEMA = "page_id long, url string, html string, extra int, payload string"


def pages(spark):
    rows = [(3, "http://a", "<p>x</p>", 1, "p"), (1, "http://b", "<p>x</p>", 1, "p"), (2, None, None, 1, "p"),
            (4, "http://c", "", None, None), (None, "u", "<p>x</p>", 1, "p"), (None, "u", "lone", 1, "p"),
            (5, "http://\nd", "é" * 70_000, 1, "p"), (6, "e", "\r\n\r\nWARC/1.1\r\n", 1, "p"), (6, "e", "\r\n\r\nWARC/1.1\r\n", 1, "p")]
    return spark.createDataFrame(rows, SCHEMA)


def test_report(spark):
    got = {(r.page_id, r.payload_bytes): r for r in W.archive_report(pages(spark)).collect()}
    assert got[1, 8].record_type == "response" and got[1, 8].refers_to is None
    assert got[3, 8].record_type == "revisit" and got[3, 8].refers_to == 1
    assert got[None, 8].refers_to == 1 and got[None, 4].record_type == "response"
    assert got[2, 0].record_type == "response" and got[4, 0].refers_to == 2
    assert got[2, 0].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert got[5, 140_000].record_type == "response"
    assert W.archive_report(pages(spark)).count() == 9
    assert W.archive_report(pages(spark).limit(0)).collect() == []


def test_round_trip_and_format(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/pages.parquet")
    path = scratch_path(spark, "warc_test")
    W.write_archives(df, path)
    back = {r.page_id: r for r in W.read_archives(spark, path).collect()}
    for r in df.collect():
        assert bytes(back[str(r.page_id)].payload) == r.html.encode()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).collect()
    data = bytes(files[0].content)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    # records are frames of their own: the first one opens without the others
    d = zstandard.ZstdCompressionDict(data[8:8 + size])
    at = 8 + size + len(W.EMPTY_FRAME)
    first = zstandard.ZstdDecompressor(dict_data=d).decompressobj().decompress(data[at:at + 200_000])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    plain = sum(len(zlib.compress(r.html.encode())) for r in df.collect())
    assert sum(len(f.content) for f in files) < plain + 64 * 1024 * len(files)


def test_a_damaged_payload_is_noticed(spark):
    record = W.make_record("1", "u", b"abc", 3, W.base32_sha1(b"abd"), None)
    frames = b"".join(f + W.EMPTY_FRAME for f in W.compress_archive(iter([record])))
    head, block = next(W.parse_records(W.open_archive(frames)))
    assert block.endswith(b"abc") and head["WARC-Payload-Digest"] != "sha1:" + W.base32_sha1(b"abc")


def test_dictionary_covers_a_sample_and_all_records_are_written():
    records = [W.make_record(str(i), "u", (b"text %d " % i) * 50, 1, "D", None) for i in range(500)]
    frames = list(W.compress_archive(iter(records), sample_bytes=20_000))
    assert len(frames) == 501
    assert [h["X-Page-Id"] for h, _ in W.parse_records(W.open_archive(W.EMPTY_FRAME.join(frames)))] == list(map(str, range(500)))
    assert list(W.compress_archive(iter([]))) == []


def test_ids_with_line_ends(spark):
    """An id cannot add headers to its record."""
    ids = ["a\r\nX-Refers-To-Page: z", "100 %", "é\x00", ""]
    df = spark.createDataFrame([(i, f"u{n}", "same" if n < 2 else str(n)) for n, i in enumerate(ids)],
                               "page_id string, url string, html string")
    got = {r.page_id: r for r in W.archive_report(df).collect()}
    assert set(got) == set(ids)
    assert got["100 %"].record_type == "response" and got[ids[0]].refers_to == "100 %"
    assert all(got[i].refers_to is None for i in ids[1:])
