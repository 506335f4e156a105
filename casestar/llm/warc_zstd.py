"""WARC archives with dictionary-compressed records.

Every Spark partition writes one archive. It gathers the first
``SAMPLE_BYTES`` of its records, builds a Zstandard dictionary from them, puts
the dictionary in front in a skippable frame, and compresses each record as a
frame of its own, so a record can be read alone. The archives go through
Spark's text writer (the bytes of a row, then an empty skippable frame in place
of the line end), hence to any storage Spark can write, with its commit of whole
tasks: a lost executor leaves no partial archive. They are read back with
Spark's binary file source.

Of records with equal payloads that with the smallest page_id is a response and
carries the payload; the others are revisits that name it.

Edge cases: a null html is an empty payload; empty payloads are compared like
others; a null page_id comes after all others, and payloads found under null ids
only are all responses; rows alike in page_id and payload have one type, so
repeated responses are all kept; a null url is an empty one; an empty table
gives no archive. Payloads are kept whole, however long (a record must fit in a task's
memory). An id with line ends or other special characters is percent-encoded in the
headers and read back as it was. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.session import scratch_path

SAMPLE_BYTES = 4 << 20      # records of an archive that its dictionary is built from
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DICTIONARY_MAGIC = 0x184D2A5D       # fixed by the format: the leading dictionary frame
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)     # a skippable frame without content
DATE = "1970-01-01T00:00:00Z"       # records carry a fixed date, so reruns agree


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def encoded(page_id: str) -> str:
    """An id as a header value: line ends and whatever is not plain are percent-encoded."""
    return quote(page_id, errors="surrogatepass")


def make_record(page_id: str | None, url: str, payload: bytes | None, size: int, digest: str,
                refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has headers only (``payload`` is not looked at)."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id or "", digest)), ("WARC-Date", DATE),
            ("WARC-Target-URI", " ".join(url.split())), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
            ("X-Payload-Bytes", str(size))]
    if page_id is not None:
        head.append(("X-Page-Id", encoded(page_id)))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", encoded(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed archive."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            k, _, v = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            head[k] = v
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        yield head, block


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the records; from too few to train, their own bytes serve."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:DICTIONARY_BYTES].ljust(8, b"\0"),
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def compress_archive(records: Iterator[bytes], sample_bytes: int = SAMPLE_BYTES) -> Iterator[bytes]:
    """The dictionary's frame, then a frame per record."""
    sample, size = [], 0
    for r in records:
        sample.append(r)
        size += len(r)
        if size >= sample_bytes:
            break
    if not sample:
        return
    d = build_dictionary(sample)
    raw = d.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d)
    for r in sample:
        yield c.compress(r)
    for r in records:
        yield c.compress(r)


def open_archive(data: bytes):
    """A stream of an archive's uncompressed records."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    d = zstandard.ZstdCompressionDict(data[8:8 + size])
    return io.BufferedReader(zstandard.ZstdDecompressor(dict_data=d).stream_reader(
        data, read_across_frames=True), 1 << 20)


def record_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, bytes, sha1, refers_to); html is null for a revisit."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    df = pages.select(F.col("page_id").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    df = df.withColumn("sha1", F.sha1("html"))
    copies = df.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter(
        "n > 1").select("sha1", "first")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    typed = df.join(copies, "sha1", "left").withColumn("refers_to", refers)
    return typed.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"),
                        F.octet_length("html").cast("long").alias("bytes"), "sha1", "refers_to")


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` as archives below ``path`` (part-*.warc.zst)."""
    typed = record_types(pages).select(
        F.col("page_id").cast("string"), "url", "html", "bytes", F.unhex("sha1"), F.col("refers_to").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for b in batches:
                for i in range(b.num_rows):
                    page, url, html, size, sha1, refers = (b.column(k)[i].as_py() for k in range(6))
                    yield make_record(page, url, html, size, base64.b32encode(sha1).decode(), refers)

        out, held = [], 0
        for frame in compress_archive(records()):
            out.append(frame)
            held += len(frame)
            if held >= SAMPLE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    frames = typed.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.mode("overwrite").option("lineSep", EMPTY_FRAME.decode("ascii")).option(
        "compression", "none").text(path)
    _name_archives(pages.sparkSession, path)


def _name_archives(spark: SparkSession, path: str) -> None:
    """Give the written files their usual ending."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.startswith("part-") and name.endswith(".txt"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(folder, name[:-4] + ".warc.zst"))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``: page_id (as text), url, record_type,
    payload_bytes, payload_digest, refers_to (as text) and the payload (null for
    a revisit). A response's size and digest are taken from its payload and must
    equal those its header states."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).select("content")
    schema = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, " \
             "refers_to string" + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def rows(data: bytes) -> Iterator[tuple]:
        for head, block in parse_records(open_archive(data)):
            digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Bytes"])
            payload = None
            if head["WARC-Type"] == "response":
                payload = block[block.index(b"\r\n\r\n") + 4:]
                if (len(payload), base32_sha1(payload)) != (size, digest):
                    raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
            page, refers = (v and unquote(v, errors="surrogatepass") for v in (head.get("X-Page-Id"), head.get("X-Refers-To-Page")))
            yield (page, head["WARC-Target-URI"], head["WARC-Type"], size, digest, refers, payload)[:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(
                names, zip(*held, strict=True), strict=True)], names=names)

        held, size = [], 0
        for b in batches:
            for data in b.column(0):
                if not len(data.as_buffer()):
                    continue
                for r in rows(data.as_py()):
                    held.append(r)
                    size += r[3] + 200
                    if size >= SAMPLE_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return files.mapInArrow(run, schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in shared storage and report what they hold."""
    spark, kind = pages.sparkSession, dict(pages.dtypes)["page_id"]
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
