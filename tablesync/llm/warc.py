"""WARC archives with a Zstandard dictionary: writer and reader.

A task writes its rows as one or more ``.warc.zst`` files. The dictionary of a file is trained
on the records that go into it, compressed, and embedded in a leading skippable frame
(magic 0x184D2A5D); every record is a frame of its own that names the dictionary, so a record
can be read by its offset with nothing but the head of its file. A payload that occurred
before is a ``revisit`` record without a block, which names the response.

Files are written in the shared checkpoint folder under a name of their own per task attempt;
a manifest, written by Spark, lists the files of the attempts that counted. What lost
executors left behind is not listed and never read.

Records are held in memory up to FILE_BYTES of payload, the unit of a file, plus one record.

Defined results: a null or empty payload is a response of 0 bytes; of records alike in
page_id and payload, one counts as the first; a null page_id comes after all others and
refers_to is null if the response has none; headers hold page_id and url percent-encoded; an
empty table writes no files and reads as an empty table.
"""

from __future__ import annotations

import datetime
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import carried, saved, table
from tablesync.session import scratch_dir

#: Payloads of fewer bytes are never stored as a revisit.
REVISIT_BYTES = 100
#: Payload per file, and of that the part its dictionary is trained on.
FILE_BYTES = 32 << 20
TRAIN_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 6
DATE = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

# Fixed values of the formats: the frame that holds a dictionary, a plain Zstandard frame.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"

carried(__name__)


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload binary) with payload_digest, record_type and refers_to.

    The first pages of equal payloads are found on a table of ids and digests; payloads move
    once, by page and digest, so copies of one payload are spread over all tasks.
    """
    digested = pages.withColumn("payload_digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= REVISIT_BYTES
    first = digested.where(long).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = saved(first, "first")
    of_page = digested.where(long).select("page_id", "payload_digest").distinct().join(first, "payload_digest").select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_id"), F.col("payload_digest").alias("_digest"),
        "first_id")
    copy = F.row_number().over(Window.partitionBy("_id", "_digest").orderBy("url"))
    marked = digested.withColumns({
        "_id": F.coalesce(F.col("page_id").cast("string"), F.lit("")), "_digest": F.col("payload_digest")})
    joined = marked.join(saved(of_page, "pages"), ["_id", "_digest"], "left").withColumn("_copy", copy)
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("_copy") == 1)
    known = F.col("first_id").isNotNull() | (long & (F.col("_copy") > 1))
    revisit = known & ~is_first
    return joined.select(
        "page_id", "url", "payload", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def record(page_id: object, url: str | None, payload: bytes, digest: str, kind: str, refers_to: object) -> bytes:
    """One WARC record: headers, block, two line ends."""
    block = b"" if kind == "revisit" else payload
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "text/html"),
        ("Content-Length", len(block)), ("X-Page-Id", "" if page_id is None else page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if kind == "revisit":
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("X-Refers-To-Page-Id", "" if refers_to is None else refers_to)]
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in headers], "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on an even choice of records; None if there is too little to learn."""
    total = sum(map(len, records))
    step = max(1, total // TRAIN_BYTES)
    samples = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES]) if samples else None


def write_file(out, records: list[bytes]) -> None:
    """The dictionary in a skippable frame, then a frame per record."""
    trained = dictionary(records)
    content = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
    out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
    for one in records:
        out.write(compressor.compress(one))


def read_records(file) -> Iterator[bytes]:
    """The records of a file, one at a time."""
    head = file.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start of the archive")
    content = file.read(size)
    if content[:4] == ZSTD_FRAME:
        content = zstandard.ZstdDecompressor().decompress(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    rest = b""
    while True:
        frame, done = decompressor.decompressobj(), False
        parts = []
        while not done:
            if not rest:
                rest = file.read(1 << 20)
                if not rest:
                    if parts:
                        raise ValueError("the archive ends inside a record")
                    return
            parts.append(frame.decompress(rest))
            rest, done = frame.unused_data, frame.eof
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, with names in lower case, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    block = rest[:int(headers["content-length"])]
    if not lines[0].startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, block


def _writer(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        files, base = pafs.FileSystem.from_uri(folder)
        held, size, made = [], 0, []

        def flush() -> None:
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):04d}.warc.zst"
            with files.open_output_stream(f"{base}/{name}") as out:
                write_file(out, held)
            made.append((f"{folder}/{name}", len(held)))

        for batch in batches:
            for row in zip(batch["page_id"], batch["url"], batch["payload"], batch["payload_digest"],
                           batch["record_type"], batch["refers_to"]):
                held.append(record(*row[:2], bytes(row[2]), *row[3:]))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        if made:
            yield pd.DataFrame(made, columns=["path", "n_records"])

    return run


def write_archives(roles: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``with_roles`` as archives; the manifest (path, n_records) of the files."""
    spark = roles.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    full = system.makeQualified(path).toString().replace("file:/", "file:///", 1).replace("file://////", "file:///")
    texts = roles.withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return saved(texts.mapInPandas(_writer(full), "path string, n_records long"), "manifest")


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, n_records in zip(batch["path"], batch["n_records"]):
            files, base = pafs.FileSystem.from_uri(path)
            rows, size, n = [], 0, 0
            with files.open_input_stream(base) as stream:
                for data in read_records(io.BufferedReader(stream)):
                    headers, block = parse_record(data)
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    kind = headers["warc-type"]
                    if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload does not match its digest")
                    rows.append((headers["x-page-id"] or None, unquote(headers["warc-target-uri"]), block,
                                 int(headers["x-payload-length"]), digest, kind,
                                 headers.get("x-refers-to-page-id") or None))
                    n, size = n + 1, size + len(block)
                    if size >= 8 << 20 or len(rows) >= 5000:
                        yield pd.DataFrame(rows, columns=COLUMNS)
                        rows, size = [], 0
            if n != n_records:
                raise ValueError(f"{path}: {n} records, not {n_records}")
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS)


COLUMNS = ["page_id", "url", "block", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the files of a manifest: page_id and refers_to long, block binary and others.

    Files are dealt over all tasks, by number, as adaptive execution would put the few bytes of
    their paths into one; a file is read as a stream, a record at a time.
    """
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks).mapInPandas(
        _reader, "page_id string, url string, block binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string").withColumns(
        {"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    manifest = write_archives(with_roles(pages), scratch_dir(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first_id FROM p WHERE octet_length(payload) >= 100 GROUP BY payload_digest
)
SELECT p.page_id, octet_length(payload)::BIGINT AS payload_bytes, p.payload_digest,
    CASE WHEN first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id <> p.page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND octet_length(payload) >= 100
"""
