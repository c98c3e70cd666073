"""Web archives (WARC) with a shared Zstandard dictionary.

Every page becomes a record, written to ``.warc.zst`` files: a skippable frame that holds
the dictionary comes first, then each record is a frame of its own, so that records can
be read one by one. The dictionary is trained on a bounded sample of the records that are
archived (SAMPLE_RECORDS in hash order, SAMPLE_BYTES of each) and shared by all files.

Records with equal payloads of at least LEAST_REVISIT bytes: the one with the largest
page id is a response, the others are revisits that refer to it and hold no payload. All
rows that share that id and payload are responses. Smaller payloads, and groups without
any page id, are responses. A null html is an empty payload, a null url has no target
header. An empty table gives no file.

Files are built by whole tasks in a fixed order of records and appear under their final
names only when complete, so a repeated task replaces its files by equal ones. They go
to any store that Arrow's file systems reach. Who refers to whom is found on digests alone;
payloads are shuffled once, to meet that, and only those of LEAST_REVISIT bytes by content.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.sources.staging import staged

LEAST_REVISIT = 1000
SAMPLE_RECORDS = 2000
SAMPLE_BYTES = 1 << 13
DICTIONARY_BYTES = 1 << 16
FILE_BYTES = 256 << 20
DATE = "2026-01-01T00:00:00Z"
# Fixed: the skippable frame that introduces a dictionary, and the end of a line.
MAGIC = 0x184D2A5D
END = b"\r\n"
SAFE = {c: f"%{c:02X}" for c in (*range(33), 127)}

_ROW = "page_id long, url string, html binary, sha1 string, size long, refers_to long, revisit boolean"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _digested(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long"), "url", html.alias("html")).select(
        "*",
        F.sha1("html").alias("sha1"),
        F.sha2("html", 256).alias("_same"),
        F.octet_length("html").cast("long").alias("size"),
    )


def payloads(pages: DataFrame) -> DataFrame:
    """Each payload once, without its content: digests, size, largest page id, copies; written once."""
    return staged(
        _digested(pages)
        .groupBy("_same", "sha1", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")),
        "payloads",
    )


def classified(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Pages with digest, size and what they refer to; the html of revisits is dropped."""
    groups = known.filter(
        (F.col("size") >= LEAST_REVISIT) & (F.col("copies") > 1) & F.col("keeper").isNotNull()
    ).select(F.col("_same").alias("_key"), "keeper")
    # Smaller payloads refer to nothing: each is dealt by its own number, not by content.
    own = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    rows = _digested(pages).withColumn("_own", own)
    rows = rows.withColumn("_key", F.when(F.col("size") >= LEAST_REVISIT, F.col("_same")).otherwise(F.col("_own")))
    revisit = F.coalesce(~F.col("keeper").eqNullSafe(F.col("page_id")) & F.col("keeper").isNotNull(), F.lit(False))
    return rows.drop("_same", "_own").join(groups, "_key", "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("html")).alias("html"),
        "sha1",
        "size",
        F.when(revisit, F.col("keeper")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page: dict) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['size']}\r\n\r\n"
    body = http.encode() + (page["html"] or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if page['revisit'] else 'response'}",
        f"WARC-Record-ID: {_record_id(page['page_id'], page['sha1'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{page['sha1']}",
        f"X-Payload-Length: {page['size']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if page["url"] is not None:
        lines.append(f"WARC-Target-URI: {page['url'].translate(SAFE)}")
    if page["page_id"] is not None:
        lines.append(f"X-Page-ID: {page['page_id']}")
    if page["revisit"]:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_record_id(page['refers_to'], page['sha1'])}")
        lines.append(f"X-Refers-To-Page: {page['refers_to']}")
    return "\r\n".join(lines).encode() + 2 * END + body + 2 * END


def dictionary(pages: DataFrame, known: DataFrame) -> bytes:
    """Train on a bounded sample of the archived records; too few of them give none.

    The sample is chosen among digests; only the records chosen are read, up to SAMPLE_BYTES.
    """
    order = (F.xxhash64("keeper", "sha1"), "keeper", "sha1")
    chosen = known.orderBy(*order).limit(SAMPLE_RECORDS).select("sha1", "_same", "keeper")
    short = F.substring("html", 1, SAMPLE_BYTES).alias("html")
    sample = (
        _digested(pages)
        .join(F.broadcast(chosen), ["sha1", "_same"])
        .filter(F.col("page_id").eqNullSafe(F.col("keeper")))
        .select("page_id", "url", short, "sha1", "size")
        .groupBy("page_id", "sha1", "size")
        .agg(F.min_by(F.struct("url", "html"), F.coalesce("url", F.lit(""))).alias("row"))
        .select("page_id", "row.*", "sha1", "size")
        .orderBy(F.xxhash64("page_id", "sha1"), "page_id", "sha1")
        .collect()
    )
    samples = [record({**row.asDict(), "refers_to": None, "revisit": False}) for row in sample]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < 16 or size < 1024:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def _target(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def _writer(folder: str, trained: bytes, most: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _target(folder)
        part, made, rows = TaskContext.get().partitionId(), 0, 0
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        press = zstandard.ZstdCompressor(level=6, dict_data=shared, write_content_size=True)
        out, size, names = None, 0, []

        def close() -> None:
            nonlocal out, made
            out.close()
            store.move(temporary, f"{path}/part-{part:05d}-{made:04d}.warc.zst")
            names.append((f"part-{part:05d}-{made:04d}.warc.zst", rows, size))
            made, out = made + 1, None

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                for page in batch.slice(first, 64).to_pylist():
                    if out is None:
                        temporary = f"{path}/_{uuid.uuid4().hex}"
                        out, size, rows = store.open_output_stream(temporary), 0, 0
                        head = struct.pack("<II", MAGIC, len(trained)) + trained if trained else b""
                        out.write(head)
                        size += len(head)
                    frame = press.compress(record(page))
                    out.write(frame)
                    size += len(frame)
                    rows += 1
                    if size >= most:
                        close()
        if out is not None:
            close()
        if names:
            columns = [pa.array(list(c)) for c in zip(*names, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "records", "bytes"])

    return write


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder``; returns the file list."""
    spark = pages.sparkSession
    known = payloads(pages)
    rows = classified(pages, known)
    trained = dictionary(pages, known)
    store, path = _target(folder)
    store.create_dir(f"{path}/archives", recursive=True)
    ordered = rows.sortWithinPartitions(F.col("page_id").asc_nulls_first(), "sha1", "url")
    ordered.mapInArrow(
        _writer(f"{folder}/archives", trained, file_bytes), "file string, records long, bytes long"
    ).write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if not line.strip():
            continue
        head = {}
        while (line := stream.readline()) not in (END, b""):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        yield head, stream.read(int(head["content-length"]))


def opened(source: io.RawIOBase) -> io.BufferedReader:
    """The records of an archive, decompressed with the dictionary it begins with."""
    start = source.read(8)
    trained = None
    if len(start) == 8 and struct.unpack("<II", start)[0] == MAGIC:
        trained = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", start)[1]))
    else:
        source.seek(0)
    press = zstandard.ZstdDecompressor(dict_data=trained)
    return io.BufferedReader(press.stream_reader(source, read_across_frames=True), 1 << 20)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for batch in batches:
        for address in batch.column(0).to_pylist():
            store, path = _target(address)
            rows = []
            with store.open_input_file(path) as source:
                for head, body in _records(opened(source)):
                    kind = head["warc-type"]
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(head["x-payload-length"])
                    if kind == "response":
                        payload = body[body.index(2 * END) + 4 :]
                        if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                            raise ValueError(f"{address}: a record differs from its digest")
                    number = lambda name: int(head[name]) if name in head else None  # noqa: B023, E731
                    rows.append((number("x-page-id"), size, digest, kind, number("x-refers-to-page")))
                    if len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row a record, each payload checked against its digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst")
    return files.load(f"{folder}/archives").select("path").mapInArrow(_reader, _READ)
