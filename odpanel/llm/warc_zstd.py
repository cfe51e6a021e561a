"""WARC archives with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records to archive. Each
archive begins with a skippable frame (magic 0x184D2A5D) that holds it; every
record after that is a frame of its own, compressed with the dictionary, so
records can be read one by one from their offset.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest page_id is a `response`; the others are `revisit` records that
name it and carry no payload. A page without id is archived under the name
``none``. Archives are written by the tasks through
``pyarrow.fs`` under the shared folder, to a name of the attempt first and
then renamed; a task that runs again writes the same bytes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odpanel.llm.common import byte_slices, stored
from odpanel.operators.flows import salts_of
from odpanel.session import shared_dir

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20     # compressed size at which the next archive begins
DICT_BYTES = 64 << 10
SAMPLE_RECORDS = 500         # about so many records train the dictionary, chosen by hash
SAMPLE_MAX_BYTES = 32 << 10  # larger payloads are not sampled (they are archived)
LEVEL = 5
HOT_COPIES = 10_000          # fewer copies of a payload are no hot group
HOT_PAYLOADS = 1000          # payloads that are dealt out as hot, at most
READ_BYTES = 1 << 20
# Fixed values of the formats
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"   # the pages carry no capture time


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and plain path of a Hadoop path."""
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else "%20" for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Type, ids, digest and payload size of a record. The payload of a
    response is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n")
                      if x.startswith("Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length
                               or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def page(urn: str | None) -> int | None:
        name = (urn or "<urn:page:none>").removeprefix("<urn:page:").removesuffix(">")
        return None if name == "none" else int(name)

    return {"page_id": page(fields["WARC-Record-ID"]), "payload_bytes": length,
            "payload_digest": digest, "record_type": kind,
            "refers_to": page(fields.get("WARC-Refers-To")), "payload": payload}


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary from record samples; where they are too few to train on,
    the end of their text itself (a raw-content dictionary)."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b"WARC/1.1\r\n"


def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(data)) + data


class Archive:
    """One archive file under a temporary name until it is closed."""

    def __init__(self, folder: str, name: str, attempt: int, dictionary: bytes):
        self.fs, root = filesystem(folder)
        self.name, self.final = name, f"{root}/{name}"
        self.temp = f"{root}/.{name}.{attempt}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        frame = dictionary_frame(dictionary)
        self.out.write(frame)
        self.size = len(frame)
        self.zstd = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))

    def add(self, raw: bytes) -> tuple[int, int]:
        frame = self.zstd.compress(raw)
        at = self.size
        self.out.write(frame)
        self.size += len(frame)
        return at, len(frame)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.final)


def read_archive(path: str) -> Iterator[bytes]:
    """The records of one archive in order, a frame at a time."""
    fs, plain = filesystem(path)
    with fs.open_input_stream(plain, compression=None) as src:
        magic, size = struct.unpack("<II", src.read(8))
        if magic != DICT_MAGIC:
            raise ValueError(f"{path} does not begin with a dictionary frame")
        zstd = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(src.read(size)))
        frame, parts, held = zstd.decompressobj(), [], b""
        while data := held or src.read(READ_BYTES):
            parts.append(frame.decompress(data))
            held = frame.unused_data if frame.eof else b""
            if frame.eof:
                yield b"".join(parts)
                frame, parts = zstd.decompressobj(), []
        if parts and any(parts):
            raise ValueError(f"{path} ends inside a record")


def read_record(path: str, offset: int, length: int) -> bytes:
    """One record by its place in the index."""
    fs, plain = filesystem(path)
    with fs.open_input_file(plain) as src:
        _, size = struct.unpack("<II", src.read_at(8, 0))
        data = zstandard.ZstdCompressionDict(src.read_at(size, 8))
        return zstandard.ZstdDecompressor(dict_data=data).decompress(
            src.read_at(length, offset), max_output_size=1 << 31)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archive (page_id, url, html) and return the stored index (file,
    offset, length, page_id). A null html is the empty payload. A row without
    page_id is a response unless a page with an id has its payload; rows that
    repeat a page_id and payload are each archived alike."""
    spark = pages.sparkSession
    src = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    # by a hash threshold, so that tasks send the sample alone to the driver;
    # the limit only guards against one page repeated many times
    part = min(1.0, SAMPLE_RECORDS / max(1, src.count()))
    place = F.shiftrightunsigned(F.xxhash64("page_id", "url"), 11) / F.lit(float(1 << 53))
    sample = src.filter(F.octet_length("html").between(64, SAMPLE_MAX_BYTES)) \
        .filter(place < part).limit(2 * SAMPLE_RECORDS).collect()
    dictionary = train_dictionary(sorted(
        record(r.page_id, r.url, bytes(r.html), hashlib.sha256(r.html).hexdigest(), None)
        for r in sample))
    digested = src.withColumn("digest", F.sha2("html", 256))
    long = F.octet_length("html") >= MIN_REVISIT
    seen = stored(spark, digested.filter(long).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1"), "warc-copies")
    # the copies of a frequent payload are dealt to several tasks; there are
    # at most HOT_PAYLOADS of those, whatever the pages
    share = (seen.agg(F.sum("copies")).first()[0] or 0) / HOT_PAYLOADS
    hot = [r.digest for r in seen.filter(F.col("copies") > max(HOT_COPIES, share))
           .select("digest").collect()]
    salts = salts_of(spark)
    is_hot = F.col("digest").isin(hot) if hot else F.lit(False)
    first = seen.select("digest", "first", F.explode(F.when(
        is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salt = F.when(is_hot, F.pmod(F.xxhash64("page_id", "url", F.spark_partition_id()),
                                 F.lit(salts))).otherwise(0).cast("int")
    refers = F.when(long & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    rows = digested.withColumn("salt", salt).join(first, ["digest", "salt"], "left") \
        .withColumn("refers_to", refers).drop("first", "salt") \
        .sortWithinPartitions("page_id", "digest")
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        archive, number = None, 0
        for batch in batches:
            for part, html in byte_slices(batch, "html"):
                col = {c: part.column(columns.index(c)).to_pylist()
                       for c in columns if c != "html"}
                out = []
                for i, payload in enumerate(html):
                    if archive is None:
                        archive = Archive(
                            folder, f"part-{task.partitionId():06d}-{number:04d}.warc.zst",
                            task.taskAttemptId(), dictionary)
                        number += 1
                    raw = record(col["page_id"][i], col["url"][i], payload, col["digest"][i],
                                 col["refers_to"][i])
                    out.append((archive.name, *archive.add(raw), col["page_id"][i]))
                    if archive.size >= ARCHIVE_BYTES:
                        archive.close()
                        archive = None
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("file", "offset", "length", "page_id"),
                             map(list, zip(*out, strict=True)), strict=True)))
        if archive is not None:
            archive.close()

    index = rows.mapInArrow(run, "file string, offset long, length long, page_id long")
    return stored(spark, index, "warc-index")


RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long")


def read_archives(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The records of the archives ``files`` (file) in ``folder``, one task
    per archive at most."""
    names = files.select("file").distinct()
    tasks = max(1, min(names.count(), 20_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "record_type": pa.string(),
                 "refers_to": pa.int64()}
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: dict[str, list] = {k: [] for k in kinds}
                for raw in read_archive(f"{folder}/{name}"):
                    got = parse(raw)
                    for k in kinds:
                        out[k].append(got[k])
                    if len(out["page_id"]) >= 10_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(out[k], t) for k, t in kinds.items()], list(kinds))
                        out = {k: [] for k in kinds}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[k], t) for k, t in kinds.items()], list(kinds))

    return names.repartition(tasks).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of
    every page, read back from the archives written to ``folder`` (default: a
    fresh one in the shared storage). An empty table writes no archive and
    gives an empty result; other columns are not read."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    index = write_archives(pages, folder)
    return stored(spark, read_archives(spark, folder, index), "warc-records")
