"""WARC archives compressed with a dictionary of their own.

A Zstandard dictionary is built from archived records (a bounded sample), each archive begins with a
skippable frame that holds it, and every record is a frame of its own, so a reader can start at any
record.  Records of equal payloads are written once as a response and as revisits that refer to it.

Archives are files of the shared folder, written by the executors under a name that follows from the
partition, and put in place by a rename: a task that runs again writes the same file.

Defined cases: a null page is an empty payload; rows that repeat a page id are records of their own;
of equal payloads all rows of the largest id are responses; a row of a null id is a response unless
an equal payload has an id; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shared_path
from .sizes import small

#: skippable frame of the WARC Zstandard format
MAGIC = struct.pack("<I", 0x184D2A5D)
DATE = "2020-01-01T00:00:00Z"
NAMESPACE = 0x6772697374
ENTRY = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, salt: str) -> str:
    """The id of a record; a page's id can be read from it."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, salt)}>"
    return f"<urn:uuid:{uuid.UUID(int=(NAMESPACE << 64) | (page_id & (2**64 - 1)))}>"


def page_of(urn: str) -> int | None:
    n = uuid.UUID(urn.strip("<>").rpartition(":")[2]).int
    if n >> 64 != NAMESPACE:
        return None
    low = n & (2**64 - 1)
    return low - (1 << 64) if low >> 63 else low


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, salt: str = "") -> bytes:
    """One WARC 1.1 record; ``original`` is the page of the response for a revisit."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, salt)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if original is not None:
        lines += [f"WARC-Refers-To: {record_id(original, '')}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Payload-Length: {len(payload)}"]
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    else:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.decode().lower(): v.decode() for k, v in ENTRY.findall(head + b"\r\n")}
    body = rest[: int(fields["content-length"])]
    fields["payload"] = body.partition(b"\r\n\r\n")[2]
    return fields


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; raw content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return MAGIC + struct.pack("<I", len(packed)) + packed


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def _writer(folder: str, dictionary: bytes, level: int):
    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.warc.zst"
        fs, where = _open(f"{folder}/{name}")
        draft = f"{where}.{task.taskAttemptId()}"
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        out, n = None, 0
        for batch in batches:
            for pid, url, text, digest, original in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs.create_dir(where.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(draft, compression=None)
                    out.write(dictionary_frame(dictionary))
                payload = (text or "").encode()
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                out.write(packer.compress(record(pid, url, payload, digest, original, f"{name}/{n}")))
                n += 1
        if out is not None:
            out.close()
            fs.move(draft, where)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n])], ["path", "records"])

    return run


def read_archive(stream, chunk: int = 1 << 20):
    """Raw records of one archive, one at a time."""
    head = stream.read(8)
    if head[:4] != MAGIC:
        raise ValueError("no dictionary frame")
    packed = stream.read(struct.unpack("<I", head[4:])[0])
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(packed)))
    rest = b""
    one, got = unpack.decompressobj(), io.BytesIO()
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            break
        got.write(one.decompress(data))
        if one.eof:
            yield got.getvalue()
            rest = one.unused_data
            one, got = unpack.decompressobj(), io.BytesIO()


def _reader():
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive"]

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, where = _open(path)
                rows = []
                with fs.open_input_stream(where, compression=None) as stream:
                    for raw in read_archive(stream):
                        r = parse_record(raw)
                        kind, said = r["warc-type"], r["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response":
                            size, digest, refers = len(r["payload"]), base32_sha1(r["payload"]), None
                            if digest != said:
                                raise ValueError(f"digest of {r['warc-record-id']} in {path}")
                        else:
                            size, digest, refers = int(r["x-payload-length"]), said, page_of(r["warc-refers-to"])
                        rows.append((page_of(r["warc-record-id"]), size, digest, kind, refers, path))
                        if len(rows) == 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return run


def write(pages: DataFrame, folder: str, least: int = 0, sample: int = 400, size: int = 64 << 10, level: int = 3) -> DataFrame:
    """Archives of all rows in folder; (path, records) of each.

    Payloads of fewer than ``least`` bytes are never revisits.  The dictionary learns from at most
    ``sample`` records, taken in hash order.
    """
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text.alias("html"), F.sha1(text.cast("binary")).alias("digest"))
    # ids first, so that no task sends payloads for rows that are not taken
    ids = pages.select(F.xxhash64("page_id", "url").alias("k")).distinct().orderBy("k").limit(sample)
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.substring(text, 1, 65536).alias("html"), F.xxhash64("page_id", "url").alias("k")).join(F.broadcast(ids), "k")
    # rows that repeat an id: one of each
    some = sorted(picked.groupBy("k").agg(F.min(F.struct("page_id", "url", "html")).alias("x")).select("x.*").collect(), key=repr)
    dictionary = train([record(r["page_id"], r["url"], (p := (r["html"] or "").encode()), base32_sha1(p), None) for r in some], size)
    # of each payload that occurs again the page it is written for; combined before the shuffle
    again = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("c")).where("c > 1 and original is not null")
    again = small(materialize(again.select(F.col("digest").alias("d"), "original"), "repeated-payloads"))
    joined = rows.join(again, (rows["digest"] == again["d"]) & (F.octet_length("html") >= least), "left")
    original = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("original")), F.col("original"))
    out = joined.select("page_id", "url", "html", "digest", original.alias("original"))
    return materialize(out.mapInArrow(_writer(folder, dictionary, level), "path string, records long"), "archives")


def read(archives: DataFrame) -> DataFrame:
    """Records of all archives (column path): an archive is a task, and its records are read one at a time."""
    paths = archives.select("path").repartition(max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return paths.mapInArrow(_reader(), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every row and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = shared_path(pages.sparkSession, "warc")
    return read(write(pages, folder, least)).drop("archive")
