"""WARC archives compressed record by record with a shared dictionary.

Each task writes its pages into archive files of bounded size: a Zstandard
dictionary trained on the archive's own records stands in a leading
skippable frame, and every record follows as a frame of its own, so a
record can be read without the others. A payload that occurs again becomes
a revisit record that refers to one response.

Files are named by attempt and only those in the returned manifest count,
so a task that runs twice leaves no record twice. Null html is an empty
payload, a null url has no target line, a null id reads back as null; rows
that repeat a page are archived as records of their own; an empty table
gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship, stored

#: fixed values: the skippable frame that holds the dictionary
DICT_MAGIC = 0x184D2A5D
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES = 2 << 20
DICT_BYTES = 48 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_duplicates(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest (hex SHA-1) and refers_to:
    the largest page_id with the same payload of at least ``min_bytes``, null
    for that page itself and for smaller payloads."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    large = F.col("payload_bytes") >= min_bytes
    shared = full.where(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    shared = shared.where("n > 1").select("digest", "last")
    joined = full.join(shared, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", refers.alias("refers_to"))


def _record(page_id, url, payload: bytes, n: int, digest: str, refers_to, date: str) -> bytes:
    name = f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """A whole archive: dictionary frame, then one frame for each record."""
    import zstandard as zstd

    every = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::every]]
    try:
        trained = zstd.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 4), samples, k=256, d=8)
    except zstd.ZstdError:  # too few samples, or nothing in common: the samples themselves serve
        trained = zstd.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zstd.DICT_TYPE_RAWCONTENT)
    out = io.BytesIO()
    body = zstd.ZstdCompressor(level=level).compress(trained.as_bytes())
    out.write(struct.pack("<II", DICT_MAGIC, len(body)) + body)
    compressor = zstd.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    for r in records:
        out.write(compressor.compress(r))
    return out.getvalue()


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


MANIFEST = "path string, records long, bytes long"


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str, limit: int) -> Iterator[pa.RecordBatch]:
    files, base = _open(folder)
    files.create_dir(base, recursive=True)

    def flush(records: list[bytes]) -> pa.RecordBatch:
        name = f"{uuid.uuid4().hex}.warc.zst"
        data = archive_bytes(records)
        with files.open_output_stream(f"{base}/{name}", compression=None) as f:
            f.write(data)
        return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": pa.array([len(records)], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})

    records: list[bytes] = []
    size = 0
    for batch in batches:
        cols = [batch.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "digest", "refers_to")]
        for r in range(batch.num_rows):
            rec = _record(*(c[r].as_py() for c in cols), date)
            records.append(rec)
            size += len(rec)
            if size >= limit:
                yield flush(records)
                records, size = [], 0
    if records:
        yield flush(records)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z", archive_limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page into archives under ``folder`` (a shared folder);
    returns the manifest: path, records, bytes of each archive."""
    ship(pages.sparkSession)
    ready = with_duplicates(pages, min_bytes)
    return stored(ready.mapInArrow(lambda it: _write(it, folder, date, archive_limit), MANIFEST), "warc-manifest")


def read_records(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open archive."""
    import zstandard as zstd

    start = data.read(8)
    trained, lead = None, start
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICT_MAGIC:
        trained = zstd.ZstdCompressionDict(zstd.ZstdDecompressor().decompress(data.read(struct.unpack("<I", start[4:])[0])))
        lead = b""
    source = io.BytesIO(lead + data.read())
    plain = io.BufferedReader(zstd.ZstdDecompressor(dict_data=trained).stream_reader(source, read_across_frames=True), 1 << 18)
    while line := plain.readline():
        if not line.strip():
            continue
        fields: dict[str, str] = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, plain.read(int(fields["content-length"]))


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
    if payloads:
        kinds["payload"] = pa.binary()
    for batch in batches:
        for path in batch.column(0).to_pylist():
            files, at = _open(path)
            rows: list[tuple] = []
            size = 0
            with files.open_input_stream(at, compression=None) as f:
                for fields, block in read_records(f):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind = fields["warc-type"]
                    if kind == "response":
                        n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    else:
                        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    row = (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")), n, digest)
                    rows.append((*row, payload if kind == "response" else None) if payloads else row)
                    size += len(payload) * payloads
                    if len(rows) >= 5000 or size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest of
    every record (of the full payload, also for revisits) and, if asked, the
    payload of responses. Archives are dealt out one by one."""
    ship(manifest.sparkSession)
    schema = RECORDS + (", payload binary" if payloads else "")
    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(lambda it: _read(it, payloads), schema)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages into a new folder of the shared scratch area and read them back."""
    folder = scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder if "://" in folder or folder.startswith("/") else f"/{folder}"))
