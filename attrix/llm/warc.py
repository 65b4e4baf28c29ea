"""WARC archives as Zstandard files with a dictionary.

An archive starts with a skippable frame that holds the dictionary (itself a zstd
frame), followed by one frame per record, compressed with it.  The reader loads the
dictionary from that frame, decodes frame by frame from a stream, and checks each
record's version line, headers, lengths and digests.

Archives go to a folder that driver and executors share.  A task writes files under
names of its own and reports them in its output rows; only reported files are read, so
a task that ran twice leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import stored
from attrix.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D   # skippable frame of a dictionary in .warc.zst files
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
ARCHIVE_BYTES = 64 << 20        # a task starts another archive beyond this
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 300, 1 << 16, 1 << 15
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"   # the pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 16


class WarcError(ValueError):
    """An archive that breaks the format, or whose lengths or digests disagree."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, record_id: str, uri: str | None, payload_digest: str, payload_bytes: int, payload: bytes,
            refers_to: str | None = None) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    if uri:
        head.append("WARC-Target-URI: " + quote(uri, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{payload_digest}",
             f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(key) -> str:
    return f"<urn:page:{'null' if key is None else quote(str(key), safe='')}>"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; raises WarcError."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"not a WARC record: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"header {name} is missing")
    length = headers["content-length"]
    if not length.isascii() or not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"record {headers['warc-record-id']}: Content-Length {length} of a block of {len(rest) - 4} bytes")
    return headers, rest[:-4]


def page_of(headers: dict[str, str], block: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a parsed record, its digests checked."""
    name = headers["warc-record-id"]
    if headers.get("warc-block-digest") != "sha1:" + digest(block):
        raise WarcError(f"record {name}: block digest differs")
    http, sep, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not sep or len(sizes) != 1:
        raise WarcError(f"record {name}: HTTP headers are broken")
    size, kind, given = int(sizes[0]), headers["warc-type"], headers.get("warc-payload-digest", "")
    key = lambda x: None if x == "<urn:page:null>" else unquote(x.removeprefix("<urn:page:").removesuffix(">"))
    if kind == "response":
        if size != len(payload) or given != "sha1:" + digest(payload):
            raise WarcError(f"record {name}: payload length or digest differs")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers:
        raise WarcError(f"record {name}: unexpected type or a revisit with a payload or without a target")
    return {"page_id": key(name), "payload_bytes": size, "payload_digest": given.removeprefix("sha1:"),
            "record_type": kind, "refers_to": key(headers["warc-refers-to"]) if kind == "revisit" else None}


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
    return DICTIONARY_MAGIC.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an open archive, one frame at a time; holds a record and a read buffer."""
    head = stream.read(8)
    if len(head) < 8 or int.from_bytes(head[:4], "little") != DICTIONARY_MAGIC:
        raise WarcError("the archive has no dictionary frame")
    size = int.from_bytes(head[4:], "little")
    body = stream.read(size)
    if len(body) != size:
        raise WarcError("the dictionary frame is cut off")
    if body.startswith(ZSTD_MAGIC):
        body = zstandard.ZstdDecompressor().decompress(body)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body) if body else None)
    buffer = stream.read(READ_BYTES)
    while buffer:
        if buffer[:4] != ZSTD_MAGIC and len(buffer) >= 4:
            raise WarcError("expected a zstd frame")
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(buffer))
            except zstandard.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from e
            if frame.eof:
                buffer = frame.unused_data or stream.read(READ_BYTES)
                break
            buffer = stream.read(READ_BYTES)
            if not buffer:
                raise WarcError("the last frame is cut off")
        yield parse_record(b"".join(parts))


def _filesystem(path: str):
    """File system and path of a URI such as Spark's (file:/x, hdfs://host/x, s3a://...) or a plain path."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _frames(dictionary: bytes):
    """(page_id, url, html) -> the page's response record as a frame, the payload's length and SHA-1."""
    def run(batches):
        z = _compressor(dictionary)
        for b in batches:
            frames, sizes, hexes, sums = [], [], [], []
            for key, url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                sums.append(digest(payload))
                hexes.append(base64.b32decode(sums[-1]).hex())
                sizes.append(len(payload))
                frames.append(z.compress(_record("response", record_id(key), url, sums[-1], len(payload), payload)))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(frames, pa.binary()), pa.array(sizes, pa.int64()),
                                   pa.array(hexes, pa.string())], names=["page_id", "url", "frame", "size", "sha1"])
    return run


def _write(folder: str, dictionary: bytes):
    def run(batches):
        z, (system, base) = _compressor(dictionary), _filesystem(folder)
        start, out, name, n = dictionary_frame(dictionary), None, "", 0

        def close():
            out.close()
            return pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], names=["path", "records"])

        for b in batches:
            for key, url, frame, size, sha1, first in zip(*(b.column(i).to_pylist() for i in range(6))):
                if out is None:
                    system.create_dir(base, recursive=True)
                    name, n = f"pages-{uuid.uuid4().hex}.warc.zst", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(start)
                if first is not None and first != key:
                    sum32 = base64.b32encode(bytes.fromhex(sha1)).decode()
                    frame = z.compress(_record("revisit", record_id(key), url, sum32, size, b"", record_id(first)))
                out.write(frame)
                n += 1
                if out.tell() >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` to archives in ``folder``; returns their paths and record counts.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, that with the smallest
    id is a response and the others revisit it; rows that tie for the smallest id are responses
    alike, and a payload whose rows all lack an id has responses only.  A null payload is empty,
    a null url leaves the target header out.  Other columns are ignored.  An empty table
    gives no archive.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("html"))
    kind = dict(own.dtypes)["page_id"]
    # the pages with the smallest hashes: hashes are ranked first, so only SAMPLE_PAGES pages reach the driver
    fit = own.where(F.octet_length("html").between(64, SAMPLE_BYTES)).withColumn("h", F.xxhash64("page_id", "url", "html"))
    least = fit.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).agg(F.max("h").alias("h")).first()["h"]
    chosen = [] if least is None else fit.where(F.col("h") <= least).select("h", "html").distinct().collect()
    sample = [r["html"].encode() for r in sorted(chosen, key=lambda r: (r["h"], r["html"]))]
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes() if len(sample) >= 8 else b""
    except zstandard.ZstdError:   # the sample is too small or too uniform: the frame stays empty
        dictionary = b""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    firsts = stored(own.select("page_id", F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
                    .where(F.col("size") >= min_revisit_bytes)
                    .groupBy("sha1", "size").agg(F.min("page_id").alias("first")), "payloads")
    frames = own.mapInArrow(_frames(dictionary), f"page_id {kind}, url string, frame binary, size long, sha1 string")
    return stored(frames.join(firsts, ["sha1", "size"], "left").select("page_id", "url", "frame", "size", "sha1", "first")
                  .mapInArrow(_write(folder, dictionary), "path string, records long"), "archives")


def _read(batches):
    for b in batches:
        for path, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            system, name = _filesystem(path)
            rows, n = [], 0
            with system.open_input_stream(name, compression=None) as stream:
                for headers, block in read_archive(stream):
                    rows.append(page_of(headers, block) | {"url": headers.get("warc-target-uri")})
                    n += 1
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, _PAGE)
                        rows = []
            if expected is not None and n != expected:
                raise WarcError(f"{path}: {n} records, {expected} written")
            yield pa.RecordBatch.from_pylist(rows, _PAGE)


_PAGE = pa.schema([("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string())])


def read_archives(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """The records of the archives named in ``path`` (``records``: how many each must hold, or null)."""
    n = max(1, archives.count())
    got = archives.select("path", "records").repartition(n, "path").mapInArrow(
        _read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string")
    return got.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_revisit_bytes), dict(pages.dtypes)["page_id"])
