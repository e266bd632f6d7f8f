"""WARC archives of Zstandard frames: one frame per record behind a dictionary in a leading skippable frame.

Writing: records of equal payloads from ``REVISIT_BYTES`` on become one response, that with the largest page id, and revisits
of it. Archives are bounded by ``ARCHIVE_BYTES``; a task names each attempt's files anew and reports those it finished, so
a file of a lost attempt is never read. Reading streams an archive frame by frame and checks magic, version, header lines,
Content-Length, record ends and both digests.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
DICTIONARY_BYTES = 32 << 10
DICTIONARY_SAMPLES = 1000

# Fixed values of the formats: frame magics, header names, the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

_MANIFEST = "path string, records long, bytes long"
_READ = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, path string, place long"
)


def _sha1(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to) of every row.

    Null html is an empty payload. Of rows with the largest id of a payload, null ids last, one is the response as far as
    ids tell: repeated rows with that id are all responses. A group's leader comes from a maximum, never from its rows.
    """
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("payload_digest", F.sha1("payload"))
    long = F.octet_length("payload") >= REVISIT_BYTES
    digest = F.sha1(payload)
    groups = pages.where(F.octet_length(payload) >= REVISIT_BYTES).groupBy(digest.alias("payload_digest"))
    leaders = groups.agg(F.max(F.col(f"`{id_col}`").cast("long")).alias("leader"), F.count("*").alias("k"))
    joined = rows.join(leaders.where("k > 1").drop("k"), "payload_digest", "left")
    revisit = long & F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("leader")).alias("refers_to"),
    )


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from at most ``DICTIONARY_SAMPLES`` payload beginnings of 8 KB; empty if the pages are too few."""
    texts = pages.select(F.substring(f"`{html_col}`", 1, 8192).alias("t")).where("t <> ''").limit(DICTIONARY_SAMPLES)
    samples = [r.t.encode() for r in texts.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _page_uri(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record_bytes(page_id, url, payload: bytes, record_type: str, refers_to) -> bytes:
    head = HTTP_HEAD % len(payload)
    block = head if record_type == "revisit" else head + payload
    named = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{hashlib.sha1(payload).hexdigest()}")
    fields = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<urn:uuid:{named}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"\s", lambda space: quote(space.group()), url or "")),
        ("WARC-Page-ID", _page_uri(page_id)),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if record_type == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Page", _page_uri(refers_to))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(records: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write ``records`` below ``folder`` (a shared store that executors reach) and return the manifest of finished files.

    An empty table gives no files. A null id or URL is written as an empty one, white space in a URL in percent codes, so that
    no header is broken. A payload of any size is one record and one frame, held by its task alone; a file ends after
    ``ARCHIVE_BYTES``. Names are new on every attempt, so a task that runs again leaves files that no manifest names.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True, write_checksum=True)
        sink, name, size, count = None, None, 0, 0
        for part in parts:
            for r in part.itertuples(index=False):
                if sink is None:
                    name, size, count = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    sink = store.open_output_stream(name)
                    if dictionary:
                        size += sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                page_id = None if pd.isna(r.page_id) else int(r.page_id)
                refers = None if pd.isna(r.refers_to) else int(r.refers_to)
                size += sink.write(packer.compress(record_bytes(page_id, r.url, r.payload, r.record_type, refers)))
                count += 1
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    yield pd.DataFrame([(name, count, size)], columns=["path", "records", "bytes"])
                    sink = None
        if sink is not None:
            sink.close()
            yield pd.DataFrame([(name, count, size)], columns=["path", "records", "bytes"])

    # Ids as nullable floats would lose digits, so they travel as text.
    texts = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return texts.mapInPandas(run, _MANIFEST)


class BadArchive(ValueError):
    pass


def _exactly(source, n: int) -> bytes:
    data = source.read(n)
    if len(data) != n:
        raise BadArchive(f"{len(data)} of {n} bytes left")
    return data


def read_frames(source) -> Iterator[bytes]:
    """The records of an archive, one frame at a time. Only the first frame may hold a dictionary."""
    buffer, known = b"", None
    head = source.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        raw = _exactly(source, struct.unpack("<I", head[4:])[0])
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=64 << 20)
        known = zstandard.ZstdCompressionDict(raw)
    else:
        buffer = head
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while True:
        if not buffer:
            buffer = source.read(1 << 20)
            if not buffer:
                return
        while len(buffer) < 4:
            more = source.read(1 << 20)
            if not more:
                raise BadArchive("cut off in a frame's magic")
            buffer += more
        if struct.unpack("<I", buffer[:4])[0] != FRAME_MAGIC:
            raise BadArchive("not a Zstandard frame")
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            if not buffer:
                buffer = source.read(1 << 20)
                if not buffer:
                    raise BadArchive("cut off in a frame")
            out.append(frame.decompress(buffer))
            buffer = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record, or ``BadArchive``."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise BadArchive("no WARC/1.1 head")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise BadArchive(f"bad header line {line[:80]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise BadArchive(f"missing {sorted(missing)}")
    if not fields["content-length"].isdigit():
        raise BadArchive("bad Content-Length")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length {size}, but {len(rest) - 4} bytes before the record's end")
    block = rest[:size]
    if _sha1(block) != fields.get("warc-block-digest", _sha1(block)):
        raise BadArchive("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise BadArchive("no HTTP head")
    if fields["warc-type"] == "response":
        if _sha1(payload) != fields.get("warc-payload-digest"):
            raise BadArchive("payload digest differs")
        if f"Content-Length: {len(payload)}".encode() not in http.split(b"\r\n"):
            raise BadArchive("HTTP length differs")
    return {"fields": fields, "payload": payload}


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("urn:page:")
    return int(number) if number else None


def read_archives(manifest: DataFrame, files: int, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a manifest of ``files`` rows; without ``payloads`` they are checked and left out. A
    revisit has no payload; its digest and length are those of the response it refers to, from its own headers. Ids that were null
    come back null, URLs as written. Files are spread over tasks, and a task holds one record and a batch of 8 MB or one payload."""
    import pyarrow as pa
    from base64 import b32decode

    names = [f.split()[0] for f in _READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path in part.column(0).to_pylist():
                store, place = _store(path)
                out, size = [], 0
                with store.open_input_stream(place) as source:
                    for i, data in enumerate(read_frames(source)):
                        record = parse_record(data)
                        f = record["fields"]
                        digest = b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                        body = record["payload"] if payloads and f["warc-type"] == "response" else None
                        refers = _page(f.get("warc-refers-to-page"))
                        out.append((_page(f.get("warc-page-id")), f.get("warc-target-uri"), f["warc-type"], refers, int(f["warc-payload-length"]), digest, body, path, i))
                        size += len(body or b"") + 200
                        if size > 8 << 20:
                            yield _batch(out, kinds, names)
                            out, size = [], 0
                if out:
                    yield _batch(out, kinds, names)

    def _batch(rows, kinds, names):
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    # The manifest is a small table that Spark would read in few tasks; its files are the work.
    parallel = 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(max(1, min(files, parallel))).mapInArrow(run, _READ)
