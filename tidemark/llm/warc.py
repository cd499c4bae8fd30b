"""Operator 4, WARC archives in Zstandard: one frame a record, the dictionary in a leading skippable frame.

``write_archives`` turns pages into records and the records into archive files in the shared folder; of pages
with equal payloads (by SHA-1 of the UTF-8 html) the one with the smallest page_id is a ``response`` with
the payload, the others are ``revisit`` records that refer to it. ``read_archives`` loads each file's
dictionary, decodes frame by frame, and checks the frame's size, the version line, the headers, the block's
length and the payload's digest before it gives a record.

Null html is an empty payload, and payloads under ``LEAST`` bytes are never revisits. Null ids sort last: a null
page_id is a response only where all of its payload's ids are null. Pages that share payload and smallest id
are all responses. Repeated rows give repeated records; long payloads are stored whole, a record a frame; an empty table
gives no archives and no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_path, table, written

#: Payloads of at least so many bytes are stored once.
LEAST = 0
#: Compressed bytes after which a task begins a new file.
FILE_BYTES = 4 << 20
#: Pages, of at most so many bytes each, that the dictionary is trained on, and the dictionary's size.
SAMPLE, SAMPLE_BYTES, DICTIONARY = 256, 1 << 16, 1 << 15
LEVEL = 6
#: Fixed values of the formats: skippable frame of a dictionary, Zstandard frame, version line, revisit profile.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_PAGE = "urn:x-page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_of(page_id: int | None, url: str | None, payload: bytes, refers: int | None, size: int, sha1: str) -> bytes:
    """One record; ``payload`` is left out of revisits, whose ``size`` and ``sha1`` are those of the full payload."""
    revisit = refers is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{_PAGE}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{_PAGE}{refers}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    return VERSION + b"\r\n" + lines.encode() + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> bytes:
    """A dictionary for records of such payloads; a plain one of headers where there is too little to train on."""
    records = [record_of(i, "http://www.example.com/", x, None, len(x), digest(x)) for i, x in enumerate(samples)]
    try:
        return zstandard.train_dictionary(DICTIONARY, records).as_bytes()
    except zstandard.ZstdError:
        return record_of(0, "http://www.example.com/", b"", None, 0, digest(b""))


def _writer(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        packed = zstandard.ZstdCompressor().compress(dictionary)
        lead = struct.pack("<II", SKIPPABLE, len(packed)) + packed
        store, at = fs.FileSystem.from_uri(folder)
        frames, size, told = [lead], 0, []

        def close() -> None:
            nonlocal frames, size
            path = f"{at}/{uuid.uuid4().hex}.warc.zst"  # a repeated task writes other files, and only those told are read
            with store.open_output_stream(path, compression=None) as out:
                for x in frames:
                    out.write(x)
            told.append((path, len(frames) - 1, size))
            frames, size = [lead], 0

        for batch in batches:
            for page_id, url, html, refers, length, sha1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                frames.append(compressor.compress(record_of(page_id, url, html or b"", refers, length, base64.b32encode(bytes.fromhex(sha1)).decode())))
                size += len(frames[-1])
                if size >= FILE_BYTES:
                    close()
        if len(frames) > 1:
            close()
        yield pa.record_batch([pa.array([x[i] for x in told], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The archives' manifest: path, records and bytes of each file."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    # only ids and digests meet by digest, which one page may share with very many; payloads are dealt by page
    ids = written(rows.select("page_id", "sha1"), "digests")
    first = ids.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = ids.join(first, "sha1").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("later"), F.col("sha1").alias("of"), "first").distinct()
    size = F.octet_length("payload").cast("long")
    refers = F.when(size >= LEAST, F.col("first"))
    met = rows.join(later, F.col("page_id").eqNullSafe(F.col("later")) & (F.col("sha1") == F.col("of")), "left")
    judged = met.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), refers.alias("refers"), size.alias("size"), "sha1")
    sample = rows.where(F.octet_length("payload") <= SAMPLE_BYTES).select("payload").limit(SAMPLE)
    folder = new_path(spark, "warc")
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at)
    made = judged.mapInArrow(_writer(folder, trained([bytes(r["payload"]) for r in sample.collect()])), "path string, records long, bytes long")
    return written(made.withColumn("folder", F.lit(folder)), "warc-manifest")


def dictionary_of(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of an archive and where its frames begin."""
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != SKIPPABLE:
        return None, 0
    size = struct.unpack("<I", data[4:8])[0]
    body = bytes(data[8 : 8 + size])
    if len(body) != size:
        raise ValueError("the dictionary's frame is cut off")
    if body[:4] == struct.pack("<I", FRAME):
        body = zstandard.ZstdDecompressor().decompress(body)
    return zstandard.ZstdCompressionDict(body), 8 + size


def frames_of(data: memoryview, step: int = 1 << 14) -> Iterator[bytes]:
    """What each frame of an archive holds."""
    dictionary, at = dictionary_of(data)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        expected = zstandard.frame_content_size(data[at : at + 18])
        one, parts = reader.decompressobj(), []
        while not one.eof:
            part = data[at : at + step]
            if not len(part):
                raise ValueError("a frame is cut off")
            parts.append(one.decompress(part))
            at += len(part)
        at -= len(one.unused_data)
        record = b"".join(parts)
        if expected >= 0 and len(record) != expected:
            raise ValueError("a frame holds other than its stated size")
        yield record


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """The headers (names in lower case) and the block of one record, checked."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not mark or not version.startswith(b"WARC/1."):
        raise ValueError("a record without version line or headers")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("a header line without a name")
        fields[name.strip().lower().decode()] = value.strip().decode()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise ValueError(f"a record lacks {sorted(missing)}")
    size = int(fields["content-length"])
    if size < 0 or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    block = rest[:size]
    if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("a block differs from its digest")
    return fields, block


def _page(value: str) -> int | None:
    number = value.strip("<>").removeprefix(_PAGE)
    return int(number) if number else None


def entry_of(record: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and the payload (None for revisits)."""
    fields, block = parsed(record)
    http, mark, payload = block.partition(b"\r\n\r\n")
    sizes = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not mark or len(sizes) != 1:
        raise ValueError("a block without an HTTP header")
    told, size, kind = fields["warc-payload-digest"].removeprefix("sha1:"), int(sizes[0]), fields["warc-type"]
    if kind == "response" and (len(payload) != size or digest(payload) != told):
        raise ValueError("a payload differs from its length or digest")
    refers = _page(fields["warc-refers-to"]) if kind == "revisit" else None
    return _page(fields["warc-record-id"]), fields.get("warc-target-uri", ""), size, told, kind, refers, payload if kind == "response" else None


_SHAPE = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _reader(columns: list[str]):
    names = list(_SHAPE)
    places = [names.index(c) for c in columns]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], _SHAPE[names[i]]) for i in places], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, _ = fs.FileSystem.from_uri(folder)
                with store.open_input_file(path) as file:
                    data = memoryview(file.read())
                rows, held = [], 0
                for record in frames_of(data):
                    rows.append(entry_of(record))
                    held += len(record)
                    if held >= FILE_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return run


def read_archives(manifest: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The records of the files in ``manifest``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload, or some of these."""
    columns = columns or list(_SHAPE)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    files = manifest.agg(F.count(F.lit(1))).first()[0]
    spread = manifest.select("folder", "path").repartition(max(1, -(-files // 4)), "path")
    return spread.mapInArrow(_reader(columns), ", ".join(f"{c} {kinds[_SHAPE[c]]}" for c in columns))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for every page, written to archives and read back."""
    return read_archives(write_archives(table(spark, sf_dir, "pages")), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


_BASE32 = " || ".join(f"translate(to_base(('0x' || substr(s.h, {i}, 10))::BIGINT, 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in (1, 11, 21, 31))
OP4_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), s AS (SELECT *, sha1(html) AS h FROM p),
  f AS (SELECT h, min(page_id) AS first FROM s GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM s JOIN f ON s.h = f.h
"""
