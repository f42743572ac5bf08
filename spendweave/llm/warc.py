"""WARC archives with one Zstandard frame per record and a shared dictionary up front.

An archive begins with a skippable frame whose content is the dictionary that the frames
after it were compressed with. Each record is one frame, so that a reader can skip or start
at any. The first occurrence of a payload is a response; later ones are revisit records, which
refer to it and carry no payload.

Archives of other writers are read too: without a dictionary or with one that is itself compressed, with
frames that do not state their size, with more skippable frames, and with records of any type.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.sources.store import materialise

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below are always stored.
LEAST_PAYLOAD = 100
#: An archive is closed when it has so many bytes.
ARCHIVE_BYTES = 4 << 20
#: The dictionary is trained on so many pages of at most so many characters.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 20_000, 32 << 10
LEVEL = 6

_ZERO_DATE = "1970-01-01T00:00:00Z"
_OWN_URN = re.compile(r"<urn:page:(-?\d+)>")


def train(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary from a bounded sample, empty where there is too little to learn from."""
    short = pages.select(F.col(f"`{html}`").alias("html")).where(F.length("html").between(1, SAMPLE_CHARS))
    samples = [r["html"].encode() for r in short.take(SAMPLE_PAGES)]
    if len(samples) < 50:
        return b""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:  # samples that have nothing in common
        return b""


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame with the dictionary."""
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it is before compression."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def frame_end(archive: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from the lengths in its headers."""
    if len(archive) - at < 8:
        raise ValueError("a frame is cut off")
    magic, size = struct.unpack_from("<II", archive, at)
    if magic in SKIPPABLE:
        if at + 8 + size > len(archive):
            raise ValueError("a frame is cut off")
        return at + 8 + size
    if magic != FRAME_MAGIC:
        raise ValueError(f"no Zstandard frame at byte {at}")
    head = bytes(archive[at : at + 18])
    checksum = 4 if zstd.get_frame_parameters(head).has_checksum else 0
    at += zstd.frame_header_size(head)
    last = 0
    while not last:
        if at + 3 > len(archive):
            raise ValueError("a frame is cut off")
        header = int.from_bytes(archive[at : at + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        at += 3 + (1 if kind == 1 else size)  # a run-length block stores one byte
    if at + checksum > len(archive):
        raise ValueError("a frame is cut off")
    return at + checksum


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of a record; ValueError if it is not well formed."""
    head, split, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not split or version not in VERSIONS:
        raise ValueError("not a WARC record")
    headers: dict[str, str] = {}
    name = ""
    for line in lines:
        if name and line[:1] in (b" ", b"\t"):  # a header that goes on
            headers[name] += " " + line.decode(errors="replace").strip()
            continue
        name, colon, value = line.decode(errors="replace").partition(":")
        if not colon:
            raise ValueError(f"a header without a colon: {name}")
        name = name.strip().lower()
        headers[name] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"a record without {name}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"a block of {len(rest) - 4} bytes that should have {length}")
    return headers, rest[:length]


def dictionary_of(archive: memoryview) -> tuple[bytes, int]:
    """The dictionary in the leading frame, empty where there is none, and where the records begin."""
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_MAGIC:
        return b"", 0
    end = frame_end(archive, 0)
    stored = bytes(archive[8:end])
    if stored[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary itself is compressed
        stored = zstd.ZstdDecompressor().decompressobj().decompress(stored)
    return stored, end


def read_archive(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one frame at a time."""
    view = memoryview(archive)
    stored, at = dictionary_of(view)
    reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(stored) if stored else None)
    while at < len(view):
        end = frame_end(view, at)
        if struct.unpack_from("<I", view, at)[0] == FRAME_MAGIC:
            yield parse(reader.decompressobj().decompress(view[at:end]))
        at = end


def _writer(dictionary: bytes):
    """Pages to archives of bounded size."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstd.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        frames, size = [leading_frame(dictionary)], 0
        for batch in batches:
            for page in batch.to_pylist():
                headers = [
                    ("WARC-Type", "revisit" if page["refers_to"] is not None else "response"),
                    ("WARC-Record-ID", f"<urn:page:{'' if page['page_id'] is None else page['page_id']}>"),
                    ("WARC-Date", _ZERO_DATE),
                    ("WARC-Payload-Digest", f"sha256:{page['payload_digest']}"),
                ]
                if page["url"] is not None:  # a header is one line
                    headers.append(("WARC-Target-URI", " ".join(page["url"].split())))
                block = page["html"].encode()
                if page["refers_to"] is not None:
                    headers += [
                        ("WARC-Profile", REVISIT_PROFILE),
                        ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>"),
                        ("WARC-Refers-To-Length", str(len(block))),
                    ]
                    block = b""
                frames.append(packer.compress(record(headers, block)))
                size += len(frames[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])
                    frames, size = [leading_frame(dictionary)], 0
        if len(frames) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])

    return write


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives (archive binary) of all pages, stored in the shared folder by Spark's own committer.

    A null payload is empty. Of payloads of LEAST_PAYLOAD bytes and more that are equal, the one
    with the smallest page_id is a response; every other row revisits it, also a repeated row
    with that id only if it has another id: rows that repeat the smallest id are all responses.
    Payloads without any page_id are responses. Other columns are not read.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    ).withColumn("payload_digest", F.sha2("html", 256))
    # copies of a payload meet as one row of two numbers; only payloads with several ids come back
    first = (
        rows.where(F.octet_length("html") >= LEAST_PAYLOAD)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .where("first_id < last_id")
        .drop("last_id")
    )
    rows = rows.join(first, "payload_digest", "left")
    rows = rows.withColumn("refers_to", F.expr("CASE WHEN page_id IS NULL OR page_id > first_id THEN first_id END"))
    archives = rows.drop("first_id").mapInArrow(_writer(train(pages, html)), "archive binary")
    return materialise(archives, "warc")[0]


RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def _page_of(urn: str | None) -> int | None:
    """The page in a record id of this package; None for any other."""
    known = _OWN_URN.fullmatch(urn or "")
    return int(known[1]) if known else None


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What a record is about: the body of an HTTP message, else the whole block."""
    if headers.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def check_payload(headers: dict[str, str], payload: bytes) -> str | None:
    """The payload's SHA-256: computed if the record carries it, else as a header says; ValueError if a digest differs."""
    kind, _, stated = headers.get("warc-payload-digest", "").partition(":")
    if headers["warc-type"] == "revisit":
        return stated if kind == "sha256" else None
    if kind in ("sha1", "sha256", "md5") and stated:
        own = hashlib.new(kind, payload)
        # writers state digests in base 32 or in hexadecimal digits
        if stated.lower() != own.hexdigest() and stated.upper().rstrip("=") != base64.b32encode(own.digest()).decode().rstrip("="):
            raise ValueError(f"{headers['warc-record-id']}: the payload does not have its digest")
    return hashlib.sha256(payload).hexdigest()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0):
            out = []
            for headers, block in read_archive(archive.as_py()):
                kind, payload = headers["warc-type"], payload_of(headers, block)
                digest = check_payload(headers, payload)
                size = headers.get("warc-refers-to-length") if kind == "revisit" else len(payload)
                out.append(
                    {
                        "page_id": _page_of(headers["warc-record-id"]),
                        "url": headers.get("warc-target-uri"),
                        "payload_bytes": None if size is None else int(size),
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": _page_of(headers.get("warc-refers-to")),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ]))


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives, headers, lengths and payload digests checked; a broken archive stops the job.

    Of records by other writers ``page_id`` and ``refers_to`` are null, and so are a revisit's size and SHA-256 where it
    does not state them. An empty binary is an archive without records.
    """
    batches = archives.sparkSession
    small_batches(batches)
    return archives.select("archive").mapInArrow(_read, RECORDS)
