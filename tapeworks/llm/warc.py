"""WARC archives in Zstandard: written from pages, one frame per record, and read back with every length checked.

An archive begins with the dictionary in a skippable frame; each record is a frame of its own, so any one can be
decoded alone. Spark's text writer writes the frames, one per line, which gives the archives its commit protocol and
any file system it knows; the "line ends" are empty skippable frames, which readers pass over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.skew import left_lookup
from tapeworks.llm.columns import stage
from tapeworks.llm.components import HOT_ROWS
from tapeworks.llm.labelled import sampled

# Fixed values of the formats: magic numbers of skippable frames, and what a record's head says.
DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Target-URI", "WARC-Payload-Digest",
            "WARC-Block-Digest")
# Records that are not of a page: passed over, once their lengths and digests have been found right.
OTHER_TYPES = frozenset(["warcinfo", "request", "metadata", "resource", "conversion", "continuation"])
# A dictionary frame may hold the dictionary as one compressed frame, which begins like this.
COMPRESSED = b"\x28\xb5\x2f\xfd"
RECORD_URN = "urn:tapeworks:page:"

# An archive ends after so many frames, or so many bytes; so it fits a task's memory whole.
ARCHIVE_FRAMES = 1024
ARCHIVE_BYTES = 32 << 20
# The dictionary is trained on at most so many pages, none longer than PAGE_CHARS.
DICTIONARY_PAGES = 300
PAGE_CHARS = 1 << 15
DICTIONARY_BYTES = 1 << 15
# Repeated payloads are broadcast up to this many; beyond that they are joined by a shuffle.
BROADCAST_ROWS = 10_000

RECORD_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long")


class BrokenArchive(ValueError):
    """An archive whose frames, heads or lengths do not fit together."""


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One response, or a revisit that names the page whose payload is the same and leaves it out."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{RECORD_URN}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
    }
    if refers_to is None:
        block += payload
    else:
        head |= {"WARC-Profile": IDENTICAL_PAYLOAD, "WARC-Refers-To": f"<{RECORD_URN}{refers_to}>"}
    head |= {"WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Type": "application/http; msgtype=response",
             "Content-Length": str(len(block))}
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _heads(data: bytes, first: str) -> tuple[dict[str, str], bytes]:
    """The fields of a head that begins with ``first``, by their names in small letters, and what follows it."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    try:
        lines = head.decode().split("\r\n")
    except UnicodeDecodeError as broken:
        raise BrokenArchive(f"a head that is not UTF-8: {broken}") from broken
    if not gap or not lines[0].startswith(first):
        raise BrokenArchive(f"no {first} head")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon or name in fields:
            raise BrokenArchive(f"bad header line {line!r}")
        fields[name] = value.strip()
    return fields, rest


def _length(fields: dict[str, str]) -> int:
    """What a head says of the length of its body."""
    value = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", value):
        raise BrokenArchive(f"Content-Length {value!r}")
    return int(value)


def _page(urn: str) -> int | None:
    match = re.fullmatch(rf"<{RECORD_URN}(-?\d*)>", urn)
    if match is None:
        raise BrokenArchive(f"unknown record {urn}")
    return int(match[1]) if match[1] else None


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None


def parsed(data: bytes) -> Record | None:
    """The record in one frame's content; None for one that is of no page, as the description of an archive.

    Raises if a head, length or digest is not as it must be. Names of fields may be in any case.
    """
    head, rest = _heads(data, VERSION)
    kind = head.get("warc-type", "").lower()
    needed = REQUIRED if kind not in OTHER_TYPES else REQUIRED[:4]
    if missing := [name for name in needed if name.lower() not in head]:
        raise BrokenArchive(f"without {missing}")
    length = _length(head)
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise BrokenArchive(f"Content-Length {length}, but {len(rest) - 4} bytes")
    if head.get("warc-block-digest", f"sha1:{digest_of(block)}") != f"sha1:{digest_of(block)}":
        raise BrokenArchive("block digest")
    if kind in OTHER_TYPES:
        return None
    http, payload = _heads(block, "HTTP/")
    size, digest = _length(http), head["warc-payload-digest"].removeprefix("sha1:")
    page_id, url = _page(head["warc-record-id"]), head["warc-target-uri"]
    if kind == "revisit":
        if payload or head.get("warc-profile") != IDENTICAL_PAYLOAD:
            raise BrokenArchive("revisit of an unknown profile, or with a payload")
        return Record(page_id, url, None, size, digest, kind, _page(head.get("warc-refers-to", "")))
    if kind != "response" or len(payload) != size or digest_of(payload) != digest:
        raise BrokenArchive(f"{kind} payload of {len(payload)} bytes, {size} declared")
    return Record(page_id, url, payload, size, digest, kind, None)


def frames(archive: bytes) -> Iterator[bytes]:
    """The content of each frame of an archive, decoded with the dictionary that leads it."""
    import zstandard

    view, at = memoryview(archive), 0
    decoder = zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise BrokenArchive(f"{len(view) - at} bytes after the last frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + size
            if end > len(view):
                raise BrokenArchive("skippable frame cut short")
            if magic == DICTIONARY_FRAME:
                if at:
                    raise BrokenArchive("a dictionary that does not lead the archive")
                held = bytes(view[8:end])
                if held.startswith(COMPRESSED):
                    held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
                trained = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_FULLDICT)
                decoder = zstandard.ZstdDecompressor(dict_data=trained)
            at = end
            continue
        frame, content, step = decoder.decompressobj(), [], 1 << 14
        while not frame.eof:
            if at >= len(view):
                raise BrokenArchive("frame cut short")
            piece = view[at : at + step]
            content.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(content)


def _dictionary(pages: DataFrame, html: str, id_col: str) -> bytes:
    """A dictionary trained on the first pages by hash, none of them long; empty if there are too few to train on."""
    import zstandard

    short = pages.filter(F.col(id_col).isNotNull() & (F.length(html) <= PAGE_CHARS)).select(id_col, html)
    rows = sampled(short, id_col, DICTIONARY_PAGES).collect()
    samples = [record(r[0], None, r[1].encode(), None, "1970-01-01T00:00:00Z") for r in rows]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from: the samples are tiny or all alike
        return b""


def planned(pages: DataFrame, min_bytes: int, id_col: str, url: str, html: str) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of at least min_bytes all but the first refer to it."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    repeated = stage(rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1"), "warc-repeated")
    if repeated.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(repeated.drop("rows")), "digest", "left")
    else:
        joined = left_lookup(rows, repeated, ["digest"], "rows", HOT_ROWS).withColumn("first", F.col("found.first"))
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
          id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes a record for every page to archives in the folder.

    The payload is the html in UTF-8, null like empty. Of pages with equal payloads of at least ``min_bytes`` those
    with the smallest id are responses and the others revisit it; smaller ones are all responses. Repeated rows get
    a record each. A null id is no id to revisit; a null url is written as about:blank. An empty table gives no
    archive.
    """
    dictionary = _dictionary(pages, html, id_col)
    lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else EMPTY_FRAME

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        held, written = ARCHIVE_FRAMES, 0
        for batch in batches:
            out = []
            for page_id, address, text, first in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if written >= ARCHIVE_BYTES:
                    out += [EMPTY_FRAME] * (ARCHIVE_FRAMES - held)
                    held = ARCHIVE_FRAMES
                if held == ARCHIVE_FRAMES:
                    out.append(lead)
                    held, written = 1, len(lead)
                frame = encoder.compress(record(page_id, address, text.encode(), first, date))
                out.append(frame)
                held, written = held + 1, written + len(frame)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    lines = planned(pages, min_bytes, id_col, url, html).mapInArrow(run, "frame binary")
    lines.select(F.col("frame").cast("string").alias("value")).write.mode("error") \
        .option("lineSep", EMPTY_FRAME.decode()).option("maxRecordsPerFile", ARCHIVE_FRAMES).text(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all archives in the folder, each checked; one that is broken fails the read.

    A revisit has no payload of its own, but the length and digest of the payload that it refers to.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
                held: list[Record] = []
                size = 0
                try:
                    for frame in frames(content):
                        found = parsed(frame)
                        held += [found] if found is not None else []
                        size += len(frame)
                        if size > 8 << 20:
                            yield _rows(held, schema, payload)
                            held, size = [], 0
                except BrokenArchive as broken:
                    raise BrokenArchive(f"{path}: {broken}") from broken
                yield _rows(held, schema, payload)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def _rows(records: list[Record], schema: pa.Schema, payload: bool) -> pa.RecordBatch:
    columns = [[getattr(r, name) if name != "payload" or payload else None for r in records] for name in schema.names]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
