"""WARC records in seekable Zstandard bundles (operator 8).

Method.  Each page becomes a WARC/1.1 record.  Of records with equal payloads
of at least ``min_revisit_bytes`` bytes the one with the smallest page_id is a
``response``; the others are ``revisit`` records that refer to it and hold no
payload.  A task groups its records into independent Zstandard frames of about
``frame_bytes`` and appends frames to a bundle of about ``bundle_bytes``, which
ends in the footer of the public seekable format: a skippable frame with every
frame's compressed and plain size.  Beside the bundle goes the index, record
identifier -> (frame, offset in the frame, length): one frame is enough to read
a record.  Bundles are rows of a table (``archive`` is a whole .warc.zst file),
so they live in any store that Spark can write, and a lost task is written
again.

Scale.  Pages are not shuffled.  Only digests found more than once are
grouped (partial counts first) and joined back through ``attach``.

Cases.  Null html: empty payload.  Null url: no target header; control
characters in a url are percent-encoded.  Null page_id: sorts last, so it
refers to a page with an id if one has the payload, and is ``response`` if
none has.  Rows that repeat the smallest page_id of a payload are all
``response``.  Empty table: no bundle.  Only ``page_id``, ``url`` and ``html``
are archived; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import attach, materialize, short_batches

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
LEVEL = 3
#: Fixed values of the public seekable format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
BUNDLE_SCHEMA = ("archive binary, ids array<string>, frames array<int>, offsets array<int>, "
                 "lengths array<int>")
RECORD_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    number = identifier[len("<urn:page:"):-1] if identifier else ""
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    block = HTTP % len(payload) + (b"" if revisit else payload)
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE),
               ("WARC-Payload-Digest", "sha1:" + digest_of(payload)),
               ("WARC-Payload-Length", str(len(payload)))]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(
            r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record: {version[:20]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
            payload if fields["WARC-Type"] == "response" else None, size, digest,
            fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")))


class Bundle:
    """A bundle being written."""

    def __init__(self):
        self.done, self.sizes, self.open, self.open_bytes, self.index = [], [], [], 0, []
        self.plain = 0

    def add(self, identifier: str, raw: bytes, frame_bytes: int) -> None:
        if self.open and self.open_bytes + len(raw) > frame_bytes:
            self.close_frame()
        self.index.append((identifier, len(self.done), self.open_bytes, len(raw)))
        self.open.append(raw)
        self.open_bytes += len(raw)
        self.plain += len(raw)

    def close_frame(self) -> None:
        import zstandard
        if self.open:
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.open))
            self.done.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def row(self) -> tuple:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        table = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer
        return b"".join(self.done) + table, *map(list, zip(*self.index))


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(place, compressed size, plain size) of every frame, from the footer."""
    frames, descriptor, magic = struct.unpack("<IBI", archive[-9:])
    width = 12 if descriptor & 0x80 else 8
    start = len(archive) - 9 - frames * width
    skippable, size = struct.unpack("<II", archive[start - 8:start])
    if magic != SEEKABLE_MAGIC or skippable != SKIPPABLE_MAGIC or size != frames * width + 9:
        raise ValueError("no seek table at the end of the archive")
    out, at = [], 0
    for i in range(frames):
        packed, plain = struct.unpack_from("<II", archive, start + i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def frame(archive: bytes, place: tuple[int, int, int]) -> bytes:
    import zstandard
    at, size, plain = place
    return zstandard.ZstdDecompressor().decompress(archive[at:at + size], max_output_size=plain)


def write_bundles(pages: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  min_revisit_bytes: int = 0) -> DataFrame:
    """Bundles of all pages: ``archive`` and its index (``BUNDLE_SCHEMA``)."""
    short_batches(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"),
                        F.sha1(html.cast("binary")).alias("digest"))
    again = (rows.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
             .filter("n > 1").drop("n"))
    again = materialize(again, "warc-repeats")
    rows = attach(rows, again, ["digest"], F.xxhash64("page_id", "url")).select(
        "page_id", "url", "html",
        F.when(F.col("page_id").isNull() | (F.col("first") < F.col("page_id")), F.col("first"))
        .alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["archive", "ids", "frames", "offsets", "lengths"]
        bundle = Bundle()
        for batch in batches:
            for values in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                page_id, url, text, refers_to = values
                page_id = None if page_id is None else int(page_id)
                refers_to = None if refers_to is None else int(refers_to)
                bundle.add(record_id(page_id), record(page_id, url, text.encode(), refers_to), frame_bytes)
                if bundle.plain >= bundle_bytes:
                    yield pd.DataFrame([bundle.row()], columns=names)
                    bundle = Bundle()
        if bundle.index:
            yield pd.DataFrame([bundle.row()], columns=names)

    return rows.mapInPandas(write, BUNDLE_SCHEMA)


def _records(frames: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(frames, columns=["page_id", "url", "payload", "payload_bytes", "payload_digest",
                                        "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_records(bundles: DataFrame, wanted: DataFrame | None = None, payload: bool = True) -> DataFrame:
    """Records read back from bundles through index and seek table, digests
    checked.  ``wanted``: a column ``page_id``; then only the frames that hold
    these records are decompressed."""
    index = bundles
    if wanted is not None:
        entry = F.explode(F.arrays_zip("ids", "frames", "offsets", "lengths"))
        identifier = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
        index = (bundles.select(F.md5("archive").alias("bundle"), entry.alias("e")).select("bundle", "e.*")
                 .join(wanted.select(identifier.alias("ids")).distinct(), "ids", "left_semi")
                 .groupBy("bundle").agg(*[F.collect_list(c).alias(c) for c in ("ids", "frames", "offsets", "lengths")]))
        index = bundles.select("archive", F.md5("archive").alias("bundle")).join(index, "bundle").drop("bundle")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, frames, offsets, lengths in batch.itertuples(index=False):
                archive, order = bytes(archive), sorted(zip(frames, offsets, lengths))
                places, open_at, plain, out = seek_table(archive), -1, b"", []
                for number, offset, length in order:
                    if number != open_at:
                        open_at, plain = number, frame(archive, places[number])
                    found = parsed(plain[offset:offset + length])
                    out.append(found if payload else (*found[:2], None, *found[3:]))
                yield _records(out)

    # Each row is a whole bundle: few of them to an Arrow batch.
    return index.select("archive", "frames", "offsets", "lengths").mapInPandas(read, RECORD_SCHEMA)
