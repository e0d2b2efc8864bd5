"""WARC archives as seekable Zstandard bundles.

Tasks write bundles: records grouped in independent Zstandard frames, closed by a seek table
in a skippable frame (the published seekable format), so any Zstandard reader reads a bundle
as a plain WARC file and a seeking one opens a single frame.  An index maps every record to
its bundle, the number of its frame and its offset inside the frame; the reader finds the frame
by the seek table (the index also says where it was written, which tests compare).  Only
bundles of finished tasks appear in the index, so lost or repeated tasks leave no trace in
what is read back.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, functions as F

from .shared import new_folder, saved, small_batches

#: Payloads shorter than this are never replaced by a revisit record.
LEAST_SHARED = 100
FRAME_BYTES = 256 << 10
#: Payloads handed to Spark at a time.
BATCH_BYTES = 8 << 20
BUNDLE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"

# fixed values of the WARC and seekable Zstandard formats
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Frames of a bundle that a task reads one after the other, through one open file.
FRAMES_TOGETHER = 64

INDEX = ("page_id bigint, bundle string, frame int, frame_offset bigint, frame_bytes bigint, "
         "offset bigint, n_bytes bigint")
RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
          "payload_digest string, payload binary")


def _open(folder: str):
    """A file system and a path in it, for a URI that Spark knows."""
    uri = re.sub("^s3a:", "s3:", re.sub("^file:/(?!/)", "file:///", folder))
    return pafs.FileSystem.from_uri(uri)


def _clean(text: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def warc_record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to, date: str) -> bytes:
    """One record; a revisit has the HTTP head of its response but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The columns of ``RECORD``; length and digest of a response are taken from its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: (int(x) if (x := fields[name][len("<urn:page:"):-1]) else None)
    kind = fields["WARC-Type"]
    if kind == "response":
        n_bytes, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        n_bytes = int(http.decode().rpartition("Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].partition(":")[2]
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": page("WARC-Refers-To") if kind == "revisit" else None,
            "payload_bytes": n_bytes, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


class _Bundle:
    """A bundle being written; gives the index rows of every closed frame."""

    def __init__(self, folder: str, frame_bytes: int):
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.uri, self.out = f"{folder}/{name}", fs.open_output_stream(f"{path}/{name}", compression=None)
        self.frame_bytes, self.size, self.frames = frame_bytes, 0, []
        self.frame, self.waiting = bytearray(), []

    def add(self, page_id, record: bytes) -> list[dict]:
        self.waiting.append({"page_id": page_id, "offset": len(self.frame), "n_bytes": len(record)})
        self.frame += record
        return self.close_frame() if len(self.frame) >= self.frame_bytes else []

    def close_frame(self) -> list[dict]:
        if not self.waiting:
            return []
        packed = zstandard.ZstdCompressor(level=3).compress(bytes(self.frame))
        self.out.write(packed)
        rows = [row | {"bundle": self.uri, "frame": len(self.frames), "frame_offset": self.size,
                       "frame_bytes": len(packed)} for row in self.waiting]
        self.frames.append((len(packed), len(self.frame)))
        self.size += len(packed)
        self.frame, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[dict]:
        rows = self.close_frame()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return rows


def seek_table(bundle: str) -> list[tuple[int, int, int]]:
    """``(offset, bytes, bytes unpacked)`` of every frame, from the footer of a bundle alone."""
    fs, path = _open(bundle)
    with fs.open_input_file(path) as file:
        return _frames(file)


def _frames(file) -> list[tuple[int, int, int]]:
    size = file.size()
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("a bundle without a seek table")
    file.seek(size - 9 - 8 * n)
    found, at = [], 0
    for packed, unpacked in struct.iter_unpack("<II", file.read(8 * n)):
        found.append((at, packed, unpacked))
        at += packed
    return found


def with_revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Adds ``payload_bytes, payload_digest, refers_to`` to ``page_id, url, html``.

    Only ids and digests are compared.  The counts are combined before the shuffle; the join
    of a payload that a third of all pages share is one that adaptive execution splits.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    n_bytes = F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint")
    ids = pages.select("page_id", digest.alias("payload_digest"), n_bytes.alias("n")).where(f"n >= {int(least)}")
    first = saved(ids.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("c"))
                  .where("c > 1").select("payload_digest", "refers_to"), "first-pages")
    revisits = saved(ids.join(first, "payload_digest").where("page_id > refers_to")
                     .select("page_id", "payload_digest", "refers_to").distinct(), "revisits")
    rows = pages.select("page_id", "url", "html", n_bytes.alias("payload_bytes"), digest.alias("payload_digest"))
    return rows.join(revisits, ["page_id", "payload_digest"], "left")


def write_bundles(pages: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, date: str = DATE, least: int = LEAST_SHARED) -> DataFrame:
    """Writes a record per row of ``pages`` (``page_id, url, html``); returns the index.

    A null html is an empty payload; a null url leaves the target out (control characters in
    one are percent-encoded); a null page_id makes a response without a number.  Of equal
    payloads of ``least`` bytes or more, that of the smallest page_id is the response, others
    revisit it; rows equal in page_id and payload are all of the same kind.  An empty table
    gives an empty index.  Other columns are not read.
    """
    small_batches(pages.sparkSession)
    folder = folder or new_folder(pages.sparkSession, "warc")

    def write(batches):
        bundle = None
        for batch in batches:
            rows = []
            for page in batch.to_pylist():
                payload = (page["html"] or "").encode()
                record = warc_record(page["page_id"], page["url"], payload, page["payload_digest"],
                                     page["payload_bytes"], page["refers_to"], date)
                bundle = bundle or _Bundle(folder, frame_bytes)
                rows += bundle.add(page["page_id"], record)
                if bundle.size >= bundle_bytes:
                    rows += bundle.close()
                    bundle = None
            yield from _index_batch(rows)
        if bundle:
            yield from _index_batch(bundle.close())

    return saved(with_revisits(pages, least).mapInArrow(write, INDEX), "warc-index")


def _index_batch(rows):
    if rows:
        schema = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
                            ("frame_offset", pa.int64()), ("frame_bytes", pa.int64()),
                            ("offset", pa.int64()), ("n_bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema)


def read_records(index: DataFrame, partitions: int | None = None) -> DataFrame:
    """The records of an index, or of any part of it.

    Runs of ``FRAMES_TOGETHER`` frames are dealt to ``partitions`` tasks (default: the session's
    shuffle partitions; the rows of an index are light, and tasks sized by them would unpack
    whole archives).  A task opens a bundle, finds the wanted frames by its seek table and
    unpacks one at a time.
    """
    n = partitions or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = F.floor(F.col("frame") / FRAMES_TOGETHER)
    dealt = index.select("bundle", "frame", "offset", "n_bytes").repartition(n, F.col("bundle"), run)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches):
        bundle, file, frames, at, unpacked = None, None, [], None, b""
        for batch in batches:
            records, size = [], 0
            for row in batch.to_pylist():
                if row["bundle"] != bundle:
                    if file:
                        file.close()
                    fs, path = _open(row["bundle"])
                    bundle, file, at = row["bundle"], fs.open_input_file(path), None
                    frames = _frames(file)
                if row["frame"] != at:
                    at = row["frame"]
                    start, packed, _ = frames[at]
                    file.seek(start)
                    unpacked = zstandard.ZstdDecompressor().decompress(file.read(packed))
                record = parse_record(unpacked[row["offset"]:row["offset"] + row["n_bytes"]])
                records.append(record)
                size += len(record["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(records, schema)
                    records, size = [], 0
            if records:
                yield pa.RecordBatch.from_pylist(records, schema)
        if file:
            file.close()

    return dealt.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, RECORD)


def q_op10_warc(spark, sf_dir):
    index = write_bundles(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages),
f as (select d, min(page_id) as first from p where n >= 100 group by d)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
    case when page_id > first then 'revisit' else 'response' end as record_type,
    case when page_id > first then first end as refers_to
from p left join f using (d)
"""
