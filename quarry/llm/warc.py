"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames followed by a seek table in
a skippable frame (the public seekable format: compressed and raw size per
frame, then the number of frames, a descriptor byte and a magic number).  A
frame holds whole WARC records; the index maps a record to its bundle, frame
and offset in the raw frame, so one record is read by one seek and one small
decompression.

Records of equal payloads (``min_revisit`` bytes or more) are stored once: the
one with the smallest id is the response, the others are revisits that refer
to it.  Every task writes bundles of its own, named by task attempt; only
bundles that the finished index names are part of the archive, so a lost
executor or a second attempt leaves at most unnamed files.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, ensure_checkpoint_dir, write_table

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 20, 256 << 20, 3
MIN_REVISIT = 100
#: tasks that read an archive at most; each then reads several bundles
MAX_TASKS = 20_000

_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_DATE = "1970-01-01T00:00:00Z"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path or URI of shared storage."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _uri(url) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace"))
                   for c in url or "")


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record."""
    head = [("WARC-Record-ID", _name(page_id)), ("WARC-Date", _DATE), ("WARC-Target-URI", _uri(url)),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", len(payload))]
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        kind, block = "response", http + payload
    else:
        kind, block = "revisit", http
        head += [("WARC-Refers-To", _name(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers, payload, end) of the record at ``at``; a revisit's payload
    is empty."""
    stop = raw.index(b"\r\n\r\n", at)
    head = dict(line.split(": ", 1) for line in raw[at:stop].decode().split("\r\n")[1:])
    block = raw[stop + 4:stop + 4 + int(head["Content-Length"])]
    return head, block[block.index(b"\r\n\r\n") + 4:], stop + 4 + len(block) + 4


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held, self.raw, self.frames, self.written = [], 0, [], 0

    def add(self, rec: bytes) -> tuple[int, int]:
        """(frame, offset in its raw bytes) of the record."""
        if self.held and self.raw + len(rec) > self.frame_bytes:
            self._flush()
        at = (len(self.frames), self.raw)
        self.held.append(rec)
        self.raw += len(rec)
        return at

    def _flush(self):
        if self.held:
            data = self.pack.compress(b"".join(self.held))
            self.out.write(data)
            self.frames.append((len(data), self.raw))
            self.written += len(data)
            self.held, self.raw = [], 0

    def close(self):
        self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(f) -> list[tuple[int, int, int]]:
    """[(start, compressed size, raw size)] of a bundle's frames."""
    end = f.seek(0, io.SEEK_END) if not hasattr(f, "size") else f.size()
    f.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != _SEEKABLE or flags & 0x80:
        raise ValueError("not a bundle")
    f.seek(end - 9 - 8 * n)
    raw, out, at = f.read(8 * n), [], 0
    for k in range(n):
        c, r = struct.unpack_from("<II", raw, 8 * k)
        out.append((at, c, r))
        at += c
    return out


def read_frame(f, entry) -> bytes:
    f.seek(entry[0])
    return zstandard.ZstdDecompressor().decompress(f.read(entry[1]), max_output_size=max(entry[2], 1))


def fetch(path: str, frame: int, offset: int) -> tuple[dict, bytes]:
    """One record by its place in the index."""
    fs, p = filesystem(path)
    with fs.open_input_file(p) as f:
        return parse(read_frame(f, seek_table(f)[frame]), offset)[:2]


def _write_task(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches):
        fs, base = filesystem(folder)
        ctx = TaskContext.get()
        writer, path, number = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    path = f"bundle-{ctx.partitionId():06d}-{number:04d}-{ctx.taskAttemptId()}.warc.zst"
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{path}", compression=None)  # Arrow goes by the name else
                    writer, number = BundleWriter(out, frame_bytes), number + 1
                frame, offset = writer.add(record(page_id, url, (html or "").encode(), digest, refers))
                rows.append((page_id, path, frame, offset))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in
                 enumerate((pa.int64(), pa.string(), pa.int32(), pa.int64()))],
                names=["id", "bundle", "frame", "offset"])
        if writer is not None:
            writer.close()
    return run


def _read_task(folder: str):
    def number(name):
        name = name[len("<urn:page:"):-1]
        return int(name) if name else None

    def run(batches):
        fs, base = filesystem(folder)
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                with fs.open_input_file(f"{base}/{bundle}") as f:
                    for entry in seek_table(f):
                        raw, at, rows = read_frame(f, entry), 0, []
                        while at < len(raw):
                            head, payload, at = parse(raw, at)
                            whole = head["WARC-Type"] == "response"
                            digest = (hashlib.sha256(payload).hexdigest() if whole
                                      else head["WARC-Payload-Digest"].partition(":")[2])
                            rows.append((number(head["WARC-Record-ID"]),
                                         len(payload) if whole else int(head["WARC-Payload-Length"]),
                                         digest, head["WARC-Type"],
                                         None if whole else number(head["WARC-Refers-To"])))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[k] for r in rows], t) for k, t in
                             enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                            names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return run


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_revisit: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the archive into ``folder`` (shared storage) and return its
    index: ``id, bundle, frame, offset``, one row per record.

    Edge cases: a null html is an empty payload; a null url an empty URI; a
    null id is never the response that others refer to while another id has
    the payload (records without id revisit that one); rows that repeat the
    smallest id are responses each; other columns aren't read; an empty table
    writes no bundle."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    src = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"),
                       html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    sizes = pages.select(F.col(id_col).cast("bigint").alias("id"), F.octet_length(html).alias("n"),
                         F.sha2(html.cast("binary"), 256).alias("digest"))
    first = write_table(sizes.where(F.col("n") >= min_revisit).groupBy("digest")
                        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
                        .where("copies > 1 AND first IS NOT NULL").select("digest", "first"), "first")
    refers = F.when(F.col("id").isNull() | (F.col("id") != F.col("first")), F.col("first"))
    rows = src.join(first, "digest", "left").select("id", "url", "html", "digest", refers.alias("refers"))
    index = write_table(rows.mapInArrow(_write_task(folder, frame_bytes, bundle_bytes),
                                        "id bigint, bundle string, frame int, offset bigint"), "warc-index")
    drop_table(first)
    return index


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that ``index`` names: ``id, payload_bytes,
    payload_digest, record_type, refers_to``.  Digests and sizes of responses
    are those of the payloads read; a revisit's are held against the responses
    of the id that it refers to, and null if none of them has that payload."""
    bundles = write_table(index.select("bundle").distinct(), "bundles")
    # a task per bundle, up to MAX_TASKS; a given number is not coalesced by the names' few bytes
    bundles = bundles.repartition(max(1, min(bundles.count(), MAX_TASKS)), "bundle")
    rows = write_table(bundles.mapInArrow(_read_task(folder), "id bigint, payload_bytes bigint, payload_digest string, "
                                                              "record_type string, refers_to bigint"), "records")
    payload = ["payload_bytes", "payload_digest"]
    # one row per payload referred to, however many revisits it has
    wanted = rows.where("record_type = 'revisit'").select("refers_to", *payload).distinct()
    held = rows.where("record_type = 'response'").select(F.col("id").alias("refers_to"), *payload)
    lost = write_table(wanted.join(held, ["refers_to", *payload], "left_anti"), "lost-payloads")
    found = rows.join(broadcast_if_small(lost.withColumn("lost", F.lit(True))), ["refers_to", *payload], "left")
    return found.select("id", *(F.when(F.col("lost").isNull(), F.col(c)).alias(c) for c in payload),
                        "record_type", "refers_to")


def round_trip(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write the pages as an archive below the checkpoint folder, read it
    back, and return one row per record."""
    folder = f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex[:12]}"
    back = read_archive(write_archive(pages, folder, id_col), folder)
    return back.withColumnRenamed("id", id_col)
