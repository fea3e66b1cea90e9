"""WARC archives: one gzip member per record, revisit records for repeated payloads,
and a splittable reader.

A reading task gets a byte range. It looks for gzip magic inside its range, takes a
candidate for a record only if the decoded bytes begin with a WARC version line, and
owns exactly the records that start inside the range, to whose ends it reads on.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, in_arrow, publish, ship, stash

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
CHUNK = 1 << 20
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORD = ("path string, offset long, record_id string, record_type string, target_uri string, refers_to_id string, "
          "payload_digest string, payload_bytes long, payload binary")


def mark_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """``(key, url, html, refers_to)``: of pages with equal payloads of ``min_bytes`` or more
    the largest key is the original, to which the others refer; NULL for originals.

    A NULL payload is empty. Rows that share the largest key are all originals, and so is
    every row of a group whose keys are all NULL; other rows with a NULL key refer to it.
    Digests are reduced before the join, so a payload of any frequency sends one row per task.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    groups = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("key").alias("original"), F.count("*").alias("n"))
    joined = rows.join(groups.where("n > 1").drop("n"), "digest", "left")
    short = F.octet_length("html") < min_bytes
    return joined.select("key", "url", "html", F.when(~short & ~F.col("key").eqNullSafe(F.col("original")), F.col("original")).alias("refers_to"))


def _urn(key: int | None) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def _record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(key)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def write_archives(marked: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of ``mark_revisits`` as ``part-NNNNN.warc.gz``, one file per non-empty
    partition; returns the manifest ``(path, bytes, records)``, itself written beside them.
    Records are streamed; a task holds one batch of pages. An empty table writes no file."""
    ship(marked.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        waiting = (b for b in batches if b.num_rows)
        first = next(waiting, None)
        if first is None:
            return
        done = [0, 0]

        def fill(out: pa.NativeFile) -> None:
            batch = first
            while batch is not None:
                for key, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "html", "refers_to"))):
                    member = _record(key, url, html.encode("utf-8"), refers_to, date)
                    out.write(member)
                    done[0] += len(member)
                    done[1] += 1
                batch = next(waiting, None)

        publish(path, fill)
        yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [done[0]], "records": [done[1]]})

    return stash(marked.mapInArrow(write, MANIFEST), "warc-manifest")


class _Tape:
    """Bytes of a file from an offset on, fetched in chunks."""

    def __init__(self, file: pa.NativeFile, start: int):
        self.file, self.base, self.data, self.ended = file, start, b"", False
        file.seek(start)

    def more(self) -> bool:
        chunk = b"" if self.ended else self.file.read(CHUNK)
        self.ended = not chunk
        self.data += chunk
        return bool(chunk)

    def forget(self, upto: int) -> None:
        self.data = self.data[upto - self.base:]
        self.base = upto


def _member(tape: _Tape, at: int) -> tuple[bytes, int] | None:
    """Decoded member that starts at ``at`` and the offset after it, or None if the bytes
    there are no record."""
    decode, out, used = zlib.decompressobj(31), [], at - tape.base
    head = b""
    while True:
        chunk = tape.data[used:used + 65536]
        if not chunk:
            if tape.more():
                continue
            return None
        try:
            plain = decode.decompress(chunk)
        except zlib.error:
            return None
        used += len(chunk)
        out.append(plain)
        if len(head) < len(VERSION):
            head += plain[:16]
            if len(head) >= len(VERSION) and not head.startswith(VERSION):
                return None
        if decode.eof:
            return (b"".join(out), tape.base + used - len(decode.unused_data)) if head.startswith(VERSION) else None


def records_in(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and decoded bytes of every record that starts in ``[start, end)``."""
    tape, at = _Tape(file, start), start
    while at < end:
        found = tape.data.find(MAGIC, at - tape.base)
        if found < 0:
            at = max(at, tape.base + len(tape.data) - len(MAGIC) + 1)
            if not tape.more():
                return
            continue
        at = tape.base + found
        if at >= end:
            return
        member = _member(tape, at)
        if member is None:
            at += 1
            continue
        yield at, member[0]
        at = member[1]
        if at - tape.base > CHUNK:
            tape.forget(at)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _parse(path: str, offset: int, raw: bytes, payloads: bool) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields.get("content-length", "0"))]
    payload, size, digest = block, len(block), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if fields.get("warc-type") == "revisit":
            size = int(_fields(http).get("content-length", "0"))
    if fields.get("warc-type") != "revisit":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (path, offset, fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
            digest, size, payload if payloads and fields.get("warc-type") != "revisit" else None)


def read_archives(spark: SparkSession, files: DataFrame, split_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """Records of gzipped WARC files given as ``(path, bytes)``, split by byte range.

    Payload digests and lengths of records with a payload are computed from the payload;
    those of revisits, which have none, come from their headers. Bytes that decode to no
    record are skipped. ``payloads=False`` leaves the payload column NULL.
    """
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    tasks = max(1, int(ranges.count()))
    spread = ranges.repartition(min(tasks, 100_000), "path", "start")

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "bytes"))):
            fs, local = filesystem(path)
            rows, held = [], 0
            with fs.open_input_file(local) as file:
                for offset, raw in records_in(file, start, min(start + split_bytes, size)):
                    rows.append(_parse(path, offset, raw, payloads))
                    held += len(raw) if payloads else 0
                    if len(rows) >= 1000 or held > 16_000_000:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)

    return in_arrow(spread, read, RECORD)


_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                    ("refers_to_id", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def page_key(urn: str) -> Column:
    """Integer key inside a record id of ``write_archives``; NULL where it has none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
