"""WARC archives: one gzip member per record, and a splittable reader.

The writer puts each task's records into files in a folder that all executors share. The reader deals byte ranges of the
files to tasks. A task scans its range for the gzip magic, validates each candidate by decoding a member that starts with
a WARC version line, and owns the records that start inside its range; it reads past the end of the range to finish the
last one. Chance occurrences of the magic within compressed data fail the decoding and are passed over, and the inside of
a member that was decoded is skipped.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, shared_dir, stored

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record_bytes(kind: str, page: int | None, url: str | None, payload: bytes, sha: str, refers: int | None) -> bytes:
    """A WARC/1.1 record as one gzip member. A revisit holds the HTTP header only, with the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", "".join((url or "").splitlines())), ("WARC-Payload-Digest", f"sha1:{sha}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is not None:
        head += [("WARC-Refers-To", _urn(refers)), ("WARC-Profile", PROFILE)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))]) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A file per task, renamed when whole: an attempt that dies leaves nothing a reader takes."""
        task = TaskContext.get()
        fs, at = _open(folder)
        fs.create_dir(at, recursive=True)
        name = f"{at}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{name}.{task.taskAttemptId()}.draft"
        n = size = 0
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                for r in batch.to_pylist():
                    raw = record_bytes(r["kind"], r["page_id"], r["url"], (r["html"] or "").encode(), r["digest"], r["refers_to"])
                    out.write(raw)
                    n, size = n + 1, size + len(raw)
        fs.move(draft, name)
        yield pa.RecordBatch.from_pydict({"path": pa.array([os.path.basename(name)]), "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return run


def _shas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        shas = [digest((x.as_py() or "").encode()) for x in b.column("html")]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shas, pa.string())], names=[*b.schema.names, "digest"])


def write_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html; other columns are ignored) below folder; returns path, records, bytes.

    Of rows with equal payloads of least_bytes or more, the one with the largest page_id is a response and the others are
    revisits of it; smaller payloads are all responses. Null html is an empty payload, null url an empty target. A row
    without a page_id has a record without a number: a revisit if a copy has a page_id, else a response; rows that repeat
    the largest page_id are responses too. The folder must be shared.
    """
    n = partitions(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    sized = F.octet_length(F.coalesce("html", F.lit("")))
    # The copies of one payload may be a third of all rows: each gets one of n salts, the largest id is found among the few
    # rows per payload and salt, and comes back to each salt. So no task meets all copies, and every html moves once.
    keyed = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(n)))
    parts = keyed.where(sized >= least_bytes).groupBy("sha", "salt").agg(F.max("page_id").alias("most"))
    heads = parts.join(parts.groupBy("sha").agg(F.max("most").alias("head")), "sha").select("sha", "salt", "head")
    decided = keyed.join(heads, ["sha", "salt"], "left").withColumn("refers_to", F.when((sized >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("head")), F.col("head")))
    decided = decided.select("page_id", "url", "html", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("kind"), "refers_to")
    shas = decided.mapInArrow(_shas, "page_id long, url string, html string, kind string, refers_to long, digest string")
    return shas.mapInArrow(_write(folder), "path string, records long, bytes long")


def members(read, start: int, end: int, step: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(position, content) of each gzip member that starts in [start, end) and holds a WARC record; read(position, n) gives bytes."""
    pos, window, base = start, b"", start
    while pos < end:
        if pos - base > len(window) - 3 or not window:
            base, window = pos, read(pos, step)
            if len(window) < 3:
                return
        hit = window.find(MAGIC, pos - base)
        if hit < 0:
            pos = base + max(1, len(window) - 2)
            if len(window) < step:
                return
            window = b""
            continue
        pos = base + hit
        if pos >= end:
            return
        length, content = _member(read, pos, window[hit:], step)
        if content is None:
            pos += 1
        else:
            yield pos, content
            pos += length


def _member(read, pos: int, have: bytes, step: int) -> tuple[int, bytes | None]:
    """Length and content of the member at pos; None if it isn't a whole gzip member that starts like a WARC record."""
    unpack, out, checked, used = zlib.decompressobj(31), bytearray(), False, 0
    try:
        while True:
            out += unpack.decompress(have)
            used += len(have)
            if not checked and len(out) >= 5:
                if out[:5] != b"WARC/":
                    return 0, None
                checked = True
            if unpack.eof:
                return used - len(unpack.unused_data), bytes(out) if checked else None
            have = read(pos + used, step)
            if not have:
                return 0, None
    except zlib.error:
        return 0, None


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the block; raises if the length is wrong."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("record length")
    return fields, rest[:n]


_READ = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _read(with_payload: bool):
    def page(x: str | None) -> int | None:
        number = (x or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for span in batch.to_pylist():
                fs, at = _open(span["file"])
                rows, held = [], 0
                with fs.open_input_file(at) as f:

                    def read(pos: int, n: int) -> bytes:
                        f.seek(pos)
                        return f.read(n)

                    for _, content in members(read, span["start"], span["end"]):
                        fields, block = parse(content)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = next(int(x[15:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length:"))
                        kind, sha = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != size or digest(payload) != sha):
                            raise ValueError(f"payload of {fields['warc-record-id']}")
                        rows.append((page(fields["warc-record-id"]), fields["warc-target-uri"], kind, page(fields.get("warc-refers-to")), sha, size, payload if with_payload and kind == "response" else None))
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return run


def read_archives(spark: SparkSession, folder: str, files: DataFrame, split_bytes: int = 8 << 20, payload: bool = True) -> DataFrame:
    """Records of the .warc.gz files (path, bytes) below folder, read in byte ranges of split_bytes.

    Returns page_id, url, record_type, refers_to, payload_digest, payload_bytes and the payload (null for revisits, or if
    payload is False). Payload digests are verified; a broken record of a valid member raises. No files: no rows.
    """
    spans = files.select(F.concat(F.lit(f"{folder}/"), "path").alias("file"), F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split_bytes}L)")).alias("start"))
    spans = spans.withColumn("end", F.col("start") + split_bytes)
    return spans.repartition(4 * partitions(spark), "file", "start").mapInArrow(_read(payload), _READ)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes pages to archives in the shared folder and reads their records back (without payloads)."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    files = stored(write_pages(pages, folder, least_bytes), "warc-files")
    return read_archives(spark, folder, files, payload=False)
