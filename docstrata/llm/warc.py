"""WARC archives: a writer, and a reader that splits files anywhere.

Each record is a gzip member of its own. Archives are written by tasks to files with
fresh names; a table of the files that tasks finished is the list to read, so a task
that ran twice leaves a file nobody reads. A reader task gets a range of bytes, looks
for the gzip magic from the start of its range, and takes a place for a member only if
it inflates to a WARC header; it owns the records that start in its range and reads on
past its end to finish the last one. Records are read one at a time.

Of records with the same payload the one with the largest id is the response; the
others are revisits, which carry no payload and name the response, by record id as the
format has it and by page id for the reader here.

Files are opened through Arrow's file systems, so the folder may be local to all
machines (``file:``, a mount) or an object store or HDFS that Arrow knows.

Defined cases: a null payload is an empty one; rows that repeat an id are records of
their own, all responses where the id is the largest of its payload; a null id ranks
below every other; records without our id header are returned with a null id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import Scratch, pick
from docstrata.sources.scratch import scratch_path
from docstrata.sources.tables import qualified

MAGIC = b"\x1f\x8b\x08"
PROBE = 1 << 12
BLOCK = 1 << 18
RANGE_BYTES = 8 << 20
FILE_BYTES = 256 << 20
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Ranges one task reads beyond 10,000 tasks.
RANGES_PER_TASK = 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(id_: int | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{id_}/{sha}')}>"


def record(
    kind: str, id_: int | None, url: str | None, body: bytes, size: int, sha: str, refers: int | None, date: str
) -> bytes:
    """One record as a gzip member. A revisit has no body but the size and digest of
    the payload it stands for."""
    block = _http(size) + body
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(id_, sha)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("WARC-Profile", _REVISIT if kind == "revisit" else None),
        ("WARC-Refers-To", _record_id(refers, sha) if kind == "revisit" else None),
        ("WARC-Identified-Payload-Type", "text/html"),
        ("X-Page-Id", id_),
        ("X-Refers-To", refers),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(text) + packer.flush()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _line(text: str | None) -> str | None:
    return None if text is None else re.sub(r"[\r\n]+", " ", text)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"\w+:/", path):
        return fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", path))
    return fs.LocalFileSystem(), path


def _writer(folder: str, file_bytes: int, date: str):
    """Rows of records to files; yields path, bytes and records of each finished file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        out, name, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch[c] for c in ("kind", "id", "url", "payload", "size", "digest", "refers")]
            for row in zip(*columns, strict=True):
                kind, id_, url, payload, length, sha, refers = (v.as_py() for v in row)
                body = payload if kind == "response" else b""
                member = record(kind, id_, url, body, length, sha, refers, date)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, count = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((name, size, count))
        if out is not None:
            out.close()
            done.append((name, size, count))
        names = [f"{folder}/{n}" for n, _, _ in done]
        arrays = [pa.array(names, pa.string())] + [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "bytes", "records"])

    return write


def archive(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the table of the files."""
    spark = pages.sparkSession
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").alias("id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.length("payload"))
    latest = rows.groupBy("sha", "size").agg(F.max("id").alias("last"))
    # Which rows are responses is a question to digests; bodies travel under their own id,
    # and those of revisits not at all.
    chosen = latest.select("last", F.col("sha").alias("_sha"), F.col("size").alias("_size"))
    same = F.col("id").eqNullSafe(F.col("last")) & (F.col("sha") == F.col("_sha")) & (F.col("size") == F.col("_size"))
    responses = rows.join(chosen, same).select(
        F.lit("response").alias("kind"), "id", "url", "payload", "size", "sha", F.lit(None).cast("long").alias("refers")
    )
    revisits = rows.drop("payload").join(latest, ["sha", "size"]).where(~F.col("id").eqNullSafe(F.col("last")))
    revisits = revisits.select(
        F.lit("revisit").alias("kind"), "id", "url", F.lit(b"").alias("payload"), "size", "sha", F.col("last").alias("refers")
    )
    records = responses.unionByName(revisits).withColumn("digest", arrow_udf(_base32, "string")("sha"))
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return Scratch(spark, "warc-files").write(
        records.mapInArrow(_writer(folder, file_bytes, date), "path string, bytes bigint, records bigint")
    )


def _base32(digests: pa.Array) -> pa.Array:
    return pa.array([base64.b32encode(bytes.fromhex(d)).decode() for d in digests.to_pylist()], pa.string())


class _File:
    """Random access with one block kept."""

    def __init__(self, path: str):
        system, name = _open(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()
        self.at, self.block = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to n bytes; n is not above a block."""
        if not (self.at <= at and at + n <= self.at + len(self.block)):
            self.at, self.block = at, self.file.read_at(min(max(n, BLOCK), self.size - at), at)
        return self.block[at - self.at : at - self.at + n]


def _inflate(file: _File, at: int) -> tuple[bytes, int] | None:
    """The content of the WARC member at a place and where it ends, or None."""
    unpacker = zlib.decompressobj(31)
    try:
        content = unpacker.decompress(file.read(at, min(PROBE, file.size - at)))
        if not b"WARC/1.".startswith(content[:7]) or (unpacker.eof and len(content) < 7):
            return None
        parts, at = [content], at + PROBE
        while not unpacker.eof:
            if at >= file.size:
                return None
            parts.append(unpacker.decompress(file.read(at, min(BLOCK, file.size - at))))
            at += BLOCK
            if len(parts) == 2 and not (parts[0] + parts[1]).startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    end = min(at, file.size) - len(unpacker.unused_data)
    return b"".join(parts), end


def members(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of the WARC members that start from start up to end."""
    file = _File(path)
    at = start
    while at < min(end, file.size):
        window = file.read(at, min(BLOCK, min(end + len(MAGIC) - 1, file.size) - at))
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        member = _inflate(file, at)
        if member is None:
            at += 1
            continue
        yield at, member[0]
        at = member[1]


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    block = rest[: int(headers.get("content-length", len(rest)))]
    _, _, payload = block.partition(b"\r\n\r\n")
    return headers, payload


_RECORD = (
    "path string, place bigint, page_id bigint, url string, record_type string, payload_digest string, "
    "payload_bytes bigint, refers_to bigint, payload binary"
)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    kinds += [pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for path, start, end in zip(*(batch[c].to_pylist() for c in ("path", "start", "end")), strict=True):
            rows, size = [], 0
            for place, content in members(path, start, end):
                headers, payload = parse(content)
                length = re.search(rb"\r\ncontent-length: *(\d+)", content.partition(b"\r\n\r\n")[2][:4096].lower())
                rows.append(
                    (
                        path,
                        place,
                        _number(headers.get("x-page-id")),
                        headers.get("warc-target-uri"),
                        headers.get("warc-type"),
                        headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        int(length[1]) if length else len(payload),
                        _number(headers.get("x-refers-to")),
                        payload,
                    )
                )
                size += len(payload)
                if size > 4 * BLOCK:
                    yield _batch(rows, names, kinds)
                    rows, size = [], 0
            yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def read(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the files in a table (path, bytes), a range of bytes per row."""
    ranges = files.select(
        "path", "bytes", F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {range_bytes}L)")).alias("start")
    ).select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    count = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    tasks = max(1, min(count, 10_000), -(-int(count) // RANGES_PER_TASK))
    spread = ranges.repartition(int(tasks), "path", "start")
    return spread.mapInArrow(_reader, _RECORD)


