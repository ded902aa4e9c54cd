"""WARC archives with a two-level capture index.

Archives are gzip members, one for each record, written by each task into the shared
folder. The index sorts captures by reversed-host URL key into compressed blocks; every
index file ends in a sparse directory of its blocks' first keys, and one row for each
file (as many as partitions) tells its key range. A lookup searches the ranges, the
directory and the block by bisection, and then reads byte ranges of the archives.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import cut, partitions, shared_folder, small_batches

LEAST_BYTES = 100
BLOCK_LINES = 1000
FILE_BYTES = 1 << 28
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(base: str):
    from pyarrow import fs

    if base.startswith("file:"):
        base = base.removeprefix("file:")
    if "://" not in base:
        return fs.LocalFileSystem(), "/" + base.lstrip("/")
    return fs.FileSystem.from_uri(base)


def url_key(url: str | None) -> str:
    """The host's labels reversed, then path and query: com,example)/path?query. Scheme,
    user, a leading www., a default port and the fragment go; control characters and
    spaces are escaped. A null url has the empty key."""
    if not url:
        return ""
    clean = quote(url.strip(), safe="".join(chr(c) for c in range(33, 127)))
    m = re.match(r"(?i)(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", clean)
    if not m:
        return clean.partition("#")[0]
    host = re.sub(r":(80|443)?$", "", m[1].rpartition("@")[2].lower())
    host = host.removeprefix("www.")
    name, colon, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + colon + port + ")" + (m[2] or "/")


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, first_url: str | None) -> bytes:
    """One WARC record; first is the page it revisits, or None for a response."""
    line = lambda s: quote(s or "", safe="".join(chr(c) for c in range(33, 127)))
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if first is not None else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Target-URI: {line(url)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if first is not None:
        lines += [f"WARC-Refers-To: {name(first)}", f"WARC-Refers-To-Target-URI: {line(first_url)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one record; a length that does not fit raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    n = int(headers["Content-Length"])
    block, end = rest[:n], rest[n:]
    if len(block) != n or end != b"\r\n\r\n":
        raise ValueError("a record of another length than its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    return headers, fields, payload


def _marked(pages: DataFrame) -> DataFrame:
    """pages with payload, digest and the page that each one revisits (null: none)."""
    pages = small_batches(pages)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.length("payload") >= LEAST_BYTES)
    # One row a digest and task before the exchange, whatever its number of copies.
    first = large.groupBy("digest").agg(F.min(F.struct(F.col("page_id").alias("first"), F.col("url").alias("first_url"))).alias("f")).select("digest", "f.*")
    known = large.join(first, "digest").withColumn("again", ~F.col("page_id").eqNullSafe(F.col("first")))
    small = rows.where(F.length("payload") < LEAST_BYTES).select("*", F.lit(None).cast("long").alias("first"), F.lit(None).cast("string").alias("first_url"), F.lit(False).alias("again"))
    return known.unionByName(small)


def write_archives(pages: DataFrame, base: str) -> DataFrame:
    """Write one WARC record for each page; key, page_id, file, offset, length of each.

    pages: page_id, url, html; other columns are not read. Of records with equal payloads
    of at least 100 bytes the one with the smallest page_id is a response and the others
    are revisits of it; smaller ones are all responses. A null html is empty, a null url
    has no target, a null page_id no number; rows that repeat a page_id each get a record,
    of the kind that the page_id has. File names are new for every attempt, so a task that
    is run again does not meet its own remains.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(base)
        files.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, first, first_url, again in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(_record(page_id, url, payload, digest, first if again else None, first_url), 4, mtime=0)
                    out.write(data)
                    rows.append((url_key(url), page_id, name, at, len(data)))
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    marked = _marked(pages).select("page_id", "url", "payload", "digest", "first", "first_url", "again")
    return cut(marked.mapInArrow(run, "key string, page_id long, file string, offset long, length long"))


def write_index(captures: DataFrame, base: str) -> list[dict]:
    """Write the sorted block index; one small entry for each index file: its first and
    last key, its name, and where its directory lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(base)
        lines: list[str] = []
        directory: list[tuple[str, int, int]] = []
        out, at, low, high = None, 0, "", ""
        name = f"{uuid.uuid4().hex}.cdx"

        def block() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            directory.append((lines[0].partition("\t")[0], at, len(data)))
            at += len(data)
            lines = []

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out, low = files.open_output_stream(f"{root}/{name}", compression=None), row[0]
                high = row[0]
                lines.append("\t".join("" if x is None else str(x) for x in row))
                if len(lines) == BLOCK_LINES:
                    block()
        if out is None:
            return
        if lines:
            block()
        data = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(data)
        out.close()
        values = [low, high, name, at, len(data)]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["low", "high", "file", "offset", "length"])

    n = partitions(captures)
    ordered = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange(n, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    rows = ordered.mapInArrow(run, "low string, high string, file string, offset long, length long").collect()
    return sorted((r.asDict() for r in rows), key=lambda r: (r["low"].encode(), r["high"].encode()))


class Index:
    """Bisection from key ranges through a directory to a block; the last of each is kept."""

    def __init__(self, base: str, ranges: list[dict]):
        self.files, self.root = _filesystem(base)
        self.ranges = ranges
        self.highs = [r["high"].encode() for r in ranges]
        self.directories: dict[str, tuple] = {}
        self.block: tuple[str, int, list[str], list[bytes]] = ("", -1, [], [])

    def _directory(self, r: dict) -> tuple:
        if r["file"] not in self.directories:
            handle = self.files.open_input_file(f"{self.root}/{r['file']}")
            handle.seek(r["offset"])
            entries = json.loads(zlib.decompress(handle.read(r["length"])))
            self.directories = {r["file"]: (handle, entries, [e[0].encode() for e in entries])}
        return self.directories[r["file"]]

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """file, offset and length of every capture of the key."""
        k = key.encode()
        for i in range(bisect.bisect_left(self.highs, k), len(self.ranges)):
            r = self.ranges[i]
            if r["low"].encode() > k:
                return
            handle, entries, firsts = self._directory(r)
            # A key may begin at the end of the block before the first that starts with it.
            for j in range(max(0, bisect.bisect_left(firsts, k) - 1), len(entries)):
                if firsts[j] > k:
                    break
                if self.block[:2] != (r["file"], j):
                    handle.seek(entries[j][1])
                    lines = zlib.decompress(handle.read(entries[j][2])).decode().split("\n")
                    self.block = r["file"], j, lines, [x.partition("\t")[0].encode() for x in lines]
                _, _, lines, keys = self.block
                at = bisect.bisect_left(keys, k)
                while at < len(keys) and keys[at] == k:
                    _, _, file, offset, length = lines[at].split("\t")
                    yield file, int(offset), int(length)
                    at += 1


def look_up(keys: DataFrame, base: str, ranges: list[dict]) -> DataFrame:
    """file, offset, length of all captures of the keys (one column, key), by the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(base, ranges)
        for batch in batches:
            rows: list[tuple] = []
            for key in batch.column("key").to_pylist():
                for row in index.find(key):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _places(rows)
                        rows = []
            yield _places(rows)

    # Neighbouring keys in one task read each block once.
    return keys.select("key").distinct().repartitionByRange(partitions(keys), "key").sortWithinPartitions("key").mapInArrow(run, "file string, offset long, length long")


def _places(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["file", "offset", "length"])


def read_records(places: DataFrame, base: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of the records in
    these byte ranges; a response whose payload has another digest than its header fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(base)
        name, handle = "", None
        page = lambda s: int(s[10:-1]) if len(s) > 11 else None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, files.open_input_file(f"{root}/{file}")
                handle.seek(offset)
                headers, http, payload = parse_record(gzip.decompress(handle.read(length)))
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                again = headers["WARC-Type"] == "revisit"
                if not again and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record at {offset} of {file} has another digest")
                rows.append((page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], int(http["Content-Length"]), digest, headers["WARC-Type"], page(headers["WARC-Refers-To"]) if again else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    near = places.repartitionByRange(partitions(places), "file", "offset").sortWithinPartitions("file", "offset")
    return near.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages' archives and index, look every page's URL up, and read the records.

    The files stay in a new folder of the shared one. Rows as in read_records, one for each
    row of pages; an empty table gives none.
    """
    spark = pages.sparkSession
    base = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    captures = write_archives(pages, f"{base}/archives")
    ranges = write_index(captures, f"{base}/index")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    wanted = pages.select(F.col("url").cast("string")).mapInArrow(keys, "key string")
    return read_records(look_up(wanted, f"{base}/index", ranges), f"{base}/archives")
