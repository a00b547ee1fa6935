"""WARC archives with a two-level capture index.

Pages become gzipped WARC records, one member each; of equal payloads only the smallest page_id's is stored, the others are revisits that name
it. Captures are sorted by a key (host reversed, path, page) into shards of compressed blocks of ``LINES`` lines; each shard ends in a
sparse directory with the first key of every block, and a list of shards holds the first key of each shard. A look-up bisects the
list and the directory, reads one block by range, bisects its lines and reads the record by range.

Tasks write files under names of their own, and only what a task returns when it succeeds is indexed, so a lost or repeated task leaves at most an unused
file. Files are reached through pyarrow's file systems by the scheme of spark.checkpoint.dir. Null html is an empty payload, a null url an
empty one. Rows that repeat a page_id with the same payload are responses each. Other columns are ignored. The list of shards is bounded by ``SHARDS``.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.llm.common import keep, map_arrow, scratch, table

LINES, SHARDS, FILE_BYTES, LEVEL = 500, 512, 256 << 20, 4
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits are four base32 ones."""
    h = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(h, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def capture_key(url: str, page: str) -> str:
    """com,example)/path?query, a space, and the page."""
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)", url)
    host, rest = (m[1].lower().removeprefix("www."), m[2] or "/") if m else ("", url.split("#")[0])
    return f"{clean(','.join(reversed(host.split('.'))))}){clean(rest)} {page}"


def clean(s: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", s)


def record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A WARC record: a response, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""
    fields = lambda b: dict(x.split(": ", 1) for x in b.decode().split("\r\n")[1:])
    head, rest = data.split(b"\r\n\r\n", 1)
    warc = fields(head)
    http, payload = rest[:int(warc["Content-Length"])].split(b"\r\n\r\n", 1)
    return warc, fields(http), payload


def _open(base: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(base)


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write records; returns the captures: key, file, offset and length."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                         F.coalesce("html", F.lit("")).alias("html"))
    same = keep(pages.select("page_id", base32_sha1(F.col("html")).alias("digest")).groupBy("digest")
                .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    typed = pages.withColumn("digest", base32_sha1(F.col("html"))).join(same, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")), None)
        .otherwise(F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, out, at = "", None, 0
        for batch in batches:
            rows = []
            for page, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                page = "-" if page is None else str(page)
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = _gzip(record(page, url, html.encode(), digest, None if first is None else str(first)))
                out.write(data)
                rows.append((capture_key(url, page), name, at, len(data)))
                at += len(data)
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "file", "offset", "length"])
        if out:
            out.close()

    return keep(map_arrow(typed, run, "key string, file string, offset long, length long"))


def write_index(captures: DataFrame, folder: str, shards: int = SHARDS) -> list[tuple[str, str, int, int]]:
    """Sort the captures into shards; returns the list of shards: first key, file, and where its directory stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, out, at, lines, directory, first = f"{uuid.uuid4().hex}.cdx", None, 0, [], [], None

        def block() -> None:
            nonlocal at
            data = zlib.compress("\n".join(x[1] for x in lines).encode(), LEVEL)
            out.write(data)
            directory.append((lines[0][0], at, len(data)))
            at += len(data)
            lines.clear()

        for batch in batches:
            for key, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length"))):
                if out is None:
                    out, first = fs.open_output_stream(f"{base}/{name}", compression=None), key
                lines.append((key, f"{key}\t{file}\t{offset}\t{length}"))
                if len(lines) == LINES:
                    block()
        if out is None:
            return
        if lines:
            block()
        data = zlib.compress(json.dumps(directory).encode())
        out.write(data)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, name, at, len(data))], ["first", "file", "offset", "length"])

    spread = captures.repartitionByRange(shards, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    rows = keep(map_arrow(spread, run, "first string, file string, offset long, length long")).collect()  # a row for each shard
    return sorted(tuple(r) for r in rows)


class Index:
    """Look-ups in the shards of an index; a directory and the last block of a shard are kept while keys come in order."""

    def __init__(self, folder: str, shards: list[tuple[str, str, int, int]]):
        self.fs, self.base = _open(folder)
        self.shards, self.firsts = shards, [s[0] for s in shards]
        self.directory = lru_cache(maxsize=8)(self._directory)
        self.block = lru_cache(maxsize=8)(self._block)

    def _read(self, file: str, offset: int, length: int) -> bytes:
        with self.fs.open_input_file(f"{self.base}/{file}") as f:
            return f.read_at(length, offset)

    def _directory(self, shard: int) -> tuple[list[str], list]:
        _, file, offset, length = self.shards[shard]
        rows = json.loads(zlib.decompress(self._read(file, offset, length)))
        return [r[0] for r in rows], rows

    def _block(self, shard: int, number: int) -> tuple[list[str], list[str]]:
        _, offset, length = self.directory(shard)[1][number]
        lines = zlib.decompress(self._read(self.shards[shard][1], offset, length)).decode().split("\n")
        return [x.split("\t", 1)[0] for x in lines], lines

    def find(self, low: str, fits) -> Iterator[tuple[str, str, int, int]]:
        """The captures from ``low`` on for which ``fits(key)`` holds, across blocks and shards."""
        shard = max(0, bisect.bisect_left(self.firsts, low) - 1)
        number = None
        while shard < len(self.shards):
            firsts, rows = self.directory(shard)
            if number is None:
                number = max(0, bisect.bisect_left(firsts, low) - 1)
            while number < len(rows):
                keys, lines = self.block(shard, number)
                for k in range(bisect.bisect_left(keys, low), len(lines)):
                    if not fits(keys[k]):
                        return
                    key, file, offset, length = lines[k].split("\t")
                    yield key, file, int(offset), int(length)
                number += 1
            shard, number = shard + 1, 0

    def captures_of(self, url: str) -> Iterator[tuple[str, str, int, int]]:
        """All captures of a url."""
        low = capture_key(url, "")
        return self.find(low, lambda key: key.startswith(low))

    def capture(self, key: str) -> Iterator[tuple[str, str, int, int]]:
        return self.find(key, lambda k: k == key)


def read_pages(wanted: DataFrame, archive: str, index: str, shards: list[tuple[str, str, int, int]]) -> DataFrame:
    """The records of the pages in ``wanted`` (page_id, url), found through the index and read from the archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Index(index, shards)
        fs, base = _open(archive)
        files = lru_cache(maxsize=64)(lambda name: fs.open_input_file(f"{base}/{name}"))
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for _, file, offset, length in found.capture(key):
                    warc, http, payload = parsed(zlib.decompress(files(file).read_at(length, offset), 31))
                    kind = warc["WARC-Type"]
                    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                    n = int(http["Content-Length"])
                    if kind == "response":
                        digest, n = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                    page, first = (None if p is None or p == "-" else int(p) for p in
                                   (warc["WARC-Record-ID"][10:-1], warc.get("WARC-Refers-To", "<urn:page:->")[10:-1]))
                    rows.append((page, n, digest, kind, first))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u or "", "-" if p is None else str(p)) for p, u in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    keys = map_arrow(wanted.select(F.col("page_id").cast("long").alias("page_id"), "url"), keyed, "key string").distinct()
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return map_arrow(ordered, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive, index = scratch(spark), scratch(spark)
    shards = min(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = write_index(write_archives(pages, archive), index, shards)
    return read_pages(pages, archive, index, listed)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS low FROM p GROUP BY x),
c AS (SELECT page_id, low, x, strlen(h) AS n, [CAST('0x' || x[k:k + 4] AS BIGINT) FOR k IN [1, 6, 11, 16, 21, 26, 31, 36]] AS v FROM p JOIN f USING (x))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((t >> 15) & 31 AS BIGINT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((t >> 10) & 31 AS BIGINT) + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((t >> 5) & 31 AS BIGINT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(t & 31 AS BIGINT) + 1, 1) FOR t IN v],
        'string_agg', '') AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM c
"""
