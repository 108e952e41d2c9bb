"""WARC archives with a two-level capture index.

Pages are written as WARC records, each a gzip member by itself, in files of
bounded size.  The index sorts the captures by reversed-host URL key into
shards of compressed blocks; each shard ends with its sparse directory, the
first key and place of each block.  A lookup picks the shard among the shards'
first keys, then the block in the directory by binary search, reads that range,
and searches the block; the record is read by its range in turn.

Files are opened through ``pyarrow.fs`` by URI, so the folder may be in any
store that it knows (a shared file system, S3, GCS, HDFS).  A task writes files
under names of its own and returns what it wrote; only what a finished task
returned is ever referred to, so a lost or repeated task leaves stray files at
most.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.llm.base import NULL_LAST, row_order, shuffle_parts, written
from wickworks.session import scratch_path

LEAST_REVISITED = 100
FILE_BYTES = 64 << 20
BLOCK_LINES = 256
READ_BYTES = 32 << 20
# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#]*)|^([^/?#:]*)"
REST = r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//)?[^/?#]*([^#]*)"


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://a.example.com/x?y#z`` gives ``com,example,a)/x?y``; null gives ``)``."""
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.concat(F.regexp_extract(u, HOST, 1), F.regexp_extract(u, HOST, 2)))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(F.regexp_extract(u, REST, 1), r"[\t\r\n]", "%20"))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark reads it by."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + uri[len("file:") :] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(ord, url, payload, digest, refers_to, refers_url): what each record is to hold.

    Of pages with equal payloads of 100 bytes or more, the smallest page_id's is
    the response (each of them, if its row is repeated) and the others refer to
    it.  A page with null id is a response.  Only ids and digests are grouped;
    the payloads move once, by page.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(row_order(page_id).alias("ord"), F.col(url).alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    small = rows.where(F.octet_length("payload") >= LEAST_REVISITED).where(F.col("ord") != NULL_LAST).select("ord", "url", "digest")
    first = small.groupBy("digest").agg(F.min(F.struct("ord", "url")).alias("first"), F.max("ord").alias("last")).where("first.ord <> last")
    revisits = small.join(first, "digest").where(F.col("ord") > F.col("first.ord")).select("ord", "digest", F.col("first.ord").alias("refers_to"), F.col("first.url").alias("refers_url")).distinct()
    return rows.join(revisits, ["ord", "digest"], "left").select("ord", "url", "payload", "digest", "refers_to", "refers_url")


def _name(ord_: int) -> str:
    return "none" if ord_ == NULL_LAST else str(ord_)


def _plain(url: str | None) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url or "")


def record(ord_: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, refers_key: str | None, date: str) -> bytes:
    """One WARC record, compressed as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{_name(ord_)}>",
        "WARC-Date": date,
        "WARC-Target-URI": _plain(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{_name(refers_to)}>", "WARC-Refers-To-Target-URI": _plain(refers_url), "X-Refers-To-Key": refers_key}
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"
    return _gzip(head + block + b"\r\n\r\n")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, payload) of a compressed record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version.encode() != VERSION:
        raise ValueError(f"not a record: {version!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """A task's output files, each begun when the one before is full."""

    def __init__(self, folder: str, suffix: str, limit: int, begin: bytes = b""):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.suffix, self.limit, self.first = folder, suffix, limit, begin
        self.out = None

    def add(self, data: bytes) -> tuple[str, int]:
        """(name, offset) of ``data``."""
        if self.out is None or self.at >= self.limit:
            self.close()
            self.fs.create_dir(self.folder, recursive=True)
            self.name = uuid.uuid4().hex + self.suffix
            self.out, self.at = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), len(self.first)
            self.out.write(self.first)
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
        self.out = None


def write_archive(pages: DataFrame, folder: str, date: str = "2025-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (see ``with_revisits``); the captures (key, ord, file, offset, length) as a table."""
    info = b"software: wickworks\r\nformat: WARC File Format 1.1\r\n"
    head = VERSION + f"\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:warcinfo:1>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode()
    begin = _gzip(head + info + b"\r\n\r\n")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done = _Files(folder, ".warc.gz", file_bytes, begin), []
        for batch in batches:
            for row in batch.to_pylist():
                data = record(row["ord"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"], row["refers_url"], row["refers_key"], date)
                done.append((row["key"], row["ord"], *files.add(data), len(data)))
        files.close()  # nothing is named before all is in its place
        yield pa.RecordBatch.from_pylist([dict(zip(("key", "ord", "file", "offset", "length"), d)) for d in done], schema=_CAPTURE)

    rows = pages.select(url_key(F.col("url")).alias("key"), "*", url_key(F.col("refers_url")).alias("refers_key"))
    return written(rows.mapInArrow(write, "key string, ord long, file string, offset long, length long"), "warc-captures")


_CAPTURE = pa.schema([("key", pa.string()), ("ord", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[bytes, int, str]]:
    """Write the sorted index; the shards (first key, first ord, file) in order, one for each range partition.

    A shard: gzip blocks of lines ``key TAB ord TAB file TAB offset TAB length``,
    the directory (a gzip member of lines ``key TAB ord TAB offset TAB length``)
    and the directory's size in 8 bytes.  Keys are cut by (key, ord), so a URL
    captured very often spreads over several shards.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, lines, directory, at = _Files(folder, ".cdx", 1 << 62), [], [], 0

        def flush() -> None:
            nonlocal at
            block = _gzip(b"".join(line for _, _, line in lines))
            files.add(block)
            directory.append((*lines[0][:2], at, len(block)))
            at += len(block)
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                key = r["key"].encode()
                lines.append((key, r["ord"], b"%s\t%d\t%s\t%d\t%d\n" % (key, r["ord"], r["file"].encode(), r["offset"], r["length"])))
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if directory:
            packed = _gzip(b"".join(b"%s\t%d\t%d\t%d\n" % d for d in directory))
            name, _ = files.add(packed + struct.pack("<q", len(packed)))
            files.close()
            yield pa.RecordBatch.from_pylist([{"key": directory[0][0], "ord": directory[0][1], "file": name}], schema=pa.schema([("key", pa.binary()), ("ord", pa.int64()), ("file", pa.string())]))

    parts = shuffle_parts(captures.sparkSession)
    ordered = captures.repartitionByRange(parts, "key", "ord").sortWithinPartitions("key", "ord", "file", "offset")
    # a row a partition: read by the driver at once, without a table of as many files
    shards = ordered.mapInArrow(write, "key binary, ord long, file string").collect()
    return sorted((bytes(r["key"]), r["ord"], r["file"]) for r in shards)


class _Shard:
    """One shard's directory, and the block last read."""

    def __init__(self, folder: str, name: str):
        system, path = fs.FileSystem.from_uri(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        n = struct.unpack("<q", self.file.read_at(8, size - 8))[0]
        lines = zlib.decompress(self.file.read_at(n, size - 8 - n), 31).split(b"\n")[:-1]
        self.blocks = [(k, int(o), int(a), int(b)) for k, o, a, b in (x.rsplit(b"\t", 3) for x in lines)]
        self.firsts = [b[:2] for b in self.blocks]
        self.held: tuple[int, list] = (-1, [])

    def _block(self, i: int) -> list[tuple[bytes, int, str, int, int]]:
        if self.held[0] != i:
            _, _, at, n = self.blocks[i]
            lines = zlib.decompress(self.file.read_at(n, at), 31).split(b"\n")[:-1]
            self.held = (i, [(k, int(o), f.decode(), int(a), int(b)) for k, o, f, a, b in (x.rsplit(b"\t", 4) for x in lines)])
        return self.held[1]

    def find(self, key: bytes, ord_: int) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of the captures with this key and id."""
        i = max(0, bisect_left(self.firsts, (key, ord_)) - 1)  # equal keys may begin in the block before
        while i < len(self.blocks) and self.firsts[i] <= (key, ord_):
            block = self._block(i)
            j = bisect_left(block, (key, ord_))
            while j < len(block) and block[j][:2] == (key, ord_):
                yield block[j][2:]
                j += 1
            if j < len(block):
                return
            i += 1


def lookup(requests: DataFrame, folder: str, shards: list[tuple[bytes, int, str]]) -> DataFrame:
    """(key, ord, file, offset, length): the captures asked for by distinct rows (key, ord) of ``requests``.

    The shards' first keys, one for each partition of the index, go along with
    the tasks; directories and blocks are read where they are needed, each once
    in a task, as requests come in order.
    """
    spark = requests.sparkSession
    asked = requests.select("key", "ord").distinct()
    if not shards:
        return spark.createDataFrame([], "key string, ord long, file string, offset long, length long")
    shared = spark.sparkContext.broadcast(shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [s[:2] for s in shared.value]
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            out: list[tuple[int, str, int]] = []
            for key, ord_ in rows:
                wanted = (key.encode(), ord_)
                last = max(0, bisect_right(firsts, wanted) - 1)
                first = max(0, bisect_left(firsts, wanted) - 1)  # a repeated row may straddle shards
                out += [(s, key, ord_) for s in range(first, last + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int64())], names=["shard", "key", "ord"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = -1, None
        for batch in batches:
            out = []
            for s, key, ord_ in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != number:
                    number, shard = s, _Shard(folder, shared.value[s][2])
                out += [{"key": key, "ord": ord_, "file": f, "offset": a, "length": n} for f, a, n in shard.find(key.encode(), ord_)]
            yield pa.RecordBatch.from_pylist(out, schema=_CAPTURE)

    placed = asked.mapInArrow(place, "shard int, key string, ord long")
    dealt = placed.repartition(max(1, min(len(shards), shuffle_parts(spark))), "shard").sortWithinPartitions("shard", "key", "ord")
    return dealt.mapInArrow(find, "key string, ord long, file string, offset long, length long")


def fetch(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """(ord, url, record_type, refers_to, refers_key, payload, payload_bytes, payload_digest, stated_bytes, stated_digest) read from the archives by range.

    Size and digest of the payload are those of what was read; the stated ones
    are the record's.  A revisit has no payload.  Without ``payloads`` that column
    is null, and what was read stays in the task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        schema = pa.schema([
            ("ord", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_key", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("stated_bytes", pa.int64()), ("stated_digest", pa.string()),
        ])
        for batch in batches:
            rows = batch.to_pylist()
            for name, group in groupby(rows, lambda r: r["file"]):
                out, size = [], 0
                with system.open_input_file(f"{path}/{name}") as file:
                    for r in group:
                        fields, payload = parse(file.read_at(r["length"], r["offset"]))
                        refers = fields.get("WARC-Refers-To", "")[len("<urn:page:") : -1]
                        is_response = fields["WARC-Type"] == "response"
                        out.append({
                            "ord": r["ord"], "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "refers_to": int(refers) if refers else None,
                            "refers_key": fields.get("X-Refers-To-Key"), "payload": payload if payloads and is_response else None,
                            "payload_bytes": len(payload) if is_response else None, "payload_digest": hashlib.sha256(payload).hexdigest() if is_response else None,
                            "stated_bytes": int(fields["X-Payload-Length"]), "stated_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
                        })
                        size += len(payload) if payloads else 0
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    near = captures.select("ord", "file", "offset", "length").repartition(shuffle_parts(captures.sparkSession), "file", F.floor(F.col("offset") / F.lit(READ_BYTES // 8)))
    return near.sortWithinPartitions("file", "offset").mapInArrow(read, "ord long, url string, record_type string, refers_to long, refers_key string, payload binary, payload_bytes long, payload_digest string, stated_bytes long, stated_digest string")


def archive_pages(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES, block_lines: int = BLOCK_LINES) -> tuple[str, list[tuple[bytes, int, str]]]:
    """Write all ``pages`` and their index to ``folder`` (a fresh one in the shared folder by default); (folder, shards)."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    captures = write_archive(with_revisits(pages, page_id, url, html), f"{folder}/archive", file_bytes=file_bytes)
    return folder, write_index(captures, f"{folder}/index", block_lines)


def read_pages(requests: DataFrame, folder: str, shards: list[tuple[bytes, int, str]], page_id: str = "page_id", url: str = "url", payloads: bool = True) -> DataFrame:
    """Read the records of the pages (page_id, url) back through the index.

    Returns page_id, url, record_type, refers_to, payload (null for a revisit,
    or without ``payloads``), payload_bytes, payload_digest (of the full
    payload), a row per record; pages that aren't in the archive give none.
    Size and digest are taken from what was read: for a response from its
    record, for a revisit from the response that it refers to, which is looked
    up through the index and read as well.  A record that is missing or isn't as
    its headers, or those of its revisits, state raises ``ValueError``.

    The records read are written as a table.  Responses that are referred to are
    read once each, however many records refer to them, and compared with the
    distinct statements of their revisits, so a common page is no hot key.
    """
    asked = requests.select(url_key(F.col(url)).alias("key"), row_order(page_id).alias("ord"))
    rows = written(fetch(lookup(asked, f"{folder}/index", shards), f"{folder}/archive", payloads), "warc-records")
    stated = rows.where("refers_to IS NOT NULL").groupBy("refers_key", "refers_to", "stated_digest", "stated_bytes").agg(F.min("ord").alias("ord"))
    referred = fetch(lookup(stated.select(F.col("refers_key").alias("key"), F.col("refers_to").alias("ord")), f"{folder}/index", shards), f"{folder}/archive", payloads=False)
    found = referred.select(F.col("ord").alias("refers_to"), F.col("payload_digest").alias("stated_digest"), F.col("payload_bytes").alias("found_bytes")).distinct()
    lost = stated.join(found, ["refers_to", "stated_digest"], "left").where("found_bytes IS NULL OR found_bytes <> stated_bytes").select("ord", F.concat(F.lit("response "), F.col("refers_to").cast("string"), F.lit(" is missing or differs")).alias("why"))
    damaged = rows.where("payload_digest <> stated_digest OR payload_bytes <> stated_bytes").select("ord", F.lit("damaged record").alias("why"))
    for bad in damaged.unionByName(lost).limit(1).collect():
        raise ValueError(f"page {_name(bad['ord'])}: {bad['why']}")
    # now a revisit's statement is what its response was found to be
    return rows.select(
        F.when(F.col("ord") != F.lit(NULL_LAST), F.col("ord")).alias("page_id"), "url", "record_type", "refers_to", "payload",
        F.coalesce("payload_bytes", "stated_bytes").alias("payload_bytes"), F.coalesce("payload_digest", "stated_digest").alias("payload_digest"),
    )


def op2_sql() -> str:
    """DuckDB SQL of op2's rows."""
    return f"""
    WITH p AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (
      SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= {LEAST_REVISITED} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= {LEAST_REVISITED} AND page_id > first THEN first END AS refers_to
    FROM f
    """
