"""WARC archives with a two-level capture index.

Pages become WARC/1.1 records, one gzip member each, in archives of bounded size in a shared folder. Of the pages with
equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest id is stored as ``response``, the others as
``revisit`` records that name it; smaller payloads are always stored.

The index has two levels. Captures are sorted by their reversed-host key (``com,example)/path``) and id across all
tasks; each task writes one index part: compressed blocks of ``BLOCK`` captures, and after them a sparse directory with the
first key of each block. The root, one row per part, is all that a search starts from: it bisects the root, then
the part's directory, decompresses the few blocks that can hold the key, and reads the records by
range. A very common host or address spreads over blocks and parts like any other, as the id is part of the order.

Files are written by pyarrow's file systems, so the folder may be of any kind that they open (local or mounted, HDFS, S3,
GCS). A task names its files afresh at each attempt and only the files of the attempts that succeeded are in the index;
what an executor lost midway has left is never read.

Defined cases: a null html is an empty payload; a null url has the empty key; a null page id is written as such and is
never the target of a revisit; repeated rows are records of their own, and those that share the
largest id are all responses; an empty table gives an index without parts.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost.llm.store import new_path, save

MIN_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
BLOCK = 1000
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, page_id long, file string, offset long, length long"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _open(uri: str):
    """(file system, path) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def surt(url: str | None) -> str:
    """The reversed-host key of a URL: lower-case host parts in reverse, then the path and query."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host = (u.hostname or "").lower()
        port = f":{u.port}" if u.port else ""
    except ValueError:
        return url
    if not host:
        return url
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def _base32(digest_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record, uncompressed. A revisit keeps the HTTP header of its capture, with the payload's length, and no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + " ".join(refers_url.split()))
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one uncompressed record; the payload's digest is computed, and checked, where there is a payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    own = fields["WARC-Record-ID"][len("<urn:page:") : -1]
    target = fields.get("WARC-Refers-To")
    if target is None and (hashlib.sha1(payload).hexdigest() != said or len(payload) != length):
        raise ValueError(f"record {own} is damaged")
    return {
        "page_id": int(own) if own else None,
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": said,
        "record_type": fields["WARC-Type"],
        "refers_to": int(target[len("<urn:page:") : -1]) if target else None,
        "payload": payload if target is None else None,
    }


def _gzip(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class _Archives:
    """Writes records to files of at most about ARCHIVE_BYTES in one folder."""

    def __init__(self, folder: str):
        self.fs, self.folder = _open(folder)
        self.out, self.name, self.at = None, "", 0

    def add(self, raw: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        packed = _gzip(raw)
        self.out.write(packed)
        place = (self.name, self.at, len(packed))
        self.at += len(packed)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every page; returns the captures (key, page_id, file, offset, length), written to the shared folder."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = p.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull())
    groups = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = groups.select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
    again = large.select("page_id", "digest").join(groups, "digest").where(F.col("page_id") < F.col("refers_to")).distinct()
    rows = p.join(again, ["page_id", "digest"], "left")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archives = _Archives(folder)
        for batch in batches:
            found = []
            for page_id, url, raw, digest, to, to_url in zip(batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["refers_to"], batch["refers_url"]):
                page_id = None if pd.isna(page_id) else int(page_id)
                to = None if pd.isna(to) else int(to)
                found.append((surt(url), page_id, *archives.add(record(page_id, url, bytes(raw), digest, to, to_url))))
            yield pd.DataFrame(found, columns=["key", "page_id", "file", "offset", "length"]).astype({"page_id": "Int64"})
        archives.close()

    return save(rows.select("page_id", "url", "payload", "digest", "refers_to", "refers_url").mapInPandas(write, _CAPTURE), "captures")


class Index:
    """The root of a capture index: one row per part, (first key, file, size), in key order."""

    def __init__(self, folder: str, parts: list[tuple[str, str, int]]):
        self.folder, self.parts = folder, parts
        self.firsts = [p[0] for p in parts]

    def read_part(self, number: int) -> "_Part":
        return _Part(self.folder, *self.parts[number][1:])

    def candidates(self, key: str) -> range:
        """The parts that can hold ``key``."""
        return range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key))


class _Part:
    """One part of the index: its directory, and its blocks by range reads."""

    def __init__(self, folder: str, file: str, size: int):
        fs, path = _open(folder)
        self.file = fs.open_input_file(f"{path}/{file}")
        tail = struct.unpack("<Q", self._range(size - 8, 8))[0]
        self.directory = json.loads(zlib.decompress(self._range(size - 8 - tail, tail)))  # (first key, offset, length)
        self.firsts = [d[0] for d in self.directory]
        self.last: tuple[int, list[list]] = (-1, [])  # keys mostly come in order, so the next one is often in the same block

    def _range(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def block(self, number: int) -> list[list]:
        if self.last[0] != number:
            _, offset, length = self.directory[number]
            self.last = number, json.loads(zlib.decompress(self._range(offset, length)))
        return self.last[1]

    def find(self, key: str) -> Iterator[list[list]]:
        """The captures (key, page id, file, offset, length) of ``key``, block by block: those that can hold it are bisected."""
        for number in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            rows = self.block(number)
            yield rows[bisect_left(rows, key, key=lambda r: r[0]) : bisect_right(rows, key, key=lambda r: r[0])]


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sorts the captures over all tasks and writes one index part per task."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = _open(folder)
        name = f"{uuid.uuid4().hex}.cdx"
        directory: list[tuple[str, int, int]] = []
        held: list[list] = []
        out, at = None, 0

        def flush(rows: list[list]) -> None:
            nonlocal at
            packed = zlib.compress(json.dumps(rows).encode())
            out.write(packed)
            directory.append((rows[0][0], at, len(packed)))
            at += len(packed)

        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
            held += [list(r) for r in zip(batch["key"], ids, batch["file"], batch["offset"].tolist(), batch["length"].tolist())]
            if held and out is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            while len(held) >= BLOCK:
                flush(held[:BLOCK])
                held = held[BLOCK:]
        if held:
            flush(held)
        if out is not None:
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + struct.pack("<Q", len(tail)))
            out.close()
            yield pd.DataFrame({"first": [directory[0][0]], "file": [name], "size": [at + len(tail) + 8]})

    # binary order of the key's UTF-8 is Python's order of its code points
    ordered = captures.repartitionByRange(F.col("key"), F.col("page_id"), F.col("file"), F.col("offset")).sortWithinPartitions("key", "page_id", "file", "offset")
    parts = save(ordered.mapInPandas(write, "first string, file string, size long"), "index")
    return Index(folder, sorted((r["first"], r["file"], r["size"]) for r in parts.collect()))  # one row per part


class _Records:
    """Range reads of records; the file last read stays open."""

    def __init__(self, folder: str):
        self.fs, self.folder = _open(folder)
        self.name, self.file = None, None

    def get(self, name: str, offset: int, length: int) -> dict:
        if name != self.name:
            self.name, self.file = name, self.fs.open_input_file(f"{self.folder}/{name}")
        self.file.seek(offset)
        return parse(zlib.decompress(self.file.read(length), 31))


_FIELDS = [c.split()[0] for c in _RECORD.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_FIELDS).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def lookup(spark: SparkSession, index: Index, folder: str, urls: DataFrame) -> DataFrame:
    """The records of each different url of ``urls`` (url), found through the index."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records = _Records(folder)
        number, part = -1, None
        for batch in batches:
            for url in batch["url"]:
                key = surt(url)
                for n in index.candidates(key):
                    if n != number:
                        number, part = n, index.read_part(n)
                    for row in (row for rows in part.find(key) for row in rows):
                        found = records.get(*row[2:])
                        if found["url"] == (None if url is None else " ".join(url.split())):
                            yield _frame([found])

    return urls.select("url").distinct().mapInPandas(find, _RECORD)


def places(pages: DataFrame, index: Index) -> DataFrame:
    """(file, offset, length) of the captures of all pages' addresses, by search: the root names the parts that can hold a key, and each part's
    directory the blocks. A very common address is looked up in each of its parts by another task."""

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [(number, key) for key in {surt(u) for u in batch["url"]} for number in index.candidates(key)]
            yield pd.DataFrame(pairs, columns=["part", "key"]).astype({"part": "int64"})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, part = -1, None
        for batch in batches:
            rows: list[list] = []
            for n, key in zip(batch["part"], batch["key"]):
                if n != number:
                    number, part = n, index.read_part(int(n))
                for found in part.find(key):
                    rows += found
                    if len(rows) >= 10_000:
                        yield pd.DataFrame([r[2:] for r in rows], columns=["file", "offset", "length"])
                        rows = []
            if rows:
                yield pd.DataFrame([r[2:] for r in rows], columns=["file", "offset", "length"])

    pairs = pages.select("url").distinct().mapInPandas(candidates, "part long, key string").distinct()
    dealt = pairs.repartition(max(1, len(index.parts)), "part").sortWithinPartitions("part", "key")
    return dealt.mapInPandas(search, "file string, offset long, length long")


def read_records(found: DataFrame, folder: str, tasks: int, payload: bool = True) -> DataFrame:
    """The records at ``found`` places; ``tasks`` tasks read the archives, each in order."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records = _Records(folder)
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch[at : at + 500]
                rows = [records.get(*place) for place in zip(some["file"], some["offset"].tolist(), some["length"].tolist())]
                if not payload:
                    rows = [r | {"payload": None} for r in rows]
                yield _frame(rows)

    # with a number the tasks stay as many as the archives: places are tiny, so by their bytes they would be merged into one
    return found.repartition(max(1, tasks), "file").sortWithinPartitions("file", "offset").mapInPandas(read, _RECORD)


def report(pages: DataFrame) -> DataFrame:
    """Writes the archives and their index, finds every page's address in the index and reads the records back.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "archives")
    captures = write_archives(pages, f"{folder}/warc")
    index = build_index(captures, f"{folder}/cdx")
    archives = captures.select("file").distinct().count()
    found = read_records(places(pages, index), f"{folder}/warc", archives, payload=False)
    return found.select(*_FIELDS[:1], *_FIELDS[2:6])


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), g AS (
  SELECT page_id, payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""
