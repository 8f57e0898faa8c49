"""Deterministic sharded WARC archives: written by Spark tasks, read back by Spark tasks.

*Writing.* Every page becomes a gzip member of its own in the task that reads it, so that only compressed
records are shuffled. Records are range-sorted by page id, and a task streams its range into files that are
closed at ``roll_bytes`` of compressed size. Of records with equal payloads of ``min_bytes`` or more, the one
with the smallest page id is a response and the others are revisits of it; the ids to mark are
found from digests alone and travel through the same sort as one small row each.
Headers, record ids, digests and dates depend on the page alone, so a task that runs again writes the same bytes.

*Commit.* A task writes under a temporary name of its attempt and renames its files when all of them are complete, to names that end
with their digests. No attempt deletes or replaces another one's files. It returns a manifest row for each file; the manifest is
committed by Spark and names what belongs to the archive, and files that it does not name are cleared after it. Files are written through the file system of the given folder, which all executors must share.

*Reading.* Files of the manifest are dealt over tasks and streamed record by record; block lengths and digests are checked.

Defined results: a null html is an empty payload; a null url is named after its page; equal rows are one response and
revisits of it; a null page id sorts before all others and can be a response only if no equal payload has an id. An empty table gives an archive
without files. Only the id, the url and the html are read; the caller names them, other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import map_texts, shuffle_partitions, small_batches
from ledgerloom.operators.skew import lookup

ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
LEVEL = 6
READ = 1 << 20
END = b"\r\n\r\n"


def record_id(page: str | None, digest: str, nth: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}/{digest}/{nth}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member without a time stamp."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + END) + packer.flush()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def target(url: str | None, page: str | None) -> str:
    """The url with what a header line can't hold escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page}"


def common_headers(kind: str, page: str | None, url: str, digest: str, size: int, nth: int) -> list[tuple[str, str]]:
    return [("WARC-Type", kind), ("WARC-Record-ID", record_id(page, digest, nth)), ("WARC-Date", DATE), ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
            *([("X-Page-ID", page)] if page is not None else []), ("X-Payload-Length", str(size))]


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def response(page: str | None, url: str, payload: bytes, digest: str) -> bytes:
    block = http_head(len(payload)) + payload
    return member([*common_headers("response", page, url, digest, len(payload), 0), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")], block)


def revisit(page: str | None, url: str, digest: str, size: int, refers: str | None, nth: int) -> bytes:
    block = http_head(size)
    return member([
        *common_headers("revisit", page, url, digest, size, nth), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(refers, digest)), *([("X-Refers-To-Page", refers)] if refers is not None else [])], block)


class Roll:
    """Files of one task: opened under a temporary name of the attempt, closed at the size limit, moved to their names together.

    A name ends with a digest of the file, so files of one name are equal, and an attempt that comes second never has to touch what
    an earlier one left. The manifest alone says which files belong.
    """

    def __init__(self, folder: str, partition: int, limit: int):
        self.store, self.root = opened(folder)
        self.partition, self.limit = partition, limit
        self.temp = f"{self.root}/_temporary/{uuid.uuid4().hex}"
        self.store.create_dir(self.temp, recursive=True)
        self.files, self.out = [], None

    def add(self, record: bytes, is_revisit: bool) -> None:
        if self.out and self.files[-1]["bytes"] + len(record) > self.limit:
            self._close()
        if self.out is None:
            name = f"part-{self.partition:05d}-{len(self.files):05d}"
            self.out, self.digest = self.store.open_output_stream(f"{self.temp}/{name}", compression=None), hashlib.sha1()
            info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, "")), ("WARC-Date", DATE),
                           ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self.files.append({"temp": name, "records": 0, "revisits": 0, "bytes": 0, "crc": 0})
            self._write(info)
        self._write(record)
        self.files[-1]["records"] += 1
        self.files[-1]["revisits"] += is_revisit

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        f = self.files[-1]
        f["bytes"] += len(data)
        f["crc"] = zlib.crc32(data, f["crc"])

    def _close(self) -> None:
        self.out.close()
        self.out = None
        f = self.files[-1]
        f["file"] = f"{f['temp']}-{self.digest.hexdigest()[:20]}.warc.gz"

    def commit(self) -> list[dict]:
        if self.out:
            self._close()
        for f in self.files:
            temp, final = f"{self.temp}/{f.pop('temp')}", f"{self.root}/{f['file']}"
            if self.store.get_file_info(final).type == fs.FileType.NotFound:
                self.store.move(temp, final)
        self.store.delete_dir(self.temp)
        return self.files


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, min_bytes: int = 0, page_id: str = "page_id",
               url: str = "url", html: str = "html") -> DataFrame:
    """Write the archive below ``folder`` (a path or URI shared by all executors); returns its manifest,
    which is also kept there: file, records, revisits, bytes, crc."""
    spark = pages.sparkSession
    small_batches(spark)
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    ids = rows.select("page", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")).where(F.col("size") >= min_bytes)
    several = ids.groupBy("sha").agg(F.min("page").alias("refers"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = lookup(ids.select("page", "sha"), several.select("sha", "refers"), ["sha"], "inner").where("not (page <=> refers)").distinct()
    marks = marks.select("page", "sha", F.lit(0).alias("kind"), F.col("refers").cast("string").alias("refers"),
                         F.lit(None).cast("string").alias("url"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("binary").alias("record"))

    def packed(batch: pa.RecordBatch):
        pages_, urls, texts = (c.to_pylist() for c in (batch.column(1), batch.column(2), batch.column(3).cast(pa.binary())))
        out = {"page": batch.column(0), "sha": [], "kind": [1] * len(urls), "refers": [None] * len(urls), "url": [], "size": [], "record": []}
        for page, link, payload in zip(pages_, urls, texts):
            sha = hashlib.sha1(payload)
            out["sha"].append(sha.hexdigest())
            out["url"].append(target(link, page))
            out["size"].append(len(payload))
            out["record"].append(response(page, target(link, page), payload, base64.b32encode(sha.digest()).decode()))
        yield out

    records = map_texts(rows.select("page", F.col("page").cast("string").alias("id"), "url", "html"), packed,
                        f"page {kind}, sha string, kind int, refers string, url string, size long, record binary")
    dealt = records.unionByName(marks).repartitionByRange(shuffle_partitions(spark), "page", "sha").sortWithinPartitions("page", "sha", "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, key, mark, nth = Roll(folder, TaskContext.get().partitionId(), roll_bytes), None, None, 0
        for batch in batches:
            for page, sha, what, refers, link, size, record in zip(*[c.to_pylist() for c in batch.columns]):
                if (page, sha) != key:
                    key, mark, nth = (page, sha), None, 0
                if what == 0:
                    mark = (refers,)
                elif mark or nth and size >= min_bytes:
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    roll.add(revisit(page, link, digest, size, mark[0] if mark else page, nth), True)
                    nth += 1
                else:
                    roll.add(record, False)
                    nth += 1
        files = roll.commit()
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=pa.schema(
                [("file", pa.string()), ("records", pa.int64()), ("revisits", pa.int64()), ("bytes", pa.int64()), ("crc", pa.int64())]))

    ordered = dealt.select(F.col("page").cast("string"), "sha", "kind", "refers", "url", "size", "record")
    manifest = ordered.mapInArrow(write, "file string, records long, revisits long, bytes long, crc long")
    manifest.write.parquet(f"{folder}/manifest")
    listed = spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")
    clear_strays(folder, listed)
    return listed


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def clear_strays(folder: str, manifest: DataFrame) -> list[str]:
    """Delete archive files that the written manifest doesn't name: those of attempts that died or came second."""
    store, root = opened(folder)
    named = {r.file for r in manifest.select("file").collect()}     # one name per file of the roll size
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    strays = [f.base_name for f in found if f.type == fs.FileType.File and f.base_name.endswith(".warc.gz") and f.base_name not in named]
    for name in strays:
        store.delete_file(f"{root}/{name}")
    return strays


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    rest = stream.read(READ)
    while rest:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                rest = stream.read(READ)
                if not rest:
                    raise ValueError("the last record is cut off")
            out.append(unpacker.decompress(rest))
            rest = unpacker.unused_data if unpacker.eof else b""
        yield b"".join(out)
        rest = rest or stream.read(READ)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(END)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != END or len(block) != int(headers["Content-Length"]):
        raise ValueError(f"bad block length in {headers['WARC-Record-ID']}")
    if "WARC-Block-Digest" in headers and headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"bad block digest in {headers['WARC-Record-ID']}")
    return headers, block


def read_warc(spark: SparkSession, folder: str, page_type: str = "long", payloads: bool = True) -> DataFrame:
    """Rows of an archive: page_id, url, record_type, refers_to, payload_bytes, payload_digest, file and, if
    asked for, payload (null for a revisit)."""
    manifest = spark.read.parquet(f"{folder}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in ("page_id", "url", "record_type", "refers_to")] + [("payload_bytes", pa.int64())]
                           + [(n, pa.string()) for n in ("payload_digest", "file")] + [("payload", pa.binary())] * payloads)
        store, root = opened(folder)
        for batch in batches:
            for name, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in members(stream):
                        headers, block = parsed(record)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        seen += 1
                        payload = block.partition(END)[2] if headers["WARC-Type"] == "response" else None
                        digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                        if payload is not None and (base32_sha1(payload) != digest or len(payload) != size):
                            raise ValueError(f"bad payload in {headers['WARC-Record-ID']}")
                        rows.append({"page_id": headers.get("X-Page-ID"), "url": headers["WARC-Target-URI"], "record_type": headers["WARC-Type"],
                                     "refers_to": headers.get("X-Refers-To-Page"), "payload_bytes": size, "payload_digest": digest, "file": name, "payload": payload})
                        held += len(payload or b"") * payloads + 200
                        if held > 4 * READ:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if seen != wanted:
                    raise ValueError(f"{name} has {seen} records, the manifest says {wanted}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    text = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, file string"
    files = manifest.select("file", "records").repartition(shuffle_partitions(spark), "file")
    out = files.mapInArrow(run, text + (", payload binary" if payloads else ""))
    return out.withColumns({c: F.col(c).cast(page_type) for c in ("page_id", "refers_to")})
