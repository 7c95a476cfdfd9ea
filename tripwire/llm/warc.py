"""WARC archives with a two-level capture index.

Writing: one gzip member per record, so that a record can be read by its byte
range. Equal payloads are stored once; the others are revisit records.
Index: captures sorted by (reversed-host URL key, id) are cut into compressed
blocks of some thousand lines; a sparse directory keeps the first entry and the
byte range of every block, and one row per index shard keeps its bounds.
Reading: a request is placed by binary search in the shard bounds, then in the
shard's directory; one range read brings the block, binary search in it finds
the capture, and a range read of the archive brings the record.

All files go to the shared folder through ``pyarrow.fs``. A task writes files of
names of its own and reports them in its rows, so a task that runs again leaves
at most unused files behind.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm.common import drop_path, scratch_path, shared_fs, write_once

#: Payloads from this size on are stored once.
MIN_REVISIT = 1000
#: Lines of an index block, and decompressed blocks that a reading task keeps.
BLOCK_LINES, KEPT_BLOCKS = 2000, 8
#: Compressed bytes after which a task starts another archive file.
MAX_FILE = 1 << 30
#: Archive bytes that a reading task takes at most, and least where there are idle cores, on average.
READ_BYTES, LEAST_READ = 64 << 20, 1 << 20
#: The table has no capture time; records carry this one.
DATE = "2024-01-01T00:00:00Z"
#: Below every id: sorts captures without an id first.
NO_ID = -(1 << 63)
ID = "urn:x-capture:"


def _create(path: str):
    store, p = shared_fs(path)
    store.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(p, compression=None)


def url_key(url_col: str) -> Column:
    """Sort key: host labels from the right joined by commas, ``)``, then path and
    query as they are, white space and control characters percent-encoded. Null,
    or without ``://``: the whole string behind ``)``."""
    u = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.regexp_extract(u, r"(?s)^.*?://(.*)$", 1)).otherwise(F.concat(F.lit("/"), u))
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)
    for ch in ("\t", "\n", "\r"):
        key = F.regexp_replace(key, ch, f"%{ord(ch):02X}")
    return key


def record(kind: str, cap_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{'' if cap_id is None else cap_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{x:02X}" for x in c.encode()) for c in url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{ID}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Type, id, payload size and digest, and the id referred to, of one record.
    A response's size and digest are taken from its payload, and must agree with
    its header; a revisit's are those of the payload it refers to."""
    top, body = raw.split(b"\r\n\r\n", 1)
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    body = body[: int(head["Content-Length"])]
    http, payload = body.split(b"\r\n\r\n", 1)
    own = lambda v: int(v[len(ID) + 1: -1]) if v and len(v) > len(ID) + 2 else None
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    if head["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
    return {"id": own(head["WARC-Record-ID"]), "type": head["WARC-Type"], "payload": payload, "size": size, "digest": digest,
            "refers_to": own(head.get("WARC-Refers-To"))}


def _captures(df: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload or null, digest, size, keeper): keeper is the id of the
    response that holds the payload, null where the row is one itself."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "utf-8").alias("payload")) \
        .withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    # one small row per repeated payload; map-side combined, so a payload that a third of the rows share is one row per task
    kept = rows.filter((F.col("size") >= MIN_REVISIT) & F.col("id").isNotNull()).groupBy("digest") \
        .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("kd"), "keeper")
    out = rows.join(kept, (rows["digest"] == kept["kd"]) & rows["id"].isNotNull(), "left")
    own = F.col("keeper").isNull() | (F.col("keeper") == F.col("id"))
    return out.select("id", "url", F.when(own, F.col("payload")).alias("payload"), "digest", "size", F.when(~own, F.col("keeper")).alias("keeper"))


@dataclass
class Archive:
    """Where an archive lies: the folder, the shard table (file, directory,
    first and last entry of each index shard; one row per index file), and the
    bytes of its records."""
    path: str
    shards: list[tuple]
    size: int = 0


def write_archive(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  path: str | None = None) -> Archive:
    """Write a record per row and the two-level index of them.

    Payload: the text in UTF-8 (null: empty). Of equal payloads of at least
    MIN_REVISIT bytes the row with the largest id is the response, the others
    revisit it; rows without an id are always responses, and so are all rows
    that repeat the largest id. An empty table gives an archive without files.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "warc")
    caps = _captures(df, id_col, url_col, payload_col).withColumn("key", url_key("url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, name, at = TaskContext.get().partitionId(), None, "", 0
        for b in batches:
            rows = []
            for x in b.to_pylist():
                if out is None or at >= MAX_FILE:
                    if out is not None:
                        out.close()
                    name, at = f"{path}/data/part-{task:05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = _create(name)
                kind = "response" if x["payload"] is not None else "revisit"
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = z.compress(record(kind, x["id"], x["url"], x["payload"] or b"", x["digest"], x["size"], x["keeper"])) + z.flush()
                out.write(raw)
                rows.append((x["key"], NO_ID if x["id"] is None else x["id"], kind, x["digest"], name, at, len(raw)))
                at += len(raw)
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["key", "id", "type", "digest", "file", "offset", "length"]), schema=LINE, preserve_index=False)
        if out is not None:
            out.close()

    lines, lines_path = write_once(caps.mapInArrow(write, "key string, id long, type string, digest string, file string, offset long, length long"), "warc-lines")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, block, directory, last = None, 0, [], [], None
        name = f"{path}/index/shard-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"

        def flush():
            nonlocal at, block
            raw = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in block).encode())
            out.write(raw)
            directory.append([block[0][0], block[0][1], at, len(raw)])
            at, block = at + len(raw), []

        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns)):
                out = out or _create(f"{name}.idx")
                block.append(x)
                last = x
                if len(block) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if block:
            flush()
        out.close()
        with _create(f"{name}.dir") as d:
            d.write(zlib.compress(json.dumps(directory, ensure_ascii=False).encode()))
        yield pa.RecordBatch.from_pylist([{"name": name, "first_key": directory[0][0], "first_id": directory[0][1], "last_key": last[0], "last_id": last[1]}])

    shards, shards_path = write_once(lines.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "file", "offset")
                                     .mapInArrow(index, "name string, first_key string, first_id long, last_key string, last_id long"), "warc-shards")
    # one row per index file, so at most as many as there are shuffle partitions
    found = sorted((r.first_key, r.first_id, r.last_key, r.last_id, r.name) for r in shards.collect())
    size = lines.agg(F.sum("length")).first()[0] or 0
    drop_path(spark, lines_path, shards_path)
    return Archive(path, found, size)


LINE = pa.schema([("key", pa.string()), ("id", pa.int64()), ("type", pa.string()), ("digest", pa.string()),
                  ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


class IndexReader:
    """Binary searches in shard bounds, directories and blocks; keeps the last
    KEPT_BLOCKS blocks and the directory of the last shard."""

    def __init__(self, shards: list[tuple]):
        self.shards, self.firsts = shards, [s[:2] for s in shards]
        self.blocks: OrderedDict = OrderedDict()
        self.directory: tuple = ("", [], [])

    def _read(self, path: str, offset: int, length: int) -> bytes:
        store, p = shared_fs(path)
        with store.open_input_file(p) as f:
            return f.read_at(length, offset)

    def _directory(self, name: str) -> tuple:
        if self.directory[0] != name:
            store, p = shared_fs(f"{name}.dir")
            with store.open_input_file(p) as f:
                rows = json.loads(zlib.decompress(f.read()))
            self.directory = (name, rows, [tuple(r[:2]) for r in rows])
        return self.directory

    def _block(self, name: str, offset: int, length: int) -> tuple:
        at = (name, offset)
        if at not in self.blocks:
            rows = [json.loads(x) for x in zlib.decompress(self._read(f"{name}.idx", offset, length)).decode().split("\n")]
            self.blocks[at] = (rows, [tuple(r[:2]) for r in rows])
            while len(self.blocks) > KEPT_BLOCKS:
                self.blocks.popitem(last=False)
        self.blocks.move_to_end(at)
        return self.blocks[at]

    def find(self, low: tuple, high: tuple) -> Iterator[list]:
        """Index lines with low <= (key, id) <= high, in order."""
        # entries equal to a bound may start in the shard or block before the first one that starts at it
        for s in self.shards[max(0, bisect_left(self.firsts, low) - 1): bisect_right(self.firsts, high)]:
            if (s[2], s[3]) < low:
                continue
            name, rows, firsts = self._directory(s[4])
            for r in rows[max(0, bisect_left(firsts, low) - 1): bisect_right(firsts, high)]:
                lines, keys = self._block(name, r[2], r[3])
                yield from lines[bisect_left(keys, low): bisect_right(keys, high)]


def lookup(archive: Archive, requests: DataFrame) -> DataFrame:
    """Index lines of ``requests(key, id)``: the captures of that key and id, or
    of the whole key where id is null. Each request should come once."""
    shared = requests.sparkSession.sparkContext.broadcast(archive.shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(shared.value)
        for b in batches:
            found = []
            for key, cap in zip(*(c.to_pylist() for c in b.columns)):
                for line in reader.find((key, NO_ID if cap is None else cap), (key, (1 << 63) - 1 if cap is None else cap)):
                    found.append(line)
                    if len(found) >= 10_000:
                        yield _lines(found)
                        found = []
            yield _lines(found)

    # sorted requests meet each block once
    return requests.select("key", "id").repartitionByRange("key", "id").sortWithinPartitions("key", "id") \
        .mapInArrow(run, "key string, id long, type string, digest string, file string, offset long, length long")


def _lines(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(LINE)], schema=LINE)


def read_records(lines: DataFrame, archive_bytes: int | None = None) -> DataFrame:
    """The records of index lines, by range reads in file order: (id, type, size, digest, refers_to, payload).

    An index line is tiny beside its record, so tasks are not dealt by the bytes of
    the lines where ``archive_bytes``, about the length of the records, is known."""
    parts = []
    if archive_bytes is not None:
        idle = min(lines.sparkSession.sparkContext.defaultParallelism, -(-archive_bytes // LEAST_READ))
        parts = [max(-(-archive_bytes // READ_BYTES), idle, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for b in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    if f is not None:
                        f.close()
                    store, p = shared_fs(file)
                    name, f = file, store.open_input_file(p)
                x = parse(zlib.decompress(f.read_at(length, offset), 31))
                rows.append(x)
                held += len(x["payload"])
                if held > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, RECORD)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, RECORD)
        if f is not None:
            f.close()

    return lines.select("file", "offset", "length").repartitionByRange(*parts, "file", "offset").sortWithinPartitions("file", "offset") \
        .mapInArrow(run, "id long, type string, size long, digest string, refers_to long, payload binary")


RECORD = pa.schema([("id", pa.int64()), ("type", pa.string()), ("size", pa.int64()), ("digest", pa.string()),
                    ("refers_to", pa.int64()), ("payload", pa.binary())])


def warc_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Archive every row, then look every capture up in the index and read it
    back: (id, payload_bytes, payload_digest, record_type, refers_to)."""
    archive = write_archive(df, id_col, url_col, payload_col)
    wanted = df.select(url_key(url_col).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")).distinct()
    return read_records(lookup(archive, wanted), archive.size).select(
        F.col("id").alias(id_col), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
