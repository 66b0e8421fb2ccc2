"""WARC archives written by Spark, the same bytes for the same rows, and read back.

Records are sorted by an integer key into shards (``ordered_shards``: exact ranges, not sampled ones); a task writes
its shards one record at a time, each record a gzip member of its own, and begins another file when the compressed
size passes ``roll_bytes``.  Headers, lengths and digests are made anew from the payload; ids are derived from key
and digest and the date is a parameter, so a lost task writes the same files again.  Files appear under temporary
names and are renamed once the manifest is settled (``files``).

Of records with equal payloads of at least ``min_revisit_bytes`` bytes, that with the largest key is a response and
the others are revisits without payload.  Only digests are grouped for this; the finding travels to the record's shard
as a small row that sorts before it, so payloads are shuffled once and a payload of a third of all rows costs its
digests.

Nulls and ties: a null payload is empty; a null key comes first, is a revisit if any equal payload has a key, and is
never referred to; a null target is written as ``urn:none``.  Of rows with equal key and payload the first is the
response (if the key is the largest) and the rest revisit it.  An empty table gives no file.  Other columns are not
read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.llm.common import ordered_shards
from constella.llm.files import Draft, commit, resolve, spread

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:constella:warc")
_VISIBLE = "".join(map(chr, range(33, 127)))


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _record(key: int | None, uri: str | None, payload: bytes, refers: int | None, date: str, level: int) -> bytes:
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    name = lambda k: f"<urn:uuid:{uuid.uuid5(_NAMES, f'{k}:{digest}')}>"
    headers = [("WARC-Type", "response" if refers is None else "revisit"),
               ("WARC-Record-ID", name("" if key is None else key) if refers is None else name(f"{key}>{refers}")),
               ("WARC-Date", date), ("WARC-Target-URI", quote(uri, safe=_VISIBLE) if uri else "urn:none"),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
               ("X-Record-Key", "" if key is None else str(key))]
    if refers is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers)), ("X-Refers-To-Key", str(refers))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _member(headers, block, level)


class _Rolled:
    """The files of one shard."""

    def __init__(self, root: str, shard: int, date: str, roll_bytes: int, level: int):
        self.root, self.shard, self.date, self.roll, self.level = root, shard, date, roll_bytes, level
        self.draft, self.seq, self.done = None, 0, []

    def add(self, record: bytes) -> None:
        if self.draft is None:
            self.draft, self.records, self.hash = Draft(self.root, f"part-{self.shard:08d}-{self.seq:05d}.warc.gz"), 0, hashlib.sha1()
            info = f"software: constella\r\nformat: WARC File Format 1.1\r\nfilename: {self.draft.name}\r\n".encode()
            self._put(_member([("WARC-Type", "warcinfo"),
                               ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, self.draft.name)}>"),
                               ("WARC-Date", self.date), ("WARC-Filename", self.draft.name),
                               ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))],
                              info, self.level))
        self._put(record)
        self.records += 1
        if self.draft.tell() >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.hash.update(data)
        self.draft.write(data)

    def close(self) -> None:
        if self.draft is not None:
            self.draft.close()
            self.done.append({"name": self.draft.name, "temp": self.draft.temp, "shard": self.shard, "seq": self.seq,
                              "records": self.records, "bytes": self.draft.size, "sha1": self.hash.hexdigest()})
            self.draft, self.seq = None, self.seq + 1


_MANIFEST = pa.schema([("name", pa.string()), ("temp", pa.string()), ("shard", pa.int64()), ("seq", pa.int64()),
                       ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())])


def write_warc(pages: DataFrame, root: str, key: str = "page_id", uri: str = "url", payload: str = "html",
               date: str = "2024-01-01T00:00:00Z", min_revisit_bytes: int = 0, shard_bytes: int = 32 << 20,
               roll_bytes: int = 16 << 20, level: int = 6) -> DataFrame:
    """Write a record per row below ``root``; return the manifest of the files."""
    rows = pages.select(F.col(key).cast("bigint").alias("_key"), F.col(uri).cast("string").alias("_uri"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("_payload"))
    rows = ordered_shards(rows, "_key", F.octet_length("_payload") + 512, shard_bytes)
    rows = rows.withColumn("_sha", F.sha1("_payload"))
    small = rows.filter(F.octet_length("_payload") >= min_revisit_bytes).select(
        "_shard", "_key", "_sha", F.octet_length("_payload").alias("_n"))
    copies = (small.groupBy("_sha", "_n").agg(F.count("*").alias("c"), F.max("_key").alias("_refers"))
              .filter("c > 1 and _refers is not null"))
    notes = small.join(copies, ["_sha", "_n"]).select("_shard", "_key", "_sha", "_refers").distinct()
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    stream = notes.select("_shard", "_key", F.lit(0).alias("_kind"), "_sha", "_refers", none("string", "_uri"),
                          none("binary", "_payload")).union(
        rows.select("_shard", "_key", F.lit(1).alias("_kind"), "_sha", none("bigint", "_refers"), "_uri", "_payload"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = stream.repartitionById(parts, F.pmod("_shard", F.lit(parts)).cast("int")).sortWithinPartitions(
        "_shard", F.asc_nulls_first("_key"), "_kind", "_sha", F.asc_nulls_first("_uri"))

    def write(batches):
        out, at, notes, seen = None, None, {}, set()
        columns = ("_shard", "_key", "_kind", "_sha", "_refers", "_uri", "_payload")
        for batch in batches:
            for i in range(batch.num_rows):
                shard, k, kind, sha, refers, target, body = (batch.column(c)[i].as_py() for c in columns)
                if out is None or out.shard != shard:
                    if out is not None:
                        out.close()
                        yield pa.RecordBatch.from_pylist(out.done, schema=_MANIFEST)
                    out = _Rolled(root, shard, date, roll_bytes, level)
                if at != (shard, k):
                    at, notes, seen = (shard, k), {}, set()
                if kind == 0:
                    notes[sha] = refers
                    continue
                first = notes.get(sha)
                if first == k and sha not in seen:    # the one that the others refer to
                    seen.add(sha)
                    first = None
                out.add(_record(k, target, body, first, date, level))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(out.done, schema=_MANIFEST)

    return commit(stream.mapInArrow(write, "name string, temp string, shard bigint, seq bigint, records bigint, "
                                           "bytes bigint, sha1 string"), root)


def members(uri: str):
    """(offset, content) of each gzip member of a file, one at a time."""
    fs, path = resolve(uri)
    with fs.open_input_stream(path, compression=None) as source:
        data, offset = b"", 0
        while True:
            unpacker, begin, parts = zlib.decompressobj(31), offset, []
            while not unpacker.eof:
                if not data and not (data := source.read(1 << 20)):
                    if parts:
                        raise EOFError(f"{uri} ends within the record at {begin}")
                    return
                parts.append(unpacker.decompress(data))
                offset += len(data) - len(unpacker.unused_data)
                data = unpacker.unused_data
            yield begin, b"".join(parts)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't match its header")
    return headers, block


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the files of a manifest, digests checked against what the files hold."""
    schema = pa.schema([("key", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("file", pa.string()), ("offset", pa.int64()), ("payload", pa.binary())])

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def read(batches):
        for batch in batches:
            for name, uri in zip(batch.column("name").to_pylist(), batch.column("uri").to_pylist()):
                held, size = [], 0
                for offset, content in members(uri):
                    headers, block = parse(content)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    http, _, body = block.partition(b"\r\n\r\n")
                    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Type"] == "response" and (len(body), _digest(body)) != (length, digest):
                        raise ValueError(f"{name}, record at {offset}: the payload doesn't match its digest")
                    held.append({"key": number(headers["X-Record-Key"]), "target_uri": headers["WARC-Target-URI"],
                                 "payload_bytes": length, "payload_digest": digest,
                                 "record_type": headers["WARC-Type"],
                                 "refers_to": number(headers.get("X-Refers-To-Key")), "file": name, "offset": offset,
                                 "payload": body if with_payload and headers["WARC-Type"] == "response" else None})
                    size += len(body) * with_payload + 200
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    found = spread(manifest.select("name", "uri")).mapInArrow(
        read, "key bigint, target_uri string, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to bigint, file string, offset bigint, payload binary")
    return found if with_payload else found.drop("payload")
