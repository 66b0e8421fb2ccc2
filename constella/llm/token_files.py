"""Token ids as Arrow files of fixed-size-list batches.

A file holds the ids of one shard of documents, one after the other in key order, cut into rows of ``seq_len`` ids:
``tokens: fixed_size_list<uint16|uint32>[seq_len]`` and ``mask: fixed_size_list<bool>[seq_len]`` (true: an id, false:
padding, in a file's last row only).  Record batches have a fixed number of rows, so sequence i lies in batch
i // batch_rows at row i % batch_rows, and a memory-mapped file gives any sequence or mask as a view without a copy.

Shards are exact ranges of the key (``ordered_shards``), so a file's content depends on the rows alone; a lost
executor's files are written again under other temporary names and only those in the manifest are renamed.

Nulls and ties: a null text is the empty text (its document is the end id alone); a null key comes first; rows with
equal keys follow in the order of their texts.  An empty table gives no file.  Other columns are not read.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.llm.chunks import ChunkTable
from constella.llm.common import cut, ordered_shards, sums_before
from constella.llm.files import Draft, commit, resolve, spread

BATCH_ROWS = 256
_encoders: dict[str, "TextEncoder"] = {}


class TextEncoder:
    """Whole texts to uint32 ids by the tokenizers library (add_special_tokens=False), each chunk once while it is kept."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # Spark already uses every core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # chunks of other vocabularies may not stand alone: their texts are encoded whole
        made = json.loads(self.tok.to_str())
        self.plain = made["normalizer"] is None and made["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.cache = ChunkTable(self.tok)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u4")
        return self.encode_all(pa.array([text]))[0]

    def _alone(self, texts: pa.Array) -> np.ndarray:
        """Whether each text is encoded whole: the library looks for special tokens before it splits."""
        alone = np.full(len(texts), not self.plain)
        for s in self.special:
            alone |= pc.match_substring(texts, s).fill_null(False).to_numpy(zero_copy_only=False)
        return alone

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return self.encode_all(texts)[1] if self._alone(texts).any() else self.cache.count_all(texts)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each."""
        alone = self._alone(texts)
        if not alone.any():
            return self.cache.encode_all(texts)
        ids, counts = self.cache.encode_all(texts.filter(pa.array(~alone)))
        others = iter(np.split(ids, np.cumsum(counts)[:-1]))
        found = [np.array(self.tok.encode(t.as_py() or "", add_special_tokens=False).ids, dtype="<u4") if whole else next(others)
                 for t, whole in zip(texts, alone)]
        return np.concatenate(found), np.array(list(map(len, found)), dtype=np.int64)


def encoder(path: str) -> TextEncoder:
    """One encoder for a worker process, so that its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def file_schema(seq_len: int, dtype: str) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), seq_len)),
                      ("mask", pa.list_(pa.bool_(), seq_len))])


class _ShardFile:
    """Writes one shard's ids as they come; holds at most one record batch and one document."""

    def __init__(self, root: str, shard: int, seq_len: int, dtype: str):
        self.seq_len, self.dtype, self.shard = seq_len, np.dtype(dtype), shard
        self.draft = Draft(root, f"tokens-{shard:08d}.arrow")
        self.out = pa.ipc.new_file(pa.PythonFile(_Sink(self.draft), "w"), file_schema(seq_len, dtype))
        self.waiting, self.held, self.total = [], 0, 0
        self.keys, self.starts = [], []

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.total)
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        full = self.seq_len * BATCH_ROWS
        if self.held >= full:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // full * full
            for i in range(0, whole, full):
                self._batch(flat[i:i + full], full)
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _batch(self, ids: np.ndarray, n: int) -> None:
        padded = -(-n // self.seq_len) * self.seq_len
        mask = np.zeros(padded, dtype=bool)
        mask[:n] = True
        tokens = np.zeros(padded, dtype=self.dtype)
        tokens[:n] = ids
        self.out.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (tokens, mask)],
            schema=file_schema(self.seq_len, self.dtype.name)))

    def close(self) -> dict:
        if self.held:
            self._batch(np.concatenate(self.waiting), self.held)
        self.out.close()
        index = _doc_index(self)
        self.draft.close()
        return {"name": self.draft.name, "temp": self.draft.temp, "shard": self.shard, "n_docs": len(self.keys),
                "n_tokens": self.total, "doc_index": index}


def _doc_index(file: _ShardFile) -> bytes:
    """Keys and starts of a shard's documents as one Arrow stream (a shard is bounded by its target)."""
    rows = pa.record_batch({"key": pa.array(file.keys, pa.int64()), "start": pa.array(file.starts, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


class _Sink:
    """The few methods that pyarrow asks of a Python file."""

    closed = False

    def __init__(self, draft: Draft):
        self.draft = draft

    def write(self, data) -> int:
        self.draft.write(data)
        return len(data)

    def flush(self) -> None:
        pass

    def tell(self) -> int:
        return self.draft.tell()

    def close(self) -> None:
        self.closed = True


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int, key: str = "doc_id",
                      text: str = "text", seq_len: int = 2048, dtype: str = "uint16",
                      shard_bytes: int = 16 << 20) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the shards below ``root``; return the manifest."""
    rows = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = ordered_shards(rows, "_key", F.coalesce(F.octet_length("_text"), F.lit(0)) + 8, shard_bytes)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionById(parts, F.pmod("_shard", F.lit(parts)).cast("int")).sortWithinPartitions(
        "_shard", F.asc_nulls_first("_key"), F.asc_nulls_first("_text"))

    def write(batches):
        enc, now = encoder(tokenizer), None
        for part in (batch.slice(at, 1000) for batch in batches for at in range(0, batch.num_rows, 1000)):
            ids, counts = enc.encode_all(part.column("_text"))
            if max(end_id, int(ids.max(initial=0))) > np.iinfo(dtype).max:
                raise ValueError(f"an id doesn't fit into {dtype}: pass a wider dtype")
            texts = np.split(ids, np.cumsum(counts)[:-1])
            for shard, k, x in zip(part.column("_shard").to_pylist(), part.column("_key").to_pylist(), texts):
                if now is None or now.shard != shard:
                    if now is not None:
                        yield _manifest([now.close()])
                    now = _ShardFile(root, shard, seq_len, dtype)
                now.add(k, np.append(x, np.uint32(end_id)))
        if now is not None:
            yield _manifest([now.close()])

    def _manifest(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(found, schema=pa.schema([
            ("name", pa.string()), ("temp", pa.string()), ("shard", pa.int64()), ("n_docs", pa.int64()),
            ("n_tokens", pa.int64()), ("doc_index", pa.binary())]))

    return commit(rows.mapInArrow(write, "name string, temp string, shard bigint, n_docs bigint, n_tokens bigint, "
                                         "doc_index binary"), root)


class TokenFile:
    """Random access to a written file; on a local or mounted path nothing is read before it is asked for."""

    def __init__(self, uri: str):
        fs, path = resolve(uri)
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.seq_len = self.file.schema.field("tokens").type.list_size
        self._held: tuple[int, pa.RecordBatch] = (-1, None)

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._held[0] != i:
            self._held = (i, self.file.get_batch(i))
        return self._held[1]

    def sequence(self, i: int) -> np.ndarray:
        row = i % BATCH_ROWS
        return self._batch(i // BATCH_ROWS).column("tokens").values.to_numpy()[row * self.seq_len:(row + 1) * self.seq_len]

    def mask(self, i: int) -> np.ndarray:
        batch, row = self._batch(i // BATCH_ROWS), i % BATCH_ROWS
        bits = batch.column("mask").values.slice(row * self.seq_len, self.seq_len)
        return bits.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids [start, start + n) of the shard; a view where they lie in one batch."""
        full = self.seq_len * BATCH_ROWS
        parts = []
        while n > 0:
            flat = self._batch(start // full).column("tokens").values.to_numpy()
            parts.append(flat[start % full:start % full + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, dtype="u4")])


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of the files: key, start over all files, n_tokens, ids_crc32, shard and its file."""
    # one row a shard; written, so that its size decides how it is joined
    offsets = cut(sums_before(manifest.select("shard", "n_tokens"), "shard", "n_tokens").select(
        "shard", F.col("_before").cast("bigint").alias("offset")), name="offsets")
    files = spread(manifest.select("name", "uri", "shard", "n_tokens", "doc_index"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                index = pa.ipc.open_stream(row["doc_index"]).read_all()
                starts = index.column("start").to_pylist()
                file, ends = TokenFile(row["uri"]), [*starts[1:], row["n_tokens"]]
                crcs = [zlib.crc32(file.ids(a, b - a).astype("<u4").tobytes()) for a, b in zip(starts, ends)]
                yield pa.record_batch({
                    "key": index.column("key").combine_chunks(),
                    "local_start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                    "shard": pa.array([row["shard"]] * len(starts), pa.int64()),
                    "file": pa.array([row["name"]] * len(starts))})

    docs = files.mapInArrow(read, "key bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, "
                                  "file string")
    return docs.join(offsets, "shard").select(
        "key", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "file")
