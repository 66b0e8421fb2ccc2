"""Byte-level BPE encoding and decoding from a file of ranks, without a tokenizer library.

Two tiers.  First, a minimal perfect hash over the vocabulary (hash and displace: one displacement for each bucket of
keys, one slot for each key, no empty slot) tells whether a whole pre-token is in the vocabulary.  Other pre-tokens
are merged: a doubly linked list over their bytes and a heap of neighbouring pairs ordered by (rank, position), so a
pre-token of n bytes costs O(n log n) however long it is.

``bpe_encode`` adds an array of ids to rows of text, ``bpe_decode`` turns such an array back into bytes.  A null text
is the empty text (no ids); a null array decodes to no bytes.  Other columns pass through unchanged; one
that already has the output's name is replaced.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from constella.llm.chunks import ChunkCache

_codecs: dict[tuple, "Codec"] = {}


class PerfectHash:
    """Minimal perfect hash of ``keys`` to their place in ``slots``; a key that isn't there finds -1."""

    def __init__(self, keys: list[bytes], load: int = 4):
        self.n, self.buckets = len(keys), max(1, -(-len(keys) // load))
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        self.shift = [0] * self.buckets
        self.slots = [-1] * self.n
        # large buckets first, while most slots are free; each tries displacements until its keys fit
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = None
        for b in order:
            if not groups[b]:
                break
            if len(groups[b]) == 1:    # a lone key takes any slot that is left; its place is kept as -1 - slot
                free = free or [s for s in range(self.n) if self.slots[s] < 0]
                self.shift[b] = -1 - (s := free.pop())
                self.slots[s] = groups[b][0]
                continue
            d = 0
            while True:
                at = [self._slot(hashes[i], d) for i in groups[b]]
                if len(set(at)) == len(at) and all(self.slots[s] < 0 for s in at):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(groups[b], at):
                self.slots[s] = i
        self.keys = [keys[i] for i in self.slots]

    def _slot(self, h: int, d: int) -> int:
        if d < 0:
            return -1 - d
        return ((h >> 20) * 0x9E3779B97F4A7C15 + d * ((h >> 44) | 1)) % self.n if d < 64 else (
            ((h ^ (d * 0xD6E8FEB86659FD93)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 11) % self.n

    def find(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.shift[h % self.buckets])
        return self.slots[s] if self.keys[s] == key else -1


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
        self.ids = [i for i, _ in pairs]
        self.pieces = [p for _, p in pairs]
        self.table = dict(pairs)
        self.ranks = {p: i for i, p in pairs}    # of the pairs that merging meets
        self._words = self.places = None
        self.cache = ChunkCache(self._many, pattern, chunks=60_000, words=250_000)

    @property
    def words(self) -> PerfectHash:
        """Built when something is encoded; decoding has no use for it."""
        if self._words is None:
            self._words = PerfectHash(self.pieces)
        return self._words

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that isn't in the vocabulary."""
        n, rank, push, pop = len(word), self.ranks.get, heapq.heappush, heapq.heappop
        # end[i]: where the part that begins at byte i ends, 0 once it is merged into the one before
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = pop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop or stop <= middle:
                continue    # one of the two has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(word[i:end[stop]])) is not None:
                    push(heap, (r, i, end[stop]))
            if (j := before[i]) >= 0 and (r := rank(word[j:stop])) is not None:
                push(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return out

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        i = self.words.find(raw)
        return [self.ids[i]] if i >= 0 else self.merge(raw)

    def _many(self, words: list[str]) -> list[bytes]:
        return [np.array(self.encode_word(w), dtype="<i4").tobytes() for w in words]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        return self.cache.encode(text) if text else b""

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        ids, counts = self.cache.encode_all(texts, "<i4")
        ends = np.concatenate([[0], np.cumsum(counts)]).astype("i4")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; an id that isn't in the vocabulary is an error."""
        if self.places is None:
            self.places = pa.array([self.table.get(i) for i in range(self.ids[-1] + 1)], pa.large_binary())
        pieces = self.places.take(lists.flatten())
        if pieces.null_count:
            raise ValueError("an id that isn't in the vocabulary")
        _, ends, data = pieces.buffers()
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
        ends = np.frombuffer(ends, dtype="i8", count=len(pieces) + 1) if len(pieces) else np.zeros(1, dtype="i8")
        return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends[at]), data]).cast(pa.binary())


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def bpe_encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out`` array<int>: the ids of the whole text, each pre-token encoded by itself."""
    def encode(batches):
        enc = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):    # a few MB of ids at a time
                part = batch.slice(at, 1000)
                yield _replaced(part, out, enc.encode_all(part.column(text)))

    df = df.drop(out)
    return df.mapInArrow(encode, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def bpe_decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` binary: the bytes that the ids stand for."""
    def decode(batches):
        enc = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):    # few documents a batch
                part = batch.slice(at, 500)
                yield _replaced(part, out, enc.decode_all(part.column(ids)))

    df = df.drop(out)
    return df.mapInArrow(decode, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))
