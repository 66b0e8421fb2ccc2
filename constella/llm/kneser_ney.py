"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash arrays, scored through mmap.

Counting.  Tasks turn texts into 64-bit word hashes, count the distinct (context, word) pairs of bounded blocks and send
them on as packed columns: a pair goes to the partition of its context, spread by its word over SPREAD partitions, so
the successors of a very frequent word (already one row a block) are merged by several tasks.  A merging task writes
its pairs as sorted hashes with counts, and passes on what the words need: per context the total and the number of
successors seen once, twice and more; per word its count and its number of contexts.  A second exchange by word merges
those into the word arrays.  Nothing is pruned; counts, discounts and the vocabulary come from all training rows.

Scoring.  P(w|h) = max(c(hw) - D, 0) / c(h) + g(h) P(w), where P(w) interpolates the discounted number of contexts of w
with a uniform share of one in V + 1, and D depends on the count (one, two, more) as estimated from the counts of
counts.  An unknown context leaves P(w).  Workers map the arrays into memory where the shared folder is a mounted
path, and read an array's file otherwise; they look up a batch's pairs sorted by array.

Tokens are the words between ASCII white space, A-Z lower-cased, and one end after each text; a text's first context is
a begin that is never a token.  Nulls and ties: a null text is the empty text (the end alone); repeated rows count as
often as they come; an empty training set gives every token the uniform share.  Other columns pass through; those
with the names of outputs are replaced.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from constella.llm.files import Draft, commit, resolve

SPREAD = 4
BLOCK = 2_000_000
_PIECE = 1 << 20
# no word holds a space
BEGIN, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" begin", b" end"))
_open: dict[str, dict[str, np.ndarray]] = {}


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's tokens, the end last; a long text is worked through in pieces cut at white space."""
    data, found, at = (text or "").encode().lower(), [], 0
    digest = xxhash.xxh64_intdigest
    while at < len(data):
        piece = data[at:at + _PIECE]
        if at + _PIECE < len(data):
            cut = max(map(piece.rfind, (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))) + 1
            while not cut:    # a word longer than the piece
                piece = data[at:at + len(piece) + _PIECE]
                cut = len(piece) if at + len(piece) >= len(data) else max(
                    map(piece.rfind, (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))) + 1
            piece = piece[:cut]
        found.append(np.array([digest(w) for w in piece.split()], dtype=np.uint64))
        at += len(piece)
    return np.append(np.concatenate(found) if found else np.empty(0, np.uint64), END)


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns with each byte's plane together, so that the exchange's compression finds the high zeros."""
    parts = [json.dumps([[c.dtype.str, len(c)] for c in columns]).encode() + b"\n"]
    parts += [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return b"".join(parts)


def _unpack(data: bytes) -> list[np.ndarray]:
    head, _, _ = data.partition(b"\n")
    at, out = len(head) + 1, []
    for kind, n in json.loads(head):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.empty(0, kind))
        at += n * width
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted keys begins."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _summed(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = _runs(key) if len(key) else np.empty(0, np.int64)
    return key[at], [np.add.reduceat(c[order], at) if len(key) else c for c in columns]


def _distinct_pairs(h: np.ndarray, w: np.ndarray, n: np.ndarray | None = None):
    order = np.lexsort((w, h))
    h, w = h[order], w[order]
    at = _runs(h, w) if len(h) else np.empty(0, np.int64)
    counts = np.diff(np.append(at, len(h))) if n is None else (np.add.reduceat(n[order], at) if len(h) else n)
    return h[at], w[at], counts.astype(np.uint64)


def _small(c: np.ndarray) -> np.ndarray:
    return c.astype(np.uint32) if not len(c) or c.max() < 1 << 32 else c.astype(np.uint64)


def _part(h: np.ndarray, w: np.ndarray, parts: int) -> np.ndarray:
    spread = (w >> np.uint64(62)) % np.uint64(SPREAD) * np.uint64(max(1, parts // SPREAD))
    return (((h >> np.uint64(20)) % np.uint64(parts)) + spread) % np.uint64(parts)


def _pair_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (h ^ (w * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _row(part: int, kind: str, data: bytes) -> pa.RecordBatch:
    return pa.record_batch({"part": pa.array([part], pa.int32()), "kind": pa.array([kind]),
                            "data": pa.array([data], pa.binary())})


_ROWS = "part int, kind string, data binary"


def _count(batches, parts: int):
    """Texts to packed distinct pairs, a block at a time."""
    held: list[np.ndarray] = []
    room = 0

    def block():
        h = np.concatenate([np.append(BEGIN, t[:-1]) for t in held])
        h, w, n = _distinct_pairs(h, np.concatenate(held))
        p = _part(h, w, parts)
        order = np.argsort(p, kind="stable")
        h, w, n, p = h[order], w[order], _small(n[order]), p[order]
        ends = np.append(_runs(p), len(p))
        for a, b in zip(ends[:-1], ends[1:]):
            at = _runs(h[a:b])
            yield _row(int(p[a]), "pairs", _pack([h[a:b][at], np.diff(np.append(at, b - a)).astype(np.uint32),
                                                  w[a:b], n[a:b]]))

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.append(word_hashes(text))
            room += len(held[-1])
            if room >= BLOCK:
                yield from block()
                held, room = [], 0
    if held:
        yield from block()


def _grouped(batches):
    """(part, [(kind, data)]) for rows sorted by part."""
    now, rows = None, []
    for batch in batches:
        for part, kind, data in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "data"))):
            if part != now:
                if rows:
                    yield now, rows
                now, rows = part, []
            rows.append((kind, data))
    if rows:
        yield now, rows


def _save(root: str, name: str, arrays: dict[str, np.ndarray]) -> dict:
    """One file: a line of JSON padded to 64 bytes, then the arrays, each at a multiple of 64."""
    draft, head, at = Draft(root, name), {}, 0
    for k, a in arrays.items():
        head[k] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    said = json.dumps(head).encode()
    draft.write(said + b" " * (-(len(said) + 1) % 64) + b"\n")
    for a in arrays.values():
        draft.write(a.tobytes())
        draft.write(b"\0" * (-a.nbytes % 64))
    draft.close()
    return {"name": name, "temp": draft.temp}


def load(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file; views of the mapped file on a mounted path."""
    if uri not in _open:
        fs, path = resolve(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        data = memoryview(source.read_buffer() if fs.type_name == "local" else source.read())
        end = bytes(data[:4096]).index(b"\n") + 1
        _open[uri] = {k: np.frombuffer(data, kind, n, end + at) for k, (kind, n, at) in json.loads(bytes(data[:end])).items()}
    return _open[uri]


def _merge(batches, root: str, parts: int):
    """Pairs of a partition to a file of sorted hashes and counts, and the parts of the word arrays."""
    for part, rows in _grouped(batches):
        columns = [_unpack(data) for _, data in rows]
        h, w, n = _distinct_pairs(np.concatenate([np.repeat(c[0], c[1]) for c in columns]),
                                  np.concatenate([c[2] for c in columns]),
                                  np.concatenate([c[3].astype(np.uint64) for c in columns]))
        hashes = _pair_hash(h, w)
        order = np.argsort(hashes, kind="stable")
        found = _save(root, f"pairs-{part:06d}.bin", {"hash": hashes[order], "count": _small(n[order])})
        stats = {f"pairs{k}": int((n == k).sum()) for k in (1, 2, 3, 4)} | {"pairs": len(n)}
        yield _row(part % parts, "file", json.dumps(found | {"kind": "pairs", "part": part, "stats": stats}).encode())
        at = _runs(h)
        contexts = [np.add.reduceat(x.astype(np.uint64), at) for x in (n, n == 1, n == 2, n > 2)]
        word, (contexts_of, count) = _summed(w, [np.ones(len(w), np.uint64), n])
        for kind, key, values in (("context", h[at], contexts), ("word", word, [contexts_of, count])):
            p = (key >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(p, kind="stable")
            ends = np.append(_runs(p[order]), len(p))
            for a, b in zip(ends[:-1], ends[1:]):
                of = order[a:b]
                yield _row(int(p[of[0]]), kind, _pack([key[of], *(_small(v[of]) for v in values)]))


def _words(batches, root: str):
    """Parts of the word arrays to their files; passes the pairs' manifest rows on."""
    def manifest(x: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([x | {"stats": json.dumps(x["stats"])}], schema=pa.schema([
            ("name", pa.string()), ("temp", pa.string()), ("kind", pa.string()), ("part", pa.int32()),
            ("stats", pa.string())]))

    for part, rows in _grouped(batches):
        files = [json.loads(data) for kind, data in rows if kind == "file"]
        for x in files:
            yield manifest(x)
        merged = {}
        for kind, width in (("context", 4), ("word", 2)):
            columns = [_unpack(data) for k, data in rows if k == kind]
            key = np.concatenate([c[0] for c in columns]) if columns else np.empty(0, np.uint64)
            merged[kind] = _summed(key, [np.concatenate([c[i].astype(np.uint64) for c in columns]) if columns
                                         else np.empty(0, np.uint64) for i in range(1, width + 1)])
        if not len(merged["context"][0]) and not len(merged["word"][0]):
            continue
        key = np.union1d(merged["context"][0], merged["word"][0])
        arrays = {"hash": key}
        for kind, names in (("context", ("total", "one", "two", "more")), ("word", ("contexts", "count"))):
            own, values = merged[kind]
            for name, v in zip(names, values):
                arrays[name] = np.zeros(len(key), np.uint64)
                arrays[name][np.searchsorted(key, own)] = v
        of = arrays["contexts"]
        stats = {f"words{k}": int((of == k).sum()) for k in (1, 2)} | {
            "words3": int((of == 3).sum()), "words4": int((of == 4).sum()), "types": int((of > 0).sum()),
            "tokens": int(arrays["count"].sum())}
        found = _save(root, f"words-{part:06d}.bin", {"hash": key} | {
            k: _small(v) for k, v in arrays.items() if k != "hash"})
        yield manifest(found | {"kind": "words", "part": part, "stats": stats})


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 0, 1, 2 and more, from the counts of counts; between nothing and the count itself."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * b / a if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [0.0, *(min(max(d, 0.0), k) for k, d in zip((1, 2, 3), raw))]


class Model:
    """What scoring needs beside the files: their places and a few totals."""

    def __init__(self, parts: int, pairs: dict[int, str], words: dict[int, str], stats: dict[str, int]):
        self.parts, self.pairs, self.words = parts, pairs, words
        g = lambda k: stats.get(k, 0)
        self.tokens, self.types, self.bigrams = g("tokens"), g("types"), g("pairs")
        self.pair_discount = np.array(_discounts(*(g(f"pairs{k}") for k in (1, 2, 3, 4))))
        self.word_discount = np.array(_discounts(*(g(f"words{k}") for k in (1, 2, 3, 4))))
        d, more = self.word_discount, self.types - g("words1") - g("words2")
        self.word_rest = (d[1] * g("words1") + d[2] * g("words2") + d[3] * more) / self.bigrams if self.bigrams else 1.0

    def _found(self, uri: str | None, hashes: np.ndarray, names: tuple) -> list[np.ndarray]:
        if uri is None:
            return [np.zeros(len(hashes)) for _ in names]
        arrays = load(uri)
        at = np.minimum(np.searchsorted(arrays["hash"], hashes), len(arrays["hash"]) - 1)
        hit = arrays["hash"][at] == hashes
        return [np.where(hit, arrays[n][at].astype(np.float64), 0.0) for n in names]

    def _lookup(self, uris: dict[int, str], part: np.ndarray, hashes: np.ndarray, names: tuple) -> list[np.ndarray]:
        order = np.lexsort((hashes, part))
        out = [np.empty(len(hashes)) for _ in names]
        ends = np.append(_runs(part[order]), len(part)) if len(part) else [0]
        for a, b in zip(ends[:-1], ends[1:]):
            of = order[a:b]
            for target, v in zip(out, self._found(uris.get(int(part[of[0]])), hashes[of], names)):
                target[of] = v
        return out

    def log_probabilities(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(w|h) and the training count of w, for aligned hashes."""
        both, at = np.unique(np.concatenate([h, w]), return_inverse=True)
        part = (both >> np.uint64(20)) % np.uint64(self.parts)
        total, one, two, more, contexts, count = (
            x for x in self._lookup(self.words, part, both, ("total", "one", "two", "more", "contexts", "count")))
        of_h, of_w = at[:len(h)], at[len(h):]
        pair, = self._lookup(self.pairs, _part(h, w, self.parts), _pair_hash(h, w), ("count",))
        level = lambda c: np.minimum(c, 3).astype(np.int64)
        types = max(self.bigrams, 1)
        single = np.maximum(contexts - self.word_discount[level(contexts)], 0) / types + self.word_rest / (self.types + 1)
        d = self.pair_discount
        seen = total[of_h] > 0
        c = np.where(seen, total[of_h], 1.0)
        rest = np.where(seen, (d[1] * one + d[2] * two + d[3] * more)[of_h] / c, 1.0)
        p = np.where(seen, np.maximum(pair - d[level(pair)], 0) / c, 0.0) + rest * single[of_w]
        return np.log10(p), count[of_w]


def train(docs: DataFrame, root: str, text: str = "text") -> Model:
    """Count all texts of ``docs`` and write the model's files below ``root``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_part = lambda df: df.repartitionById(parts, "part").sortWithinPartitions("part")
    pairs = docs.select(F.col(text).cast("string")).mapInArrow(lambda b: _count(b, parts), _ROWS)
    merged = by_part(pairs).mapInArrow(lambda b: _merge(b, root, parts), _ROWS)
    files = commit(by_part(merged).mapInArrow(
        lambda b: _words(b, root), "name string, temp string, kind string, part int, stats string"), root)
    uris: dict[str, dict[int, str]] = {"pairs": {}, "words": {}}
    stats: dict[str, int] = {}
    for x in files.collect():    # two rows a partition
        uris[x.kind][x.part] = x.uri
        for k, v in json.loads(x.stats).items():
            stats[k] = stats.get(k, 0) + v
    return Model(parts, uris["pairs"], uris["words"], stats)


OUTPUTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (log10 of the text)."""
    docs = docs.drop(*OUTPUTS)

    def scored(tokens: list[np.ndarray]) -> list[np.ndarray]:
        w = np.concatenate(tokens)
        h = np.concatenate([np.append(BEGIN, t[:-1]) for t in tokens])
        n = np.array([len(t) for t in tokens])
        starts, out = np.concatenate([[0], np.cumsum(n)[:-1]]), np.zeros((3, len(w)))
        for a in range(0, len(w), BLOCK):
            b = min(a + BLOCK, len(w))
            out[0, a:b], count = model.log_probabilities(h[a:b], w[a:b])
            out[1, a:b] = count > 0
            out[2, a:b] = np.log10((count + 1) / (model.tokens + model.types + 1))
        total = np.add.reduceat(out, starts, axis=1)
        return [n, total[1].astype(np.int64), np.full(len(n), model.tokens), total[2], total[0]]

    def each(batches):
        for batch in batches:
            parts, held, room = [], [], 0
            for t in batch.column(text).to_pylist():
                held.append(word_hashes(t))
                room += len(held[-1])
                if room >= BLOCK // 2:
                    parts.append(scored(held))
                    held, room = [], 0
            if held:
                parts.append(scored(held))
            values = [np.concatenate(x) for x in zip(*parts)] if parts else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, k) for v, k in zip(values, kinds))],
                                             names=[*batch.schema.names, *OUTPUTS])

    kinds = [T.LongType()] * 3 + [T.DoubleType()] * 2
    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(OUTPUTS, kinds))]))


def perplexity(score: float, n_tokens: int) -> float:
    return math.pow(10.0, -score / n_tokens)
