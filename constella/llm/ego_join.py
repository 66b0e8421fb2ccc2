"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2t) of each other.  The vectors are projected on their leading
principal dimensions, given the grid cell of width eps that holds them, sorted by cell in lexicographic (epsilon grid)
order and written as blocks of consecutive vectors.  Two intervals of that sequence are joined recursively: if the
boxes around their projections (with the range of the part of the vectors' length that the projection leaves out) are
more than eps apart, nothing in them can link and both are skipped; single blocks are compared by a matrix product in
double precision, again only where their sub-blocks' boxes are close.

Equal vectors are one class, so copies cost one vector.  A block pair returns link counts and a spanning forest of its
links, never the pairs themselves.  Blocks are files in the shared folder (temporary names, manifest, renames); a pair
of blocks is a task's unit of work.  What the driver holds is bounded: a covariance of at most ``axes`` dimensions and
the boxes of at most about MAX_BLOCKS blocks.

Nulls and ties: a null or empty or zero vector, and a vector with a null or non-finite component, link with nothing
(n_links 0, component_id its own id).  Vectors of different lengths don't link.  Repeated rows count as other vectors
and are returned as often as they come.  A row without an id takes part by its vector and counts as another vector;
component_id is the smallest id that a component has, null where it has none.  Classes whose smallest id is the same
are one component.  Other columns are not read.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.llm.common import connected_components, cut, shared_dir
from constella.llm.files import Draft, commit, resolve

MAX_BLOCKS = 16_384
SUB = 512


def _units(vectors: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, padded with zeros to ``width``, and the vectors' lengths."""
    out, dims = np.zeros((len(vectors), width)), np.zeros(len(vectors), dtype=np.int64)
    for i, v in enumerate(vectors):
        x = np.asarray(v, dtype=np.float64)
        x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))    # a power of two: exact, and squares stay in range
        out[i, :len(x)], dims[i] = x / math.sqrt(float(x @ x)), len(x)
    return out, dims


def _principal(classes: DataFrame, width: int, leading: int, axes: int) -> np.ndarray:
    """(width, leading) orthonormal directions of largest variance among the first ``axes`` coordinates."""
    d = min(width, axes)

    def sums(batches):
        total = np.zeros((d + 1, d))
        n = 0
        for batch in batches:
            u = _units(batch.column("vec").to_pylist(), width)[0][:, :d]
            total[:d] += u.T @ u
            total[d] += u.sum(0)
            n += len(u)
        flat = np.append(total.ravel(), n)
        yield pa.record_batch({"at": pa.array(np.arange(len(flat))), "x": pa.array(flat)})

    rows = classes.select("vec").mapInArrow(sums, "at bigint, x double").groupBy("at").agg(F.sum("x").alias("x"))
    flat = np.zeros((d + 1) * d + 1)
    for at, x in rows.collect():    # (d + 1) * d + 1 numbers, whatever the number of vectors
        flat[at] = x
    total, n = flat[:-1].reshape(d + 1, d), max(flat[-1], 1.0)
    mean = total[d] / n
    _, directions = np.linalg.eigh(total[:d] / n - np.outer(mean, mean))
    out = np.zeros((width, min(leading, d)))
    out[:d] = directions[:, ::-1][:, :out.shape[1]]
    return out


def _boxes(projected: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the projection and the length of the rest: distances in these are never above the true ones."""
    rest = np.sqrt(np.maximum(0.0, (units * units).sum(1) - (projected * projected).sum(1)))
    all_ = np.column_stack([projected, rest])
    return all_.min(0), all_.max(0)


def _apart(low_a, high_a, low_b, high_b, eps: float) -> bool:
    gap = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap) > eps * eps + 1e-9


def _partners(i: int, low: np.ndarray, high: np.ndarray, eps: float) -> list[int]:
    """Blocks from i on that may hold neighbours of block i: intervals of the sequence, halved unless far away."""
    found, todo = [], [(i, len(low))]
    while todo:
        a, b = todo.pop()
        if _apart(low[i], high[i], low[a:b].min(0), high[a:b].max(0), eps):
            continue
        if b - a == 1:
            found.append(a)
        else:
            todo += [((a + b) // 2, b), (a, (a + b) // 2)]
    return found


class _Joined:
    """Union-find over node ids, keeping only the links that joined two sets."""

    def __init__(self):
        self.top: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        top = self.top
        top.setdefault(x, x)
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    def link(self, a: int, b: int) -> None:
        p, q = self.root(a), self.root(b)
        if p != q:
            self.top[p] = q
            self.links.append((a, b))


def _stars(near: np.ndarray):
    """For a dense boolean block: (row, rows, columns) of each connected part, found by widening from one row."""
    left = near.any(1)
    while left.any():
        rows = np.zeros(len(near), dtype=bool)
        rows[start := int(left.argmax())] = True
        while True:
            columns = near[rows].any(0)
            wider = near[:, columns].any(1)
            if (wider == rows).all():
                break
            rows = wider
        left &= ~rows
        yield start, np.nonzero(rows)[0], np.nonzero(columns)[0]


class _Block:
    def __init__(self, data: bytes):
        x = np.load(io.BytesIO(data))
        self.ids, self.n, self.dims, self.units, self.proj = (x[k] for k in ("ids", "n", "dims", "units", "proj"))
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        self.parts = [(a, min(a + SUB, len(self.ids))) for a in range(0, len(self.ids), SUB)]
        self.boxes = [_boxes(self.proj[a:b], self.units[a:b]) for a, b in self.parts]


def _compare(a: _Block, b: _Block, threshold: float, eps: float, joined: _Joined) -> None:
    """Add the links between two blocks (or within one) to their counts and to ``joined``."""
    mixed = len(set(a.dims.tolist()) | set(b.dims.tolist())) > 1
    for i, (a0, a1) in enumerate(a.parts):
        for j, (b0, b1) in enumerate(b.parts):
            if a is b and j < i or _apart(*a.boxes[i], *b.boxes[j], eps):
                continue
            near = a.units[a0:a1] @ b.units[b0:b1].T >= threshold
            if mixed:
                near &= a.dims[a0:a1, None] == b.dims[None, b0:b1]
            if same := a is b and i == j:
                np.fill_diagonal(near, False)
            count = int(np.count_nonzero(near))
            if not count:
                continue
            a.links[a0:a1] += near @ b.n[b0:b1]
            if not same:
                b.links[b0:b1] += a.n[a0:a1] @ near
            if count <= 4 * SUB:
                for x, y in zip(*(k.tolist() for k in np.nonzero(near))):
                    joined.link(int(a.ids[a0 + x]), int(b.ids[b0 + y]))
            else:
                for start, rows, columns in _stars(near):
                    for y in columns:
                        joined.link(int(a.ids[a0 + start]), int(b.ids[b0 + y]))
                    for x in rows:
                        joined.link(int(b.ids[b0 + columns[0]]), int(a.ids[a0 + x]))


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                 leading: int = 8, axes: int = 512, block_rows: int = 4096) -> DataFrame:
    """(key, n_links, component_id): every row with the number of other vectors of cosine >= threshold, and the
    smallest id within reach by such links."""
    spark, eps = df.sparkSession, math.sqrt(max(0.0, 2 - 2 * threshold))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vec", F.when(usable, F.col("vec"))).withColumn("mark", F.xxhash64("vec"))
    # a class's node is a number of its own, fixed by the cut, since it may have no id
    classes = cut(rows.filter("vec is not null").groupBy("mark", "vec").agg(F.min("id").alias("low"), F.count("*").alias("n"))
                  .withColumn("node", F.monotonically_increasing_id()), name="vectors")
    count, width = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not count:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("bigint").alias("n_links"),
                           F.col("id").alias("component_id"))
    directions = _principal(classes, width, leading, axes)
    cell = max(eps, 1e-6)
    root, size = shared_dir(spark, "blocks"), max(block_rows, -(-count // MAX_BLOCKS))

    def place(batches):
        for batch in batches:
            proj = _units(batch.column("vec").to_pylist(), width)[0] @ directions
            cells = pa.array(np.floor(proj / cell).astype(np.int32).tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cell"])

    placed = classes.select("vec", "n", "node").mapInArrow(place, "vec array<double>, n bigint, node bigint, cell array<int>")

    def write(batches):
        held, seq = [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            units, dims = _units(table.column("vec").to_pylist(), width)
            proj = units @ directions
            low, high = _boxes(proj, units)
            sink = io.BytesIO()
            np.savez(sink, ids=table.column("node").to_numpy(), n=table.column("n").to_numpy(), dims=dims, units=units,
                     proj=proj)
            draft = Draft(root, f"block-{TaskContext.get().partitionId():06d}-{seq:06d}.npz")
            draft.write(sink.getvalue())
            draft.close()
            return pa.RecordBatch.from_pylist([{"name": draft.name, "temp": draft.temp, "low": low.tolist(),
                                               "high": high.tolist()}])

        for batch in batches:
            held = [pa.Table.from_batches([*held, batch])]
            while len(held[0]) >= size:
                yield block(held[0].slice(0, size))
                held, seq = [held[0].slice(size)], seq + 1
            held = held[0].combine_chunks().to_batches()
        if held and (rest := pa.Table.from_batches(held)).num_rows:
            yield block(rest)

    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // size)))
    in_order = placed.repartitionByRange(parts, "cell", "node").sortWithinPartitions("cell", "node")
    blocks = commit(in_order.mapInArrow(write, "name string, temp string, low array<double>, high array<double>"), root)
    boxes = blocks.select("uri", "low", "high").orderBy("name").collect()    # at most about MAX_BLOCKS rows
    uris = [b.uri for b in boxes]
    low, high = np.array([b.low for b in boxes]), np.array([b.high for b in boxes])

    def pairs(batches):
        for batch in batches:
            out = [{"i": i, "js": js[k:k + 4]} for i in batch.column("id").to_pylist()
                   for js in [_partners(i, low, high, eps)] for k in range(0, len(js), 4)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("i", pa.int64()), ("js", pa.list_(pa.int64()))]))

    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs = resolve(uris[row["i"]])[0]
                load = lambda k: _Block(fs.open_input_stream(resolve(uris[k])[1]).read())
                a, joined, out = load(row["i"]), _Joined(), []
                for j in row["js"]:
                    b = a if j == row["i"] else load(j)
                    _compare(a, b, threshold, eps, joined)
                    if b is not a:
                        out.append(b)
                for x in [a, *out]:
                    at = np.nonzero(x.links)[0]
                    yield pa.record_batch({"u": pa.array(x.ids[at]), "n": pa.array(x.links[at]),
                                           "v": pa.nulls(len(at), pa.int64())})
                if joined.links:
                    u, v = (np.array(k, dtype=np.int64) for k in zip(*joined.links))
                    yield pa.record_batch({"u": pa.array(u), "n": pa.nulls(len(u), pa.int64()), "v": pa.array(v)})

    tasks = spark.range(len(uris)).mapInArrow(pairs, "i bigint, js array<bigint>")
    n_tasks = max(1, min(16 * int(spark.conf.get("spark.sql.shuffle.partitions")), len(uris) * (len(uris) + 1) // 8 + 1))
    found = cut(tasks.repartition(n_tasks).mapInArrow(compare, "u bigint, n bigint, v bigint"), name="links")
    # a link is the same whichever block pair finds it: rows with an n are counts, the others links of the forest
    counts = found.filter("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    shared = classes.filter("low is not null").groupBy("low").agg(F.min("node").alias("u"), F.count("*").alias("c"))
    shared = classes.join(shared.filter("c > 1"), "low").select("u", F.col("node").alias("v"))
    roots = connected_components(found.filter("v is not null").select("u", "v").union(shared))
    named = (classes.join(counts, "node", "left").join(roots, "node", "left")
             .select("mark", "vec", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "node").alias("root")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))    # partial minima before the shuffle
    linked = rows.filter("vec is not null").join(named.join(lowest, "root"), ["mark", "vec"])
    alone = rows.filter("vec is null").select("id", F.lit(0).cast("bigint").alias("n_links"),
                                              F.col("id").alias("component_id"))
    return linked.select("id", "n_links", "component_id").union(alone).withColumnRenamed("id", key)
