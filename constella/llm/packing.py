"""Best-fit packing into bins of several permitted lengths.

Items are planned by length, not one by one: lengths never exceed the largest bin (longer items are cut into pieces),
so a histogram of lengths has at most that many rows, whatever the number of documents.  The plan walks the lengths
from long to short.  An item goes into the open bin with the least room that still holds it (best fit); alike bins are
kept as one group with a count, so a step places as many items as the group has bins.  Where no bin is open that wide,
a new one is opened of the permitted size with the least cost for each token it would hold, judged by filling it from
the lengths still to come.  Last, every bin is cut down to the smallest permitted size that holds its contents.

The plan says which ranks of each length go to which bins; items are ranked within their length by Spark (hashed
into buckets first, so a length held by a third of all items is ranked by many tasks) and joined to the plan.

Nulls and ties: an item whose length is null or below one has no piece and isn't in the result.  Ranks follow (id,
piece); rows that share both are interchangeable.  Repeated rows are packed as often as they come.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from constella.llm.common import cut

BUCKETS = 64


def bin_cost(size: int, fixed: float = 64.0, attention: float = 1 / 65_536) -> float:
    """Cost of one sequence: a fixed part, its tokens, and a part that grows with its square."""
    return fixed + size + attention * size * size


@dataclass
class _Group:
    size: int
    bins: int
    room: int
    items: list[tuple[int, int]] = field(default_factory=list)    # (length, how many), longest first

    def added(self, length: int, n: int, bins: int) -> "_Group":
        items = list(self.items)
        if items and items[-1][0] == length:
            items[-1] = (length, items[-1][1] + n)
        else:
            items.append((length, n))
        return _Group(self.size, bins, self.room - n * length, items)


class _Open:
    """Groups of bins by the room they have left."""

    def __init__(self):
        self.rooms: list[int] = []
        self.groups: dict[int, list[_Group]] = {}

    def put(self, g: _Group) -> None:
        if g.room not in self.groups:
            insort(self.rooms, g.room)
            self.groups[g.room] = []
        self.groups[g.room].append(g)

    def take(self, length: int) -> _Group | None:
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        g = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room], self.rooms[at]
        return g


def _least_cost(length: int, n: int, left: list[int], counts: dict[int, int], sizes: Sequence[int],
                cost: Callable[[int], float]) -> int:
    """The permitted size with the least cost for each token, filled from ``left`` (ascending shorter lengths)."""
    best = None
    for size in sizes:
        if size < length:
            continue
        room = size - length * min(n, size // length)
        at = len(left)
        while room and (at := bisect_left(left, room + 1, 0, at)):
            at -= 1
            room -= left[at] * min(counts[left[at]], room // left[at])
        rated = (cost(size) / (size - room), size)
        best = rated if best is None or rated < best else best
    return best[1]


def plan(counts: dict[int, int], sizes: Sequence[int], cost: Callable[[int], float] = bin_cost) -> list[_Group]:
    """Groups of alike bins for ``counts`` items of each length; none is longer than the largest size."""
    sizes = sorted(sizes)
    if counts and max(counts) > sizes[-1]:
        raise ValueError("an item is longer than the largest bin")
    open_, lengths = _Open(), sorted(counts)
    while lengths:
        length = lengths.pop()
        n = counts[length]
        while n:
            g = open_.take(length)
            if g is None:
                size = _least_cost(length, n, lengths, counts, sizes, cost)
                each = min(n, size // length)
                g = _Group(size, n // each, size).added(length, each, n // each)
                n -= g.bins * each
                open_.put(g)
                continue
            bins = min(n, g.bins)
            if bins < g.bins:
                open_.put(_Group(g.size, g.bins - bins, g.room, g.items))
            open_.put(g.added(length, 1, bins))
            n -= bins
    out = [g for room in open_.rooms for g in open_.groups[room]]
    for g in out:
        used = g.size - g.room
        g.size = sizes[bisect_left(sizes, used)]
        g.room = g.size - used
    return sorted(out, key=lambda g: (-g.size, g.room, g.items))


def _slots(groups: list[_Group]) -> list[tuple]:
    """(length, first rank, end rank, first bin, items a bin, offset in the bin, size) for each part of the plan."""
    out, rank, first = [], {}, 0
    for g in groups:
        offset = 0
        for length, each in g.items:
            a = rank.get(length, 0)
            rank[length] = a + each * g.bins
            out.append((length, a, rank[length], first, each, offset, g.size))
            offset += each * length
        first += g.bins
    return out


def pack(items: DataFrame, sizes: Sequence[int], key: str = "doc_id", length: str = "length",
         cost: Callable[[int], float] = bin_cost) -> DataFrame:
    """(key, piece, start, length, bin_id, bin_size, position): every piece of every item in its bin.

    ``start`` is the piece's place in its item, ``position`` its place in the bin."""
    spark, most = items.sparkSession, max(sizes)
    pieces = items.filter(F.col(length) > 0).select(
        F.col(key).alias("key"), F.col(length).cast("bigint").alias("total")).select(
        "key", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(total - 1) div {most}")))
        .alias("piece")).select(
        "key", "piece", F.least(F.lit(most).cast("bigint"), F.expr(f"total - piece * {most}")).alias("length"),
        F.pmod(F.xxhash64("key", "piece"), F.lit(BUCKETS)).alias("bucket"))
    sums = cut(pieces.groupBy("length", "bucket").count(), name="lengths")    # at most BUCKETS rows a length
    counts = dict(sums.groupBy("length").agg(F.sum("count")).collect())    # at most ``most`` rows
    slots = _slots(plan(counts, sizes, cost))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("key", "piece")
    ranked = (pieces.withColumn("rank", F.row_number().over(within) - 1)
              .join(F.broadcast(bases), ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("base")))
    parts = spark.createDataFrame(
        slots, "length bigint, a bigint, b bigint, first bigint, each bigint, offset bigint, bin_size bigint")
    # the plan has a few rows for each length; the rank's range is the join's condition, so each piece meets one row
    placed = ranked.join(F.broadcast(parts), (ranked["length"] == parts["length"]) & (F.col("rank") >= F.col("a"))
                         & (F.col("rank") < F.col("b"))).drop(parts["length"])
    nth = F.col("rank") - F.col("a")
    return placed.select(
        F.col("key").alias(key), "piece", (F.col("piece") * most).alias("start"), "length",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("bigint").alias("bin_id"), "bin_size",
        (F.col("offset") + nth % F.col("each") * F.col("length")).cast("bigint").alias("position"))


_encodings: dict = {}


def _encoding(ranks: str, pattern: str):
    """The tiktoken encoding of a vocabulary, loaded once a worker."""
    if (ranks, pattern) not in _encodings:
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks, pattern] = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[ranks, pattern]


def token_lengths(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, length): tokens of every whole text (null: empty) by the vocabulary file ``ranks``, and one end token."""
    rows = docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("_text"))

    def count(batches):
        encode = _encoding(ranks, pattern).encode_ordinary
        for batch in batches:
            texts = batch.column("_text")
            n = [len(encode(t.as_py() or "")) + 1 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64())], names=[key, "length"])

    return rows.mapInArrow(count, f"`{key}` bigint, length bigint")
