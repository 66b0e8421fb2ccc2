"""SimHash near-duplicates: fingerprints, links within a Hamming radius found in BK-trees, components.

Links.  Two fingerprints that differ in at most r bits agree on at least one of r + 1 blocks of bits, so the distinct
fingerprints are dealt to groups by (block, value of the block).  A group of more than ``most`` members is dealt again
by r + 1 blocks of the bits that its members don't share yet, until groups are small or so few bits are left that
they bound the group; no candidate is dropped.  Each group becomes a BK-tree (children keyed by their integer Hamming
distance to the parent); a member is looked up among the earlier ones along edges within the radius, then inserted.
Trees travel with their group's rows by shuffle: all of them together grow with the corpus, so they aren't broadcast.
A group returns a spanning forest of its links, at most one row a member, however dense it is.

Exact copies (equal fingerprints) are one member, so a large group of copies costs one row here.

Nulls and ties: a null or empty text has fingerprint zero and links like any other.  Rows with a null id take part
through their text, get the smallest id of their component, and never name one; a component without any id has a null
component_id.  Repeated rows are returned as often as they come.  Other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from constella.llm.common import connected_components, cut

BITS = 64
_BLOCK = 65_536


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a whole text (words split at ASCII white space, A-Z lower-cased)."""
    words = (text or "").encode().lower().split()    # bytes: both look at ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    begins = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        last = min(at + _BLOCK, n)
        hashes = np.array([digest(joined[a:b - 1], seed)
                           for a, b in zip(begins[at:last], begins[at + shingle:last + shingle])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """(key, fp): one row a document; ``fp`` holds the 64 bits as a signed long."""
    rows = df.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("_text"))

    def hashed(batches):
        for batch in batches:
            fps = np.array([simhash(t, shingle, seed) for t in batch.column("_text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return rows.mapInArrow(hashed, f"`{key}` bigint, fp bigint")


def fingerprinted(df: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42, name: str = "_fp") -> DataFrame:
    """``df`` with ``name``, the fingerprint of each row; for rows that no id tells apart."""
    def hashed(batches):
        for batch in batches:
            fps = np.array([simhash(t, shingle, seed) for t in batch.column(text).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))],
                                             names=[*batch.schema.names, name])

    return df.mapInArrow(hashed, T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


class BKTree:
    def __init__(self):
        self.fps: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, fp: int) -> int:
        self.fps.append(fp)
        self.children.append({})
        new, at = len(self.fps) - 1, 0
        while new:
            d = (self.fps[at] ^ fp).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = new
                break
            at = self.children[at][d]
        return new

    def within(self, fp: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.fps else []
        while todo:
            at = todo.pop()
            d = (self.fps[at] ^ fp).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.children[at]
            if len(kids) <= 2 * radius + 1:
                todo += [kid for e, kid in kids.items() if abs(e - d) <= radius]
            else:
                todo += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found


def forest(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the members within the radius of each other, without those that close a circle."""
    tree, top, links = BKTree(), list(range(len(fps))), []

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, fp in enumerate(fps):
        for j in tree.within(fp, radius):
            a, b = root(i), root(j)
            if a != b:
                top[a] = b
                links.append((fp, fps[j]))
        tree.add(fp)
    return links


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [bits[len(bits) * i // n:len(bits) * (i + 1) // n] for i in range(n)]


def candidate_groups(fps: DataFrame, radius: int, most: int = 256) -> DataFrame:
    """(fps array<bigint>): groups of distinct fingerprints that hold together every pair within the radius."""
    paths = {"": list(range(BITS))}    # path: bits that a group's members needn't share
    rows = fps.select("fp", F.lit("").alias("path"), F.lit(0).cast("bigint").alias("key"))
    done = None
    while True:
        deals, following = {}, {}
        for path, bits in paths.items():
            deals[path] = []
            for i, block in enumerate(_blocks(bits, radius + 1)):
                deals[path].append((f"{path}{i}.", _signed(sum(1 << b for b in block))))
                following[f"{path}{i}."] = [b for b in bits if b not in set(block)]
        options = F.create_map(*(x for path, subs in deals.items() for x in (
            F.lit(path), F.array(*(F.struct(F.lit(p).alias("path"), F.lit(m).alias("mask")) for p, m in subs)))))
        rows = rows.select("fp", "key", F.explode(options[F.col("path")]).alias("deal")).select(
            "fp", F.col("deal.path").alias("path"),
            F.xxhash64("key", F.col("fp").bitwiseAND(F.col("deal.mask"))).alias("key"))
        rows = cut(rows, name="blocks")
        sizes = rows.groupBy("path", "key").count().filter("count > 1")
        paths = following
        few = max(len(bits) for bits in paths.values()) <= 10    # so few free bits bound a group by themselves
        large = sizes.filter(F.col("count") > most)
        rest = rows.join(sizes.filter(F.lit(few) | (F.col("count") <= most)), ["path", "key"], "left_semi")
        done = rest if done is None else done.unionByName(rest)
        if few or large.isEmpty():
            break
        rows = rows.join(large, ["path", "key"], "left_semi")
    return done.groupBy("path", "key").agg(F.collect_list("fp").alias("fps")).select("fps")


def links(fps: DataFrame, radius: int = 2, most: int = 256) -> DataFrame:
    """(u, v): a spanning forest, group by group, of all links between the distinct fingerprints ``fps`` (fp)."""
    def search(batches):
        for batch in batches:
            found = [x for group in batch.column("fps").to_pylist()
                     for x in forest([fp & 0xFFFFFFFFFFFFFFFF for fp in group], radius)]
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                             names=["u", "v"])

    return candidate_groups(fps, radius, most).mapInArrow(search, "u bigint, v bigint")


def components(classes: DataFrame, radius: int = 2) -> DataFrame:
    """``classes`` (distinct ``fp`` and other columns) with ``root``, the same for all of a component."""
    roots = connected_components(links(classes.select("fp"), radius))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(
        *classes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
                    seed: int = 42) -> DataFrame:
    """(key, fp, component_id): every document with the smallest id of its component."""
    prints = cut(fingerprints(df, key, text, shingle, seed), name="simhash")
    classes = cut(prints.groupBy("fp").agg(F.min(key).alias("low")), name="classes")
    classes = components(classes, radius)
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")
