"""Merkle manifest of a dataset, and octopus multiproofs of its rows.

Rows are leaves.  The leaves of a group, in order of their id, form a binary tree; the groups' roots, in order of the
group's name, form one more tree over them.  A tree of many leaves is cut into aligned blocks of 2**BITS consecutive
leaves, the leaf partitions: a round climbs BITS levels inside each block, the next one does the same over the blocks'
tops, so a hot group costs no task more than its blocks.  All interior nodes are kept as (tree, level, idx, hash).

To prove rows, each leaf partition works out which nodes it misses: going up from its own leaves, a sibling that it
neither holds nor can derive (``missing``).  The union of these coordinates is fetched by one join.  With what came,
the partition derives the interiors its proofs share, and only then expands a proof for each row.  A node near a root
is asked for by many partitions; it's laid out once for every 2**BITS of them, so that no join key is hot.

Edge cases: null values are hashed as such; null ids come first; rows that repeat are leaves of their own; null is a
group, the first; an empty table has no trees and gives no proofs.  Columns that aren't hashed are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from constella.llm.common import cut, running
from constella.operators.keys import dense_keys

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<hash: string, left: boolean>>"
NODE = "tree bigint, level int, idx bigint, hash string, n bigint"


def leaf(fields: dict[str, Column] | Sequence[str]) -> Column:
    """Digest of the fields in order, each with its length in front, so that no two rows spell the same input."""
    columns = fields.values() if isinstance(fields, dict) else [F.col(c) for c in fields]
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    return max(n - 1, 0).bit_length()


def missing(places: np.ndarray, n: int, top: int | None = None) -> list[tuple[int, int]]:
    """Coordinates (level, idx) that the leaves at ``places`` need besides themselves to reach the root of a tree of
    ``n`` leaves: the smallest such set, since a node that several of them need or can derive is named once or not."""
    found, held = [], np.unique(places)
    for level in range(depth(n) if top is None else top):
        siblings = held ^ 1
        lacking = siblings[(siblings < n) & ~np.isin(siblings, held)]
        found += [(level, int(i)) for i in lacking]
        held, n = np.unique(held >> 1), (n + 1) >> 1
    return found


def raise_level(nodes: dict[int, str]) -> dict[int, str]:
    """The parents of ``nodes`` (idx to digest) whose children are all there; a node without a sibling stands alone."""
    return {i >> 1: digest(nodes[i & ~1], nodes[i | 1]) if i | 1 in nodes else digest(nodes[i])
            for i in nodes if not i & 1}


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows that share ``keys`` as one table, from sorted batches; such a run has at most a block's rows."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.table(batch)
        names = [table[k].to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([a[1:] != a[:-1] for a in names], axis=0)) + 1
        if held and any(held[-1][k][-1].as_py() != a[0] for k, a in zip(keys, names)):
            yield pa.concat_tables(held)
            held = []
        for start, end in zip([0, *cuts], cuts):
            yield pa.concat_tables([*held, table.slice(start, end - start)])
            held = []
        held.append(table.slice(cuts[-1] if len(cuts) else 0))
    if held:
        yield pa.concat_tables(held)


def _emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _climb(level: int):
    """Nodes of the next BITS levels, or up to the root, above a block's nodes on ``level``."""
    schema = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.string()),
                        ("n", pa.int64())])

    def rows(batches):
        for run in _runs(batches, ("tree", "block")):
            tree, n = run["tree"][0].as_py(), run["n"][0].as_py()
            nodes, wide = dict(zip(run["idx"].to_pylist(), run["hash"].to_pylist())), n
            for up in range(1, min(BITS, depth(n)) + 1):
                nodes, wide = raise_level(nodes), (wide + 1) >> 1
                yield from ((tree, level + up, i, h, wide) for i, h in nodes.items())

    return lambda batches: _emit(rows(batches), schema)


def blocked(df: DataFrame) -> DataFrame:
    """Rows (tree, idx, ...) with their ``block``, one block in one task, in order."""
    return df.withColumn("block", F.shiftright("idx", BITS)).repartition("tree", "block").sortWithinPartitions(
        "tree", "block", "idx")


def climb(leaves: DataFrame, height: int) -> DataFrame:
    """All nodes of the trees over ``leaves`` (tree, idx, hash, n), the leaves too.  ``height``: levels of the highest."""
    rounds = [leaves.select("tree", F.lit(0).alias("level"), "idx", "hash", "n")]
    for level in range(0, height, BITS):
        below = rounds[-1].filter((F.col("level") == level) & (F.col("n") > 1)).drop("level")
        rounds.append(cut(blocked(below).mapInArrow(_climb(level), NODE), name="nodes"))
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.union(more)
    return nodes


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, idx, n, hash and what the caller keeps of a row; ``nodes``: every node of every group's tree;
    ``groups``: tree, group, n, subroot, n_trees and ``upper``, the siblings from the subroot to the root (hash and
    whether it stands left) as in a proof; ``root``: the dataset's digest, None for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None


def build(rows: DataFrame, group: str, order: Sequence[str]) -> Manifest:
    """Manifest of ``rows``, which have ``hash`` and any columns to keep; ``order`` is total up to equal rows."""
    names = dense_keys(rows.select(group).distinct(), [group], "tree", -1)      # null first, then by code point
    placed = running(rows, group, [F.col(c).asc_nulls_first() for c in order], about=names)
    leaves = cut(placed.withColumnsRenamed({"_before": "idx", "_total": "n"}), name="leaves")
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        groups = leaves.select("tree", group, "n", F.col("hash").alias("subroot"),
                               F.lit(None).cast(PROOF).alias("upper"))
        return Manifest(leaves, climb(leaves, 0), groups, None)
    nodes = climb(leaves, depth(most))
    # a tree's root is alone on its level; a level of one node lies above it only where the tree has more levels
    roots = nodes.filter((F.col("n") == 1) & (F.col("idx") == 0)).select("tree", F.col("hash").alias("subroot"))
    groups = cut(leaves.filter(F.col("idx") == 0).select("tree", group, "n").join(roots, "tree"), name="groups")
    n_trees = groups.count()
    # the same one floor up: the groups' roots are the leaves of one more tree
    tops = groups.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"),
                         F.col("subroot").alias("hash"), F.lit(n_trees).cast("bigint").alias("n"))
    top = climb(tops, depth(n_trees))
    root = top.filter(F.col("n") == 1).first()["hash"]
    above = proofs(tops, top)
    groups = groups.join(above.select(F.col("idx").alias("tree"), F.col("proof").alias("upper")), "tree")
    return Manifest(leaves, nodes, cut(groups, name="groups"), root)


def _wanted():
    """What each block misses, up to its tree's root."""
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])

    def rows(batches):
        for run in _runs(batches, ("tree", "block")):
            tree, block = run["tree"][0].as_py(), run["block"][0].as_py()
            for level, i in missing(run["idx"].to_numpy(), run["n"][0].as_py()):
                yield tree, block, level, i

    return lambda batches: _emit(rows(batches), schema)


def fetched(chosen: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, block, level, idx, hash): the nodes that the leaf partitions of ``chosen`` (tree, idx, n) miss."""
    wanted = blocked(chosen.select("tree", "idx", "n")).mapInArrow(
        _wanted(), "tree bigint, block bigint, level int, idx bigint")
    # only partitions below a node's sibling ask for it: as many as a subtree of its height has blocks
    wanted = wanted.withColumn("salt", F.shiftright("block", BITS))
    first = F.expr("shiftleft(idx ^ 1L, level)")
    last = first + F.expr("shiftleft(1L, level)") - 1
    laid = nodes.filter("n > 1").select("tree", "level", "idx", "hash", F.explode(F.sequence(
        F.shiftright(first, 2 * BITS), F.shiftright(last, 2 * BITS))).alias("salt"))
    return wanted.join(laid, ["tree", "level", "idx", "salt"]).select("tree", "block", "level", "idx", "hash")


def _expand(keep: pa.Schema):
    """Proofs of a block's rows from its own leaves and what was fetched."""
    proof = pa.list_(pa.struct([("hash", pa.string()), ("left", pa.bool_())]))
    schema = pa.schema([*keep, ("proof", proof)])

    def tables(batches):
        for run in _runs(batches, ("tree", "block")):
            levels, places, own = run["level"].to_pylist(), run["idx"].to_pylist(), run["row"].to_pylist()
            held: dict[int, dict[int, str]] = {}
            for level, i, h in zip(levels, places, run["hash"].to_pylist()):
                held.setdefault(level, {})[i] = h
            n = next(v for v, r in zip(run["n"].to_pylist(), own) if r)
            for level in range(depth(n) - 1):       # interiors that the rows share
                held.setdefault(level + 1, {}).update(raise_level({
                    i: h for i, h in held[level].items() if i ^ 1 in held[level] or i == (n - 1 >> level) and not i & 1}))
            picked = run.filter(run["row"])
            found = [[{"hash": held[level].get((place >> level) ^ 1), "left": bool(place >> level & 1)}
                      for level in range(depth(n))] for place in picked["idx"].to_pylist()]
            yield pa.record_batch([*[picked[f.name].combine_chunks().cast(f.type) for f in keep],
                                   pa.array(found, proof)], schema=schema)

    return tables


def proofs(chosen: DataFrame, nodes: DataFrame) -> DataFrame:
    """``chosen`` (tree, idx, n, hash and any others) with ``proof``, a step for each level from a row's leaf to its
    tree's root: the sibling's hash, null where a node stands alone, and whether it is the left one.  Any rows of the
    trees may be chosen; ``nodes`` are all nodes of the trees."""
    rows = chosen.withColumns({"level": F.lit(0), "row": F.lit(True), "block": F.shiftright("idx", BITS)})
    both = rows.unionByName(fetched(chosen, nodes).withColumn("row", F.lit(False)), allowMissingColumns=True)
    both = both.repartition("tree", "block").sortWithinPartitions("tree", "block")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields)
    return both.mapInArrow(_expand(to_arrow_schema(chosen.schema)), f"{names}, proof {PROOF}")


def prove(manifest: Manifest, chosen: DataFrame | None = None) -> DataFrame:
    """Rows of ``manifest.leaves`` (all, or those ``chosen`` from it) with subroot, root and the whole ``proof``.  A
    group's rows meet what lies above its root by (tree, block of blocks), so that no join key is hot."""
    found = proofs(manifest.leaves if chosen is None else chosen, manifest.nodes)
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("n") - 1, 2 * BITS))).alias("salt")
    groups = manifest.groups.select("tree", "subroot", "upper", salts)
    found = found.withColumn("salt", F.shiftright("idx", 2 * BITS)).join(groups, ["tree", "salt"])
    return found.withColumns({"proof": F.concat("proof", "upper"), "root": F.lit(manifest.root).cast("string")}).drop(
        "salt", "upper")


def fold(start: Column, proof: str = "proof") -> Column:
    """The root that a leaf digest and a proof lead to."""
    def step(below: Column, s: Column) -> Column:
        other = F.coalesce(s["hash"], F.lit(""))
        return F.sha2(F.when(s["left"], F.concat(other, below)).otherwise(F.concat(below, other)), 256)

    return F.aggregate(proof, start, step)


def proof_digest(proof: str = "proof") -> Column:
    """Digest of a proof's siblings, those that there are, from the leaf up."""
    return F.sha2(F.concat_ws("", F.col(proof)["hash"]), 256)


def manifest(docs: DataFrame, altered: Column | None = None) -> Manifest:
    """Manifest of ``documents`` rows by lang and doc_id.  ``altered``, a condition on doc_id: its rows keep in
    ``altered`` the leaf they would have with one more in n_chars, to see that their proofs fail."""
    fields = {c: F.col(c) for c in FIELDS}
    other = F.when(altered, leaf(fields | {"n_chars": F.col("n_chars") + 1})) if altered is not None else F.lit(None)
    rows = docs.select("doc_id", "lang", leaf(fields).alias("hash"), other.cast("string").alias("altered"))
    return build(cut(rows, name="leaf-digests"), "lang", ["doc_id", "hash"])
