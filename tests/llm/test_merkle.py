"""Trees and multiproofs against a plain recursive version."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from constella.llm import merkle
from constella.llm.common import importable

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string, tree int, idx string, _part int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else None, bool(i & 1)))
        i >>= 1
    return out


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1]), r) for r in rows if r[2] == lang),
                     key=lambda x: x[:3])
        trees[lang] = own, tree([x[2] for x in own])
    top = tree([trees[lang][1][-1][0] for lang in langs])
    out = []
    for t, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, (_, _, digest, r) in enumerate(own):
            steps = path(levels, i) + path(top, t)
            start = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                start = leaf(r[0], r[3], r[2], r[4] + 1, r[1])
            end = start
            for other, left in steps:
                end = h(other or "", end) if left else h(end, other or "")
            out.append((r[0], digest, levels[-1][0], top[-1][0], h(*[s for s, _ in steps if s]), end, end == top[-1][0]))
    return sorted(out, key=repr)


def proved(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.prove(merkle.manifest(docs, tampered)).withColumn("folded", merkle.fold(F.coalesce("altered", "hash")))
    return sorted(map(tuple, found.select("doc_id", "hash", "subroot", "root", merkle.proof_digest(), "folded",
                                          (F.col("folded") == F.col("root"))).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_proofs_match_the_plain_tree(spark, monkeypatch, bits):
    importable(spark)
    monkeypatch.setattr(merkle, "BITS", bits)       # several rounds and many leaf partitions
    rng = random.Random(bits)
    rows = [(i * 3, f"text {i} é" * rng.randint(0, 3), rng.choice(["en"] * 5 + ["de", "fr", "ż", "Z"]), "s", i) for i in range(90)]
    rows += [(3, "same", "en", "s", 4)] * 3 + [(None, None, None, None, None), (5, "", None, "", 0), (6, "a" * 100_000, "one", None, None)]
    assert proved(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5])
def test_small_and_empty_tables(spark, n):
    importable(spark)
    rows = [(7 * i + 14, f"t{i}", "en" if i % 2 else None, "s", i) for i in range(n)]
    assert proved(spark, rows) == (brute(rows) if n else [])


def test_missing_is_the_smallest_set_that_reaches_the_root():
    rng = random.Random(2)
    for n in [1, 2, 3, 7, 8, 13, 64, 100]:
        for _ in range(20):
            chosen = sorted(rng.sample(range(n), rng.randint(1, n)))
            found = merkle.missing(np.array(chosen), n)
            assert len(found) == len(set(found))
            # a node is needed if a chosen path passes beside it and no chosen leaf lies below it
            needed, width = set(), n
            for level in range(merkle.depth(n)):
                held = {c >> level for c in chosen}
                needed |= {(level, p ^ 1) for p in held if p ^ 1 < width and p ^ 1 not in held}
                width = (width + 1) >> 1
            assert set(found) == needed


def test_a_subset_is_proved_from_fewer_nodes_than_its_single_proofs(spark, monkeypatch):
    from pyspark.sql import functions as F

    importable(spark)
    monkeypatch.setattr(merkle, "BITS", 3)
    rows = [(i, f"t{i}", "en", "s", i) for i in range(61)]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    made = merkle.manifest(docs)
    some = made.leaves.filter("doc_id % 7 < 3")
    found = merkle.prove(made, some).withColumn("ok", merkle.fold(F.col("hash")) == F.col("root"))
    got = found.collect()
    assert len(got) == sum(i % 7 < 3 for i in range(61)) and all(r.ok for r in got)
    levels = tree([leaf(i, "s", "en", i, f"t{i}") for i in range(61)])
    assert all([(s.hash, s.left) for s in r.proof] == path(levels, r.doc_id) for r in got)
    fetched = merkle.fetched(some, made.nodes).count()
    assert fetched < sum(len([s for s in r.proof if s.hash]) for r in got) / 2
    # a proof doesn't hold for another leaf
    assert not [r for r in found.withColumn("bad", merkle.fold(F.lit(h("other"))) == F.col("root")).collect() if r.bad]
