"""Lengths against the library, and a packing's bins against what they must hold."""

import random

import pytest
from pyspark.sql import functions as F

from constella.llm.common import importable

DOCS = "doc_id bigint, text string, length string, size int"


def test_token_lengths_are_the_librarys(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from constella.llm.packing import token_lengths

    importable(spark)
    rng = random.Random(4)
    texts = ["".join(rng.choice(" \n\t'sabcé¿漢1239.!\x85\x1cñ😀") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts += [None, "", " " * 5000, "x" * 50_000, "word " * 20_000]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)] + [(None, "a b", "x", 0), (3, texts[3], "x", 0)], DOCS)
    got = token_lengths(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [(i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in enumerate(texts)] + [(None, 3)]
    assert sorted(map(tuple, got), key=repr) == sorted([*want, want[3]], key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_every_token_lies_in_one_place_of_one_bin(spark, seed):
    from constella.llm.packing import pack

    rng = random.Random(seed)
    sizes = [16, 40, 64]
    lengths = [rng.choice([1, 5, 5, 5, 17, 40, 63, 64, 65, 200, 0, None]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id bigint, length bigint")
    rows = pack(df, sizes).collect()
    bins: dict = {}
    per_doc: dict = {}
    for r in rows:
        bins.setdefault((r.bin_id, r.bin_size), []).append((r.position, r.length))
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
    assert per_doc == {i: n for i, n in enumerate(lengths) if n}
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), items in bins.items():
        assert size in sizes
        at = 0
        for position, length in sorted(items):
            assert position >= at
            at = position + length
        assert at <= size
        # downsized to the smallest size that holds what it has
        used = sum(n for _, n in items)
        assert size == min(s for s in sizes if s >= used)


def test_near_copies_with_clashing_and_unordered_columns(spark):
    import corpus_pipeline

    importable(spark)
    text = "the quick brown fox jumps over the lazy dog near the old river bank at dawn"
    rows = [(i, t, "en", "s", 1, 7, 8) for i, t in [(3, text), (1, text), (2, "seven bright lanterns hung above a quiet market")]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _fp int, row int")
    docs = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r._fp, r.row, r.tags["a"]) for r in kept.collect()) == [(1, 7, 8, 1), (2, 7, 8, 2)]


def test_planted_bit_distances_are_linked(spark):
    """Fingerprints one and two bits apart link, three apart don't; groups over ``most`` are dealt again."""
    from constella.llm.simhash import components

    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(40)]
    fps = set(base)
    for i, b in enumerate(base):
        bits = rng.sample(range(63), 3)
        fps |= {b ^ (1 << bits[0]), b ^ (1 << bits[0]) ^ (1 << bits[1])} if i % 2 else {b ^ (1 << bits[0]) ^ (1 << bits[1]) ^ (1 << bits[2])}
    fps = sorted(fps)
    top = {f: f for f in fps}

    def root(f):
        while top[f] != f:
            f = top[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 2:
                top[root(b)] = root(a)
    got = components(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 2).collect()
    groups = lambda pairs: {frozenset(f for f, r in pairs if r == x) for x in {r for _, r in pairs}}
    assert groups([(r.fp, r.root) for r in got]) == groups([(f, root(f)) for f in fps])
    assert len(groups([(f, root(f)) for f in fps])) < len(fps)
