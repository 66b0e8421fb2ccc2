"""Shards of any distribution of keys, running sums and components with hubs, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from constella.llm import common
from constella.llm.common import connected_components, ordered_shards, sums_before

KEYS = {
    "one far key": [*range(1000), 9 * 10**18],
    "two far ranges": [*range(-(2**63), -(2**63) + 500), *range(2**63 - 501, 2**63 - 1)],
    "ranges within ranges": [b + k for b in (0, 10**6, 10**12, 10**12 + 10**6) for k in range(200)],
    "a hot key and no key": [5] * 600 + [None] * 300 + list(range(200)),
    "one key": [7] * 50,
    "no key at all": [None] * 5,
    "nothing": [],
}


@pytest.mark.parametrize("name", KEYS)
def test_shards_are_even_ranges_of_any_keys(spark, monkeypatch, name):
    monkeypatch.setattr(common, "MAX_BLOCKS", 1024)
    keys, target = KEYS[name], 50
    rows = spark.createDataFrame([(k, 1) for k in keys], "k bigint, w int")
    got = [(r.k, r["_shard"]) for r in ordered_shards(rows, "k", F.col("w"), target).collect()]
    place = lambda k: (k is not None, k or 0)
    assert sorted((k for k, _ in got), key=place) == sorted(keys, key=place)
    by_key = {}
    for k, s in got:
        by_key.setdefault(k, set()).add(s)
    assert all(len(s) == 1 for s in by_key.values())    # equal keys share a shard
    ascending = [next(iter(by_key[k])) for k in sorted(by_key, key=place)]
    assert ascending == sorted(ascending)
    held, most = {}, max(map(keys.count, set(keys)), default=0)
    for _, s in got:
        held[s] = held.get(s, 0) + 1
    assert all(n < 2 * target + most for n in held.values())


def test_sums_before_cross_the_runs(spark):
    rng = random.Random(3)
    rows = [(g, at, rng.randint(0, 9)) for g in (1, 2) for at in rng.sample(range(-3000, 3000), 900)]
    df = spark.createDataFrame(rows, "g int, at bigint, w bigint").repartition(5)
    got = {(r.g, r.at): r["_before"] for r in sums_before(df, "at", "w", "g").collect()}
    assert got == {(g, at): sum(w for h, b, w in rows if h == g and b < at) for g, at, _ in rows}
    single = df.filter("g = 1").drop("g")
    assert {r.at: r["_before"] for r in sums_before(single, "at", "w").collect()} == {at: n for (g, at), n in got.items() if g == 1}


def test_components_of_hubs_and_paths(spark):
    rng = random.Random(4)
    edges = [(1000, k) for k in range(1, 900)] + [(k, k + 1) for k in range(2000, 2200)]
    edges += [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(250)] + [(5000, 5000), (1, 1000), (1000, 1)]
    rng.shuffle(edges)
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            top[high] = low
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {x: root(x) for x in list(top)}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
