"""Capped water-filling against exact fractions, and what a mix takes of each document."""

import random
import re
from fractions import Fraction

import pytest

from constella.llm.common import importable

DOCS = "doc_id bigint, text string, source string, size string, _order int, take int, taken string"


def brute_targets(sizes, weights, epochs=3):
    clamped = set()
    while True:
        rest = sum(sizes.values()) - sum(epochs * sizes[s] for s in clamped)
        open_ = sum(weights[s] for s in sizes if s not in clamped)
        share = {s: Fraction(weights[s] * rest, open_) for s in sizes if s not in clamped}
        above = {s for s, v in share.items() if v > epochs * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(epochs * sizes[s])) for s in sizes}
        clamped |= above


def order(s):
    return (s is None, (s or "").encode())


def weights_of(sources):
    return {s: i % 3 + 1 for i, s in enumerate(sorted(sources, key=order))}


@pytest.mark.parametrize("seed", range(4))
def test_fill_matches_exact_fractions(spark, seed):
    from constella.llm.mixing import fill, ranked_weights

    rng = random.Random(seed)
    sizes = {f"s{i}é" if i % 5 == 0 else f"S{i}": int(10 ** rng.uniform(0, 6)) * rng.randint(0, 1 + seed) for i in range(40)}
    sizes |= {None: 7, "": 3}
    if not any(sizes.values()):
        sizes["x"] = 1
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r for r in fill(ranked_weights(rows)).collect()}
    assert {s: r.weight for s, r in got.items()} == weights_of(sizes)
    want = brute_targets(sizes, weights_of(sizes))
    for s, t in want.items():
        assert got[s].target == float(t) and abs(got[s].take - t) <= Fraction(1, 2)


def test_fill_spreads_over_several_rounds(spark):
    from constella.llm.mixing import fill

    sizes = {"a": 1, "b": 10, "c": 100, "d": 1000, "e": 50_000}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size bigint, weight bigint")
    got = {r.source: r.target for r in fill(rows).collect()}
    assert got == {s: float(t) for s, t in brute_targets(sizes, dict.fromkeys(sizes, 1)).items()}
    assert got["a"] == 3 and got["d"] == 3000


def test_mix_takes_what_the_targets_say(spark):
    from constella.llm.mixing import mix

    importable(spark)
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["hot"] * 6 + ["a", "b", "c", None, "tiny é"])) for i in range(600)]
    rows += [(7, "one two\x0bthree four\tfive", "a")] * 40 + [(None, "x y", "b"), (None, None, None), (900, None, "empty"),
                                                                  (901, "", "b"), (902, "v " * 3000, "b")]
    docs = spark.createDataFrame([(*r, "x", 0, 0, "y") for r in rows], DOCS)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = brute_targets(sizes, weights_of(sizes))
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == float(targets[r.source])
        assert r.repetitions * r.size <= r.taken <= min(3, r.repetitions + 1) * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= Fraction(1, 2)
    # at most one document of a source is taken in part, and another run takes the same
    parts = [r.source for r in got if r.size and r.taken % r.size]
    assert len(parts) == len(set(parts))
    again = mix(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_of_nothing_and_of_texts_without_words(spark):
    from constella.llm.mixing import mix

    assert mix(spark.createDataFrame([], DOCS)).collect() == []
    got = mix(spark.createDataFrame([(1, " ", None, "", 0, 0, ""), (2, None, "a", "", 0, 0, "")], DOCS)).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}
