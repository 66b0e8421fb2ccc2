"""The vector join over several blocks, dense groups and odd rows, against a comparison of all pairs."""

import math
from collections import defaultdict

import numpy as np
import pytest

from constella.llm import ego_join
from constella.llm.common import importable
from constella.llm.ego_join import near_vectors

INF, NAN = float("inf"), float("nan")


def brute(rows, threshold):
    usable = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    at = [k for k, (_, v) in enumerate(rows) if usable(v)]
    near = defaultdict(set)
    for x in at:
        for y in at:
            a, b = (np.array(rows[k][1]) for k in (x, y))
            if x != y and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                near[x].add(y)
    out = []
    for k, (name, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        out.append((name, len(near[k]), min((rows[y][0] for y in seen if rows[y][0] is not None), default=None)))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    importable(spark)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, low string, node int")
    return sorted(map(tuple, near_vectors(df, **options).select("vec_id", "n_links", "component_id").collect()), key=repr)


def clusters(seed, dims=6, groups=12, members=5, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(c + spread * rng.normal(size=dims)).tolist() for c in centres for _ in range(members)]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_across_blocks_match_all_pairs(spark, seed):
    vectors = clusters(seed)
    vectors += vectors[:3] + [[2 * x for x in vectors[4]], [-x for x in vectors[5]], [1.0, 2.0], [2.0, 4.0]]
    rng = np.random.default_rng(seed)
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)) - 20, vectors)]
    want = brute(rows, 0.9)
    assert sum(n for _, n, _ in want) > 40
    assert found(spark, rows, block_rows=4, leading=3) == want
    assert found(spark, rows) == want


def test_rows_without_an_id_take_part(spark):
    vectors = clusters(3, groups=6)
    rows = [(None if k % 3 == 0 else k, v) for k, v in enumerate(vectors)]
    # copies with and without ids, a group without any id, odd vectors with and without ids
    rows += [(None, vectors[1]), (None, vectors[3]), (None, [0.0] * 5 + [9.0]), (None, [0.0] * 5 + [8.0])]
    rows += [(i, v) for i in (None, 900) for v in (None, [], [0.0] * 6, [1.0, None] + [0.0] * 4, [NAN] * 6, [INF] + [1.0] * 5)]
    assert found(spark, rows, block_rows=4, leading=2) == brute(rows, 0.9)


def test_dense_groups_take_the_other_path(spark):
    rng = np.random.default_rng(4)
    vectors = [(c + 0.02 * rng.normal(size=4)).tolist() for c in np.eye(4)[:3] for _ in range(60)]
    rows = list(enumerate(vectors))
    want = brute(rows, 0.9)
    assert sum(n for _, n, _ in want) > 4 * ego_join.SUB    # more links than a block lists one by one
    assert found(spark, rows) == want


def test_rows_that_share_an_id_are_one_node(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    got = found(spark, [(1, a), (1, b), (2, b), (3, [0.0, 0.0, 1.0])])
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (None, [0.0])]) == brute([(1, None), (None, [0.0])], 0.9)
