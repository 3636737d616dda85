import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from campanile.llm import topk

ROWS = "vec_id long, embedding array<float>, label int, v string, rank long"


def brute(rows, is_query, k):
    seen = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            seen.setdefault((i, tuple(math.floor(1024 * float(np.float32(x))) for x in e)), None)
    out = set()
    for q, a in seen:
        if is_query(q):
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in seen if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def found(spark, rows, is_query, k, **options):
    table = spark.createDataFrame([(i, e, 0, "v", 1) for i, e in rows], ROWS)
    return {tuple(r) for r in topk.search(table, is_query(F.col("id")), k, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"block": 7, "pivots": 6}, {"pivots": 40}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 5)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=5) * 0.05).tolist()) for i in range(150)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0]) for i in range(150, 190)]
    rows += [(7, rows[7][1]), (900, None), (901, [1.0, None, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5), (None, [1.0] * 5), (904, [0.0] * 5), (905, []), (906, [2.0])]
    query = lambda i: i % 5 == 0
    assert found(spark, rows, query, 10, **options) == brute(rows, query, 10)


def space_of(data, ids, k, pivots):
    norm = float(np.sqrt((data.astype(float) ** 2).sum(axis=1).max()))
    space = topk.Space(topk._lifted(data[:pivots], norm), norm, ids[:50], data[:50], k)
    d = space.distances(data, False)
    space.near = [sorted(d[d.argmin(axis=1) == j, j].tolist())[: k + 1] for j in range(pivots)]
    return space


@pytest.mark.parametrize("spread", [3, 40, 600])
def test_bounds_keep_all_that_is_needed(spread):
    """Every one of a query's best rows is sent to its group; where the data is in clusters, most others are not."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(-1000, 1000, size=(12, 8))
    data = centres[rng.integers(12, size=1500)] + rng.integers(-spread, spread + 1, size=(1500, 8))
    ids, k = np.arange(1500), 10
    space = space_of(data, ids, k, 30)
    asked = data[::20]
    d = space.distances(asked, True)
    radius = space.radii(asked, ids[::20], d)
    for groups in (1, 4, 16):
        group = d[:, :groups].argmin(axis=1)
        low, high = topk.ranges(d, radius, group, groups)
        keep = topk.needed(space.distances(data, False), low, high)
        for q in range(len(asked)):
            scores = data @ asked[q]
            scores[q * 20] = np.iinfo(np.int64).min
            kth = np.sort(scores)[-k]
            assert keep[scores >= kth, group[q]].all()
        if spread == 3 and groups == 16:
            assert keep[:, np.unique(group)].mean() < 0.3


def test_groups_follow_the_data():
    """Clusters are searched in many groups, random directions in one."""
    rng = np.random.default_rng(3)
    even = rng.normal(size=(4000, 64)) * 300
    near = (rng.normal(size=(40, 64)) * 300)[rng.integers(40, size=4000)] + rng.normal(size=(4000, 64))
    many = lambda x: topk.best_groups(space_of(x.astype(np.int64), np.arange(4000), 10, 64), x[::8].astype(np.int64), np.arange(0, 4000, 8), 400_000, 40_000_000, topk.BLOCK)
    assert many(even) == 1 and many(near) >= 8


def test_hot_vector_and_blocks(spark):
    """A third of all rows are one vector; groups' blocks are many and small."""
    rng = np.random.default_rng(9)
    rows = [(i, [0.25, 0.5, -0.25] if i % 3 == 0 else (rng.normal(size=3) * 2).tolist()) for i in range(900)]
    query = lambda i: i % 20 == 0
    assert found(spark, rows, query, 7, block=16, pivots=12) == brute(rows, query, 7)


def test_few_rows(spark):
    query = lambda i: i % 2 == 0
    assert found(spark, [], query, 3) == set()
    assert found(spark, [(2, [1.0])], query, 3) == set()
    rows = [(2, [1.0]), (3, [1.0]), (4, [-1.0])]
    assert found(spark, rows, query, 3) == brute(rows, query, 3)
    large = [(1, [2e6, 1.0]), (2, [2e6, 2.0]), (3, [-2e6, 0.5])]
    assert found(spark, large, query, 1) == brute(large, query, 1)
