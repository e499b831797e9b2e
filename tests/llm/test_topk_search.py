import math
import random

import pytest

from tripyard.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string, rank int, score double, pivot int, rows string, query long"
EXTRA = (1, 2, "v", 3, 0.5, 4, "rows", 5)


def table(spark, rows, kind="float", partitions=3):
    schema = SCHEMA.replace("array<float>", f"array<{kind}>")
    return spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], schema).repartition(partitions)


def brute(rows, every=100, k=10):
    held = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((n, i, [math.floor(1024 * x) for x in v]))
    out = []
    for n, i, v in held:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for m, j, w in held if m != n]
        out += [(i, rank + 1, j, -score) for rank, (score, _, _, j) in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(seed, n=900, width=8, copies=300):
    """Clusters, many copies of one vector (ties), and odd rows. Multiples of
    1/1024, as 32-bit floats hold them exactly."""
    rng = random.Random(seed)
    point = lambda: [rng.randint(-1024, 1024) / 1024 for _ in range(width)]
    centres = [point() for _ in range(6)]
    rows = [(i, [x + rng.randint(-60, 60) / 1024 for x in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, centres[0]) for i in range(copies)]
    odd = [None, [], [None] * width, [0.1] * (width - 1) + [None], [float("nan")] + [0.0] * (width - 1),
           [float("inf")] * width, [-float("inf")] + [0.0] * (width - 1), [0.5] * 3, [0.0] * width, [0.25] * (width + 2)]
    rows += [(2000 + 100 * i, v) for i, v in enumerate(odd)]
    return rows + [(100, rows[100][1]), (100, rows[7][1]), (None, centres[0]), (None, centres[1]), (-200, centres[2]), (2**40 * 100, centres[3])]


@pytest.mark.parametrize(("block", "wave"), [(256, None), (16, 5), (1, 3)])
def test_ranks_are_those_of_brute_force(spark, block, wave):
    rows = vectors(2)
    assert found(topk_search.top_k(table(spark, rows), block=block, pivots=12, wave=wave)) == brute(rows)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5, -0.25]), (2, None), (3, [1.0, 1.0])]
    assert found(topk_search.top_k(table(spark, rows))) == brute(rows) == [(0, 1, 3, 786432 // 1), (0, 2, 1, 196608)]
    assert found(topk_search.top_k(table(spark, rows[:1]))) == []
    assert found(topk_search.top_k(table(spark, []))) == []
    assert found(topk_search.top_k(table(spark, [(0, None)]))) == []


def test_scores_beyond_exact_floats(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-2**40, 2**40) / 2**20 for _ in range(5)]) for i in range(150)]
    rows += [(200, [float(2**20 + 1)] * 5), (300, [float(2**20 + 1)] * 4 + [float(2**20)])]
    assert found(topk_search.top_k(table(spark, rows, "double"), block=8, pivots=4)) == brute(rows)


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="64-bit"):
        topk_search.top_k(table(spark, [(0, [1e30]), (1, [1.0])])).collect()


def test_ranges_behind_the_bounds_are_skipped(spark):
    """Clusters far apart: a query scores few documents after the first look."""
    import numpy as np
    rng = np.random.default_rng(3)
    centres = rng.integers(-800, 800, (16, 16))
    table_ = np.repeat(centres, 64, axis=0) + rng.integers(-9, 9, (1024, 16))
    wave = topk_search._Wave(np.arange(16), table_[::64], np.full(16, -(1 << 63)), 10)
    most, least = (np.stack([f(table_[i:i + 64], axis=0) for i in range(0, 1024, 64)]).astype(float) for f in (np.max, np.min))
    bounds = wave.bounds(most, least, slice(0, 16))
    exact = table_[::64] @ table_.T
    assert (bounds >= exact.reshape(16, 16, 64).max(axis=2)).all()
    kth = np.sort(exact, axis=1)[:, -10]
    assert (bounds >= kth[:, None]).sum() <= 32
