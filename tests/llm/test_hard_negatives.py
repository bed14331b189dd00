"""Hard negatives next to all scores."""

import math
import random

import numpy as np
import pytest

from sievestream.llm import hard_negatives as H

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, block STRING, part INT"


def plain(rows, every=100):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, *_ in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, label in good:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, other) for j, w, other in good if len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == label and x[1] != i][:5]:
            inside = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(inside, 1)]
    return sorted(out)


def got(frame):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in frame.collect())


def table(n, dims, seed, groups=3, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims)) + 0.5
    return [(i, (centres[i % groups] + spread * rng.standard_normal(dims)).tolist(), int(rng.integers(0, 4)), "x", 1) for i in range(n)]


@pytest.mark.parametrize("dims,n,seed", [(64, 900, 1), (7, 600, 2), (1, 300, 3), (19, 500, 4)])
def test_equals_all_scores(spark, dims, n, seed):
    rows = table(n, dims, seed)
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA).repartition(4), every=20)) == plain(rows, 20)


def test_blocks_and_parts(spark, monkeypatch):
    """Several blocks of anchors and parts of rows give the same."""
    for name, value in (("ANCHORS", 7), ("ROWS", 50), ("_FEW_ROWS", 40), ("_CHUNK", 3)):
        monkeypatch.setattr(H, name, value)
    rows = table(400, 16, 7)
    result = got(H.mine(spark.createDataFrame(rows, SCHEMA), every=10))
    assert result == plain(rows, 10) and result


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(8)], i % 3, "x", 1) for i in range(300)]  # many ties
    rows += [(300, None, 1, "x", 1), (400, [], 1, "x", 1), (500, [1.0] * 7 + [None], 0, "x", 1), (600, [math.nan] * 8, 0, "x", 1), (700, [math.inf] * 8, 0, "x", 1)]
    rows += [(800, [1.0] * 8, None, "x", 1), (None, [1.0] * 8, 1, "x", 1), (900, [0.0] * 8, 1, "x", 1), (1000, [1.0] * 5, 1, "x", 1), (1001, [1.0] * 5, 1, "x", 1), (1003, [0.5] * 5, 2, "x", 1)]
    rows += [rows[17]]  # a row that is there twice
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_nothing(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert H.mine(spark.createDataFrame([(1, [1.0], 1, "x", 1)], SCHEMA)).collect() == []
    assert H.mine(spark.createDataFrame([(100, [1.0], 1, "x", 1)], SCHEMA)).collect() == []


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.standard_normal((40, 64)) + np.repeat(rng.standard_normal((40, 8)), 8, axis=1)))
    exact = x @ x.T
    widths = []
    for n in (1, 4, 16, 64):
        level = H.summaries(x, n)
        low, high = H._bounds(level, level, np.full((40, 40), 1e-6))
        assert (low <= exact + 1e-3).all() and (exact <= high + 1e-3).all()
        widths.append((high - low).mean())
        for m in (1, 4, 16):
            if m < n:
                for a, b in zip(H.coarser(*level, 64, m), H.summaries(x, m)):
                    assert np.allclose(a, b)
    assert widths == sorted(widths, reverse=True) and widths[2] < 0.8 * widths[0]


def test_large_scores_are_exact(spark):
    """Beyond what doubles hold, whole numbers are multiplied instead."""
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-(2**30), 2**30) / 256 for _ in range(6)], i % 2, "x", 1) for i in range(120)]
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA), every=10)) == plain(rows, 10)


def test_components_beyond_32_bits_are_an_error(spark):
    with pytest.raises(Exception, match="2 \\*\\* 31"):
        H.mine(spark.createDataFrame([(100, [1e30], 1, "x", 1)], SCHEMA)).collect()
