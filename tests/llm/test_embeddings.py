"""Near vectors in dense groups, next to all cosines."""

import numpy as np
import pytest

from sievestream.llm import embeddings


def vectors(seed=3, dense=2400, sparse=2000, dims=64, cosine=0.8):
    """A group around one centre with mutual cosine 0.8, vectors all over, and a partner at 0.92 for some of either kind."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(dims))

    def around(n):
        rest = rng.standard_normal((n, dims))
        rest = unit(rest - np.outer(rest @ centre, centre))
        return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * rest

    def partner(x, target):
        rest = rng.standard_normal(x.shape)
        rest = unit(rest - (rest * x).sum(axis=1, keepdims=True) * x)
        return target * x + np.sqrt(1 - target**2) * rest

    group, other = around(dense), unit(rng.standard_normal((sparse, dims)))
    return np.vstack([group, other, partner(group[:150], 0.92), partner(other[:150], 0.92)])


@pytest.mark.parametrize("window", [64, 16])
def test_dense_groups_keep_their_links(spark, window):
    x = vectors()
    n = len(x)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<DOUBLE>").repartition(4)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, 0.9, window=window).collect()}
    assert len(got) == n
    found = np.array([got[i]["n_links"] for i in range(n)])
    assert (found <= near.sum(axis=1)).all()
    crowd = np.arange(n) < 2400
    for part in (crowd, ~crowd):
        assert found[part].sum() >= 0.95 * near.sum(axis=1)[part].sum() > 0


def test_forests_hang_together_as_the_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 60))
        pairs = rng.integers(0, 40, (n, 2))
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            continue
        forest = embeddings._forest(pairs[:, 0], pairs[:, 1])
        up = list(range(40))

        def root(i, up=up):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in pairs.tolist():
            a, b = sorted((root(a), root(b)))
            up[b] = a
        assert {tuple(p) for p in forest.tolist()} == {(root(i), i) for i in set(pairs.ravel().tolist()) if root(i) != i}
