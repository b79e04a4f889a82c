"""Share of the true neighbours that the windows find, at several sizes of a block."""

import numpy as np
import pytest

from sluiceway.llm import ann


@pytest.mark.parametrize(("n", "kind"), [(15, "alike"), (500, "alike"), (2_000, "alike"), (16_384, "alike"), (16_384, "groups")])
def test_recall_does_not_fall_with_size(n, kind):
    rnd = np.random.default_rng(n)
    vectors = rnd.standard_normal((n, 64))
    if kind == "groups":
        vectors = 3 * rnd.standard_normal((100, 64))[rnd.integers(0, 100, n)] + vectors
    vectors *= rnd.uniform(0.5, 1.5, (n, 1))      # lengths differ: the largest product isn't the smallest angle
    norm = float(np.sqrt((vectors ** 2).sum(axis=1).max())) * (1 + 1e-9)
    block = ann.Block([np.array([i]) for i in range(n)], vectors, norm)
    asked = np.arange(n)[:: max(1, n // 60)]
    query, vec, score = block.search(asked, vectors[asked], ann.NEIGHBOURS)
    found = 0
    for i in asked:
        exact = (vectors * vectors[i]).sum(axis=1)
        np.testing.assert_allclose(score[query == i], exact[vec[query == i]])
        exact[i] = -np.inf
        best = np.argsort(-exact)[:min(ann.NEIGHBOURS, n - 1)]
        assert len(vec[query == i]) == len(best)
        found += len(set(best) & set(vec[query == i].astype(int))) / len(best)
    assert found >= 0.95 * len(asked)
