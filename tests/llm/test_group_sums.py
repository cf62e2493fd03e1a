"""Sums of gradient rows by feature: the numbers of reduceat, groups of all sizes."""

import numpy as np
import pytest

from runlens.llm import maxent


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [2, 1, 9, 3], [500], [*range(1, 40)], [8, 9, 7, 1, 300, 2]])
def test_group_sums_are_those_of_reduceat(sizes):
    rng = np.random.default_rng(sum(sizes))
    times = np.array(sizes)
    n = int(times.sum())
    g = (rng.standard_normal((n, maxent.CLASSES)) * 10.0 ** rng.integers(-6, 3, (n, 1))).astype(np.float32)
    order, first = rng.permutation(n), np.cumsum(times) - times
    found = maxent.group_sums(g, order, first, times)
    assert found.dtype == np.float32
    assert np.array_equal(found, np.add.reduceat(g[order], first, axis=0))


def test_training_sums_few_rows_by_columns(monkeypatch):
    """Most features occur once or a few times in a batch: reduceat does not see them."""
    seen = []

    class Add:
        def __getattr__(self, name):
            return getattr(np.add, name)

        def reduceat(self, a, at, axis=0):
            seen.append(len(at))
            return np.add.reduceat(a, at, axis=axis)

    class Numpy:
        add = Add()

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(maxent, "np", Numpy())
    shape = (maxent._KINDS, 1 << maxent.FEATURE_BITS, maxent.CLASSES)
    f = np.stack([np.arange(4000) % 1500] * 3).astype(np.uint16)
    f[0, :200] = 7
    y = np.arange(4000) % maxent.CLASSES
    state = np.zeros(shape, np.float32), np.zeros(shape[:2], np.float32), np.zeros(shape[:2], np.float32)
    maxent.train_step(*state, np.zeros(maxent.CLASSES, np.float32), f, y)
    assert sum(seen) == 1
