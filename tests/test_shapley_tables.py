"""Shapley values looked up by pattern against the sum over leaves."""

import time

import numpy as np
import pytest

from wardlens.operators import trees


def grown(rng, depth, features, stop=0.15):
    """A tree with a few features, so that paths meet some of them again; thresholds are few, so rows meet them."""
    columns = [[] for _ in range(6)]

    def node(level, cover):
        at = len(columns[0])
        for c, v in zip(columns, (-1, np.nan, -1, -1, rng.normal(), cover)):
            c.append(v)
        if level and rng.random() > stop and cover > 1e-6:
            columns[0][at], columns[1][at] = int(rng.integers(features)), float(rng.integers(0, 5))
            part = cover * rng.uniform(0.1, 0.9)
            columns[2][at] = node(level - 1, part)
            columns[3][at] = node(level - 1, cover - part)
        return at

    node(depth, 1000.0)
    return trees.Tree(*map(np.array, columns))


@pytest.mark.parametrize("depth, features, cells", [(1, 2, 1 << 20), (3, 2, 1 << 20), (5, 9, 1 << 20), (9, 12, 1 << 20), (6, 9, 700), (0, 2, 1 << 20)])
def test_tables_equal_the_sum_over_leaves(monkeypatch, depth, features, cells):
    monkeypatch.setattr(trees, "_TABLE_CELLS", cells)
    monkeypatch.setattr(trees, "_TABLE_ROWS", 1000)
    rng = np.random.default_rng(depth + features)
    x = rng.integers(-1, 6, (2500, features)).astype(float) + rng.choice([0.0, 0.5, -0.5], (2500, features))
    paths = [trees.tree_paths(grown(rng, depth, features)) for _ in range(4)]
    want, base = np.zeros(x.shape), sum(trees.path_shapley(p, x, np.zeros(x.shape), 0.2) for p in paths)
    for p in paths:
        trees.path_shapley(p, x, want, 0.2)
    got = trees._shapley(([(p, 0.1) for p in paths], trees.grid_of(paths, features)), x, None)
    np.testing.assert_allclose(got[:, :-1], want, atol=1e-12)
    np.testing.assert_allclose(got[:, -1], base, atol=1e-12)
    again = trees._shapley(([(p, 0.1) for p in paths], trees.grid_of(paths, features)), x, got)
    np.testing.assert_allclose(again, 2 * got, atol=1e-12)


def test_many_rows_cost_less_than_leaf_by_leaf():
    rng = np.random.default_rng(1)
    paths = trees.tree_paths(grown(rng, 8, 30, 0.0))
    x = rng.integers(-1, 6, (8000, 30)).astype(float)
    clock = time.perf_counter()
    trees.path_shapley(paths, x, np.zeros(x.shape), 1.0)
    direct, clock = time.perf_counter() - clock, time.perf_counter()
    trees._shapley(([(paths, 1.0)], trees.grid_of([paths], 30)), x, None)
    assert time.perf_counter() - clock < direct / 2
