"""Contributions worked out once per case, against one computation per row."""

import numpy as np
import pytest

from leadgrade.operators import attribution


def a_tree(rng, rows, leaves):
    """A random tree that asks one feature more at every level, as deep as it has leaves."""
    tree = {k: [v] for k, v in dict(feature=-1, threshold=0.0, left=-1, right=-1, value=0.0, cover=0.0).items()}
    at, node = np.arange(len(rows)), 0
    tree["cover"][0] = len(rows)
    for f in range(leaves - 1):
        below = rows[at, f] <= np.quantile(rows[at, f], 0.3)
        tree["feature"][node], tree["threshold"][node] = f, float(np.quantile(rows[at, f], 0.3))
        tree["left"][node], tree["right"][node] = len(tree["left"]), len(tree["left"]) + 1
        for part in (at[below], at[~below]):
            for k, v in dict(feature=-1, threshold=0.0, left=-1, right=-1, value=rng.normal(), cover=len(part)).items():
                tree[k].append(v)
        at, node = at[~below], len(tree["left"]) - 1
    return {k: np.array(v) for k, v in tree.items()}


def by_row(row, tree):
    out = np.zeros(len(row))
    for path in attribution.paths(tree):
        x = row[path.features]
        follows = (x > path.low) & (x <= path.high)
        t, weight = np.polynomial.legendre.leggauss((len(x) + 1) // 2)
        factor = path.z[:, None] * (1 - t) / 2 + follows[:, None] * (1 + t) / 2
        gain = (factor.prod(axis=0) * weight / 2 / factor).sum(axis=1)
        out[path.features] += path.value * (follows - path.z) * gain
    return out


@pytest.mark.parametrize("most", [0, 16])
def test_cases_give_what_rows_give(monkeypatch, most):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(4000, 9))
    trees = [a_tree(rng, rows, n) for n in (2, 5, 9)]
    monkeypatch.setattr(attribution, "MOST_BITS", most)
    found = attribution.contributions(rows[:200], trees)
    want = np.array([sum(by_row(row, t) for t in trees) for row in rows[:200]])
    assert np.allclose(found, want, rtol=0, atol=1e-12)


def test_rows_share_the_work_of_their_case(monkeypatch):
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(4000, 9))
    trees, sizes = [a_tree(rng, rows, 7)], []
    inner = np.flatnonzero

    def counted(x):
        sizes.append(len(inner(x)))
        return inner(x)

    monkeypatch.setattr(attribution.np, "flatnonzero", counted)
    attribution.contributions(rows, trees)
    assert sizes and max(sizes) <= 2**6
