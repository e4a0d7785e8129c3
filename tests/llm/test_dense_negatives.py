"""Hard negatives of vectors without structure, whose bounds spare nothing."""

import numpy as np
import pytest

from leadgrade.llm import negatives


def brute(a, own, c, other):
    """The positives and the negatives of every anchor, best first, as (score, id)."""
    out = []
    for i in range(len(a)):
        scored = [(-int(x @ a[i]), int(n), int(m)) for x, n, m in zip(c, *other) if n != own[0][i]]
        positives = sorted((s, n) for s, n, m in scored if m == own[1][i])[:5]
        others = sorted((s, n) for s, n, m in scored if m != own[1][i])
        inside = [[(-s, n) for s, n in others if 50 * -p <= 100 * -s <= 95 * -p][:3] for p, _ in positives]
        out.append(([(-s, n) for s, n in positives], inside))
    return out


@pytest.mark.parametrize("size", [40, 30_000, 1 << 25])
def test_blocks_without_structure_against_all_scores(monkeypatch, size):
    rng = np.random.default_rng(11)
    a, c = rng.integers(-size, size, (60, 24)), rng.integers(-size, size, (900, 24))
    own = np.arange(60) % 70 * 5, np.sort(rng.integers(0, 3, 60))
    other = np.arange(900) // 2, rng.integers(0, 3, 900)
    c[:10] = a[:10]
    tree = negatives.spanning_tree(a)
    calls, real = [], negatives.Bounds.scores
    monkeypatch.setattr(negatives.Bounds, "scores", lambda self, i, at: calls.append(i) or real(self, i, at))
    best = negatives.Best(60, 5)
    for part in (slice(0, 500), slice(500, 900)):
        cut = [x[part] for x in other]
        found = negatives.block_positives(negatives.Bounds(a, tree, c[part]), own, cut, 5, best.floor)
        negatives._put(best, [(i, cut[0][at], scores) for i, at, scores in found])
    inside, positives = negatives.Best(300, 3), best.scores
    for part in (slice(0, 500), slice(500, 900)):
        cut = [x[part] for x in other]
        found = negatives.block_negatives(negatives.Bounds(a, tree, c[part]), own, cut, positives, 3, inside.floor.reshape(-1, 5))
        negatives._put(inside, [(i * 5 + j, cut[0][at], scores) for i, j, at, scores in found])
    if size < 1 << 25:
        # Anchor by anchor only until the bounds are seen to spare too little.
        assert len(calls) < 2 * 60
    want = brute(a, own, c, other)
    for i, (p, n) in enumerate(want):
        assert list(zip(best.scores[i].tolist(), best.ids[i].tolist())) == p
        for j, rows in enumerate(n):
            assert list(zip(inside.scores[i * 5 + j].tolist(), inside.ids[i * 5 + j].tolist())) == rows


def test_a_task_gives_the_best_of_all_its_blocks():
    rng = np.random.default_rng(12)
    c, a = rng.integers(-99, 99, (4, 50, 8)), rng.integers(-99, 99, (9, 8))
    tree = [x.tobytes() for x in negatives.spanning_tree(a)]
    label = np.zeros(50, np.int64)
    rows = [
        {"ablock": 7, "dim": 8, "a_ids": np.arange(1000, 1009).tobytes(), "a_labels": label[:9].tobytes(),
         "a_vs": a.astype(np.int8).tobytes(), "path": tree[0], "parent": tree[1], "edge": tree[2],
         "ids": np.arange(50 * n, 50 * n + 50).tobytes(), "labels": label.tobytes(), "vs": x.astype(np.int16).tobytes()}
        for n, x in enumerate(c)
    ]
    batches = [negatives.pa.RecordBatch.from_pylist(rows[:3]), negatives.pa.RecordBatch.from_pylist(rows[3:])]
    got = [r for b in negatives._find_positives(5)(iter(batches)) for r in b.to_pylist()]
    every = a @ c.reshape(-1, 8).T
    want = [(i, s, n) for i in range(9) for s, n in sorted(((-s, n) for n, s in enumerate(every[i].tolist())))[:5]]
    assert sorted((r["anchor"], -r["score"], r["vec_id"]) for r in got) == sorted(want)
    assert {r["ablock"] for r in got} == {7}
