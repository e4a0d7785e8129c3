"""How much of its lists the threshold algorithm reads."""

import numpy as np
import pytest

from leadgrade.llm import top_k


def dense(q, own, c, ids, k):
    scores = c @ q
    order = [x for x in np.lexsort((ids, -scores)) if ids[x] != own][:k]
    return scores[order].tolist(), ids[order].tolist()


@pytest.mark.parametrize("kind", ["clustered", "sparse", "random", "ties", "zero"])
def test_best_of_a_block_against_all_products(kind):
    rng = np.random.default_rng(4)
    n, dim = 3000, 16
    c = rng.integers(-64, 64, (n, dim))
    if kind == "clustered":
        c = rng.integers(-64, 64, (30, dim))[rng.integers(0, 30, n)] + rng.integers(-2, 3, (n, dim))
    elif kind == "sparse":
        c *= rng.random((n, dim)) < 0.1
    elif kind == "ties":
        c = np.sign(c)
    ids = rng.permutation(n) * 3
    q = c[:40] if kind != "zero" else np.zeros((3, dim), np.int64)
    best = top_k._Best(len(q), 20)
    reads = top_k._search(q, ids[: len(q)], c, ids, best)
    for i in range(len(q)):
        assert (best.scores[i].tolist(), best.ids[i].tolist()) == dense(q[i], ids[i], c, ids, 20)
    assert (reads[:, 1] <= n).all() and (reads[:, 1] <= reads[:, 0]).all()


def test_scores_beyond_double_are_exact():
    c = np.array([[(1 << 40) + x, 3] for x in range(100)], np.int64)
    best = top_k._Best(1, 3)
    top_k._search(np.array([[1 << 21, 1]]), np.array([-1]), c, np.arange(100), best)
    assert best.scores[0].tolist() == [((1 << 40) + x) * (1 << 21) + 3 for x in (99, 98, 97)]


def test_clustered_vectors_leave_most_rows_unseen(spark):
    rng = np.random.default_rng(6)
    centres = np.zeros((40, 32))
    for row in centres:
        row[rng.choice(32, 3, replace=False)] = rng.choice([-4.0, 4.0], 3)
    points = centres[np.arange(4000) % 40] + 0.05 * rng.normal(size=(4000, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    rows = top_k.top_k(table, table.where("vec_id % 100 = 0"), accesses=True).collect()
    assert len(rows) == 40 * 20 and {r["candidates"] for r in rows} == {4000}
    share = {r["query_id"]: r["random_accesses"] / r["candidates"] for r in rows}
    assert np.median(list(share.values())) < 0.4, share
    whole = np.floor(64 * points).astype(int)
    for i in share:
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == i)
        scores, ids = dense(whole[i], i, whole, np.arange(4000), 20)
        assert got == list(zip(range(1, 21), ids, scores))


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BYTES", 8 * 6 * 10)
    table = spark.createDataFrame([(i, [float(i)] * 6) for i in range(100)], "vec_id long, embedding array<double>")
    blocks = top_k._blocks(top_k.quantised(table.coalesce(1)), 1 << 16, "block").collect()
    assert sum(len(b["ids"]) for b in blocks) == 800 and max(len(b["ids"]) for b in blocks) <= 80
    rows = top_k.top_k(table, table.where("vec_id = 50"), k=2).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in rows) == [(1, 99), (2, 98)]


def test_blocks_are_no_wider_than_their_numbers(spark):
    rows = [(i, [float(i % 2), -1.0, 0.5]) for i in range(60)] + [(100 + i, [float((1 << 20) + i)] * 2) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    blocks = top_k._blocks(top_k.quantised(table.coalesce(1)), 1 << 16, "block").collect()
    assert sum(len(b["values"]) for b in blocks if b["dim"] == 3) == 60 * 3
    assert sum(len(b["values"]) for b in blocks if b["dim"] == 2) == 4 * 40 * 2
    got = top_k.top_k(table, table.where("vec_id in (7, 103)"), k=2)
    want = [(7, 1, 1, 9216), (7, 2, 3, 9216), (103, 1, 139, None), (103, 2, 138, None)]
    assert sorted((*r[:3], r[3] if r[0] == 7 else None) for r in got.collect()) == want


@pytest.mark.parametrize("scale", [1, 1 << 10, 1 << 24])
def test_many_queries_that_see_a_whole_block_read_together(monkeypatch, scale):
    rng = np.random.default_rng(8)
    c = rng.integers(-60, 60, (900, 12)) * scale
    ids, n, seen = np.arange(900) // 2, 300, []
    real = top_k._read
    monkeypatch.setattr(top_k, "_read", lambda q, *rest: seen.append(len(q)) or real(q, *rest))
    best = top_k._Best(n, 20)
    for part in (slice(0, 500), slice(500, 900)):
        top_k._search(c[:n], ids[:n], c[part], ids[part], best)
    assert len(seen) < 2 * n / top_k.TOGETHER
    for i in range(n):
        scores = c.astype(object) @ c[i]
        want = sorted((-s, x) for s, x in zip(scores, ids) if x != ids[i])[:20]
        assert list(zip(best.scores[i].tolist(), best.ids[i].tolist())) == [(-s, x) for s, x in want]
