"""Hard negatives, centroid clusters and the rule cascade against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadgrade.llm import cascade, clusters, negatives

rng = np.random.default_rng(5)


def whole(rows, scale, dim=None):
    out = []
    for r in rows:
        v = r[-1]
        if v and (dim is None or len(v) == dim) and all(x is not None and np.isfinite(x) for x in v):
            out.append((*r[:-1], [int(np.floor(np.clip(scale * x, -(1 << 25), 1 << 25))) for x in v]))
    return out


# Hard negatives


def brute_negatives(rows, wanted):
    kept = [r for r in whole(rows, 256) if r[0] is not None and r[1] is not None]
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in kept if wanted(i)}:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, k) for j, k, w in kept if j != i and len(w) == len(v)]
        positives = sorted((s, j) for s, j, k in scored if k == label)[:5]
        others = sorted((s, j) for s, j, k in scored if k != label)
        for p, pid in positives:
            inside = [(s, j) for s, j in others if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, pid, n, j, -p, -s) for n, (s, j) in enumerate(inside, 1)]
    return sorted(out)


ODD = [
    (None, 1, [1.0] * 6), (3000, None, [1.0] * 6), (3050, 1, None), (3100, 1, []), (3150, 1, [None] * 6),
    (3200, 1, [float("nan")] * 6), (3250, 2, [float("inf")] * 6), (3300, 2, [1.0, 2.0]), (3301, 2, [1.0, 2.0]),
    (3302, 0, [0.5, 1.3]), (3350, 0, [0.0] * 6), (3351, 0, [-1.0] * 6), (3400, 1, [1e30] * 6), (3401, 1, [1e30] * 6),
    (3402, 0, [6e4] * 6),
]


@pytest.mark.parametrize("sizes", [(512, 4096), (3, 40)])
def test_hard_negatives_against_all_scores(spark, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "ANCHORS", sizes[0])
    monkeypatch.setattr(negatives, "CANDIDATES", sizes[1])
    centres = rng.normal(size=(5, 6))
    rows = [(i, int(i % 3), (centres[i % 5] + 0.3 * rng.normal(size=6)).tolist()) for i in range(300)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(60)] + [(2000 + i, 2, rows[50][2]) for i in range(40)]
    rows += [rows[7], rows[8], rows[50], (100, 0, rows[3][2]), *ODD]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    table = table.withColumn("place", F.lit("clash")).withColumn("ablock", F.lit("clash"))
    got = negatives.hard_negatives(table, table.where("vec_id % 50 = 0"))
    want = brute_negatives(rows, lambda i: i % 50 == 0)
    assert len(want) > 60 and Counter(map(tuple, got.collect())) == Counter(want)
    assert negatives.hard_negatives(table.limit(0), table).collect() == []
    assert negatives.hard_negatives(table, table.limit(0)).collect() == []


def test_the_tree_spares_scores_where_vectors_have_structure():
    centres = 30 * rng.normal(size=(8, 16))
    make = lambda n: np.floor(40 * (centres[np.arange(n) % 8] + 0.2 * rng.normal(size=(n, 16)))).astype(np.int64)
    anchors, others = make(80), make(1600)
    own, other = (np.arange(80) * 10**6, np.arange(80) % 2), (np.arange(1600), np.arange(1600) // 8 % 2)
    tree = negatives.spanning_tree(anchors)
    exact = anchors @ others.T
    bounds = negatives.Bounds(anchors, tree, others)
    found = list(negatives.block_positives(bounds, own, other, 5))
    assert bounds.rescored < 0.2 * exact.size
    assert ((bounds.low <= exact) & (exact <= bounds.high)).all()
    for i, at, scores in found:
        same = np.flatnonzero(other[1] == own[1][i])
        assert scores.tolist() == sorted(exact[i, same].tolist(), reverse=True)[:5]
        assert (exact[i, at] == scores).all()


def test_spanning_tree_is_minimal():
    v = rng.integers(-50, 50, (40, 3))
    order, parent, edge = negatives.spanning_tree(v)
    place = {int(x): n for n, x in enumerate(order)}
    assert sorted(place) == list(range(40))
    assert all(place[int(parent[i])] < place[i] or i == order[0] for i in range(40))
    gap = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    joined, total = {0}, 0.0  # Kruskal's sum by growing from another root
    while len(joined) < 40:
        d, j = min((gap[i, j], j) for i in joined for j in range(40) if j not in joined)
        joined.add(j)
        total += d
    assert edge.sum() == pytest.approx(total)


def test_windows_are_whole_numbers():
    low, high = negatives.window(np.array([101, 0, -100, 7]))
    assert low.tolist() == [51, 0, -50, 4] and high.tolist() == [95, 0, -95, 6]


# Clusters


def brute_clusters(rows, k=16, rounds=3, dim=64):
    kept = whole(rows, 64, dim)
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [r[1] for r in sorted(kept, key=key)[:k]]
    for turn in range(rounds + 1):
        found = []
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(centres))
            found.append((i, c, d))
        if turn < rounds:
            for c in range(len(centres)):
                own = [v for (_, v), f in zip(kept, found, strict=True) if f[1] == c]
                if own:
                    centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sums = Counter()
    for _, c, d in found:
        sums[c] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centres]
    return Counter((i, c, d, sums[c], sum(sums.values()), sha[c]) for i, c, d in found)


def test_clusters_against_all_distances(spark):
    rows = [(i, rng.normal(size=5).round(2).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(60)] + [rows[3], rows[3], (None, [0.1] * 5), (None, [0.1] * 5)]
    odd = [(900, None), (901, []), (902, [1.0] * 4), (903, [None] * 5), (904, [float("nan")] * 5), (905, [float("-inf")] * 5)]
    odd += [(906, [1e300] * 5)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    table = table.withColumn("cluster", F.lit("clash")).withColumn("v", F.lit("clash"))
    got = clusters.cluster(table, dim=5)
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows + odd, dim=5)
    few = clusters.cluster(table.where("vec_id < 3"), dim=5)
    assert Counter(map(tuple, few.collect())) == brute_clusters(rows[:3], dim=5)
    assert clusters.cluster(table.limit(0), dim=5).collect() == []
    assert clusters.cluster(table, dim=7).collect() == []


def test_products_change_by_moved_components_only():
    v = rng.integers(-9, 9, (50, 6))
    old = rng.integers(-9, 9, (3, 6))
    new = old.copy()
    new[1, 2] += 4
    batch = pa.RecordBatch.from_pydict(
        {"vec_id": pa.array(range(50)), "v": pa.array(v.tolist(), pa.list_(pa.int32())),
         "dots": pa.array((v @ old.T).tolist(), pa.list_(pa.int64()))}
    )
    out = next(clusters._updated(old, new)([batch]))
    assert np.array(out["dots"].to_pylist()).tolist() == (v @ new.T).tolist()
    far = ((v[:, None] - new[None]) ** 2).sum(-1)
    assert out["cluster"].to_pylist() == far.argmin(1).tolist()
    assert out["distance"].to_pylist() == far.min(1).tolist()


# The cascade

SPACE = r"[^\x20\x09-\x0D]+"


def brute_measures(text):
    words = re.findall(SPACE, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if n[r] > 1 for j in range(8)}
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def brute_kept(text):
    words = re.findall(SPACE, text or "")
    n, chars, symbols, dup, repeat = brute_measures(text)
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    if n < 20 or 100 * repeat > 30 * n:
        return False
    upper = len(re.findall("[A-Z]", text))
    return not (
        10 * symbols > n
        or chars < 2 * n
        or chars > 20 * n
        or 100 * dup > 30 * len(lines)
        or 100 * sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7F]", w)) for w in words) < 80 * n
        or 100 * upper > 50 * len(re.findall("[A-Za-z]", text))
        or 100 * len(re.findall("[!?.,;:]", text)) > 25 * chars
        or 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > 20 * n
        or 100 * sum(x.endswith("...") for x in lines) > 30 * len(lines)
        or 100 * sum(bool(re.match(r"[\x20\x09-\x0D]*[-*+>] ", x)) for x in lines) > 90 * len(lines)
    )


def prose(n, seed=0):
    r = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in r.integers(0, 26, r.integers(3, 9))) for _ in range(n))


TEXTS = [
    None, "", " \n\t ", "\n\n", "one", prose(19), prose(20), prose(300), prose(300).upper(), prose(60) + "\n" + prose(60),
    "\n".join([prose(9, 1)] * 3 + [prose(9, i) for i in range(2, 9)]), "\n".join(prose(9, i % 3) for i in range(30)),
    " ".join(w + "&&&" for w in prose(50).split()), " ".join(w + "!!" for w in prose(50).split()),
    " | ".join(prose(50).split()), "\n".join("- " + prose(12, i) for i in range(9)), "\n".join(prose(12, i) + "..." for i in range(9)),
    "\n".join(" > " + prose(12, i) for i in range(9)), " ".join(w for w in prose(9).split() for _ in range(6)),
    "a " * 40, "12 34 " * 15 + prose(40), "ünï ö日本語 " + prose(40) + " x y", "日本語" * 400 + " " + prose(30),
    prose(40) + "\x1c\x85 \x0b\x0c\r" + prose(5), "x" * 2_000_000, prose(300_000), (prose(40) + "\n") * 3 + prose(400),
    "...\n" * 30, "\n" + prose(25) + "\n", prose(25) + "\n-", prose(8) + " " + prose(8) + " " + prose(40, 3),
]


def test_cascade_against_plain_rules(spark):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, *TEXTS[:10]])]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = cascade.assess(table).collect()
    assert len(got) == len(rows)
    for r in got:
        t = rows[r["doc_id"]][1]
        assert tuple(r[c] for c in cascade.BASE) == brute_measures(t), t and t[:60]
        assert r["kept"] is brute_kept(t), t and t[:60]
        n, _, _, _, repeat = brute_measures(t)
        assert r["base_failed"] is (n < 20 or 100 * repeat > 30 * n)
        assert (r["rejected_by"] is None) is r["kept"] and (r["rejected_by"] == "base") is r["base_failed"]
    kept = cascade.kept_documents(table)
    assert kept.columns == table.columns and 0 < kept.count() < len(rows)
    assert cascade.assess(table.limit(0)).collect() == []


@pytest.mark.parametrize("order", [list(range(9)), list(range(8, -1, -1))])
def test_the_order_changes_no_verdict(order):
    texts = cascade.Texts(pa.array(TEXTS[:20]))
    found = cascade.judged(texts, [cascade.RULES[i] for i in order])
    assert (found == 9).tolist() == [brute_kept(t) for t in TEXTS[:20]]


def test_rules_are_ordered_by_rejections_per_cost():
    # Rule 0 rejects most, but costs more than it brings; rule 2 adds nothing to rule 1.
    assert cascade.ordered([10.0, 1.0, 1.0], {0b001: 50, 0b011: 10, 0b110: 20, 0b010: 10}) == [1, 0, 2]
    assert cascade.ordered([1.0, 3.0, 2.0], {}) == [0, 2, 1]


def test_rejected_texts_are_not_shown_to_later_rules():
    seen = []
    rules = [
        cascade.Rule("first", lambda t: np.arange(len(t)) % 2 == 0, ""),
        cascade.Rule("second", lambda t: seen.append(len(t)) or np.zeros(len(t), bool), ""),
    ]
    texts = cascade.Texts(pa.array([prose(30, i) for i in range(7)] + ["short"]))
    assert cascade.judged(texts, rules).tolist() == [0, 2, 0, 2, 0, 2, 0, -1] and seen == [3]
