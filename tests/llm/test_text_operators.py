"""Operators over documents: brute force, and the odd rows that every table may hold."""

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from leadgrade.llm import decontaminate, lang_id, line_dedup, mixing, near_dup, passages, quality, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def prose(rng, n, vocabulary=4000):
    return [f"w{k}" for k in rng.integers(0, vocabulary, n)]


@pytest.fixture(scope="module")
def family():
    """Texts with copies, near copies of one text with many wordings, and odd rows."""
    rng = np.random.default_rng(5)
    texts = [" ".join(prose(rng, int(n))) for n in rng.integers(20, 200, 40)]
    base = prose(rng, 150)
    for _ in range(60):
        own = list(base)
        for at in rng.integers(0, 150, int(rng.integers(1, 9))):
            own[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(own))
    texts += [texts[0]] * 5 + ["", "", "...", "one two", "One, two!", "a b c d e f g h " * 40]
    return texts


def rows_of(texts):
    rows = [(i, t, "en", "s", 1, "own") for i, t in enumerate(texts)]
    return [*rows, (9000, None, None, None, None, None), (None, "no id here at all", "en", None, 3, None), rows[3]]


def classes(texts):
    sets = near_dup._weighted(pa.array([t.lower() for t in texts]))
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or near_dup.probability_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))]


def test_near_duplicates_against_all_pairs(spark, family):
    docs = spark.createDataFrame(rows_of(family), SCHEMA)
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(family) + 3
    named = {r["doc_id"]: r["class_id"] for r in got}
    assert [named[i] for i in range(len(family))] == classes(family)
    assert named[9000] == 9000 and [r["class_size"] for r in got if r["doc_id"] == 9000] == [1]
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    wordless = [i for i, t in enumerate(family) if not t.strip(".")]
    assert sorted(i for i in ids if i is not None and i < 9000 and i not in wordless) == sorted(
        set(classes(family)) - set(wordless)
    )
    assert ids.count(None) == 1 and ids.count(9000) == 1


def test_probability_jaccard_against_its_definition():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a = {int(k): int(w) for k, w in zip(rng.integers(0, 20, 12), rng.integers(1, 5, 12))}
        b = {int(k): int(w) for k, w in zip(rng.integers(0, 20, 12), rng.integers(1, 5, 12))}
        want = sum(
            1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b))
            for d in set(a) & set(b)
        )

        def table(x):
            keys = sorted(x)
            return np.array(keys, np.uint64), np.array([x[k] for k in keys])

        assert near_dup.probability_jaccard(table(a), table(b)) == pytest.approx(want)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    a = {int(k): int(w) for k, w in zip(rng.integers(0, 400, 300), rng.integers(1, 4, 300))}
    b = {k: w for k, w in a.items() if k % 5} | {1000 + k: 1 for k in range(20)}

    def table(x):
        keys = sorted(x)
        return np.array(keys, np.uint64), np.array([x[k] for k in keys])

    m = 4000
    (ka, wa), (kb, wb) = table(a), table(b)
    both = near_dup.prob_min_hash(
        np.concatenate([ka, kb]), np.concatenate([wa, wb]), np.repeat([0, 1], [len(ka), len(kb)]), 2, m
    )
    alone = near_dup.prob_min_hash(kb, wb, np.zeros(len(kb), int), 1, m)
    assert (alone[0] == both[1]).all()
    assert (both[0] == both[1]).mean() == pytest.approx(near_dup.probability_jaccard((ka, wa), (kb, wb)), abs=0.04)
    one = near_dup.prob_min_hash(np.array([7], np.uint64), np.array([2]), np.zeros(1, int), 1, 100)
    assert (one == 7).all()


@pytest.mark.parametrize("operator", ["near", "keep", "lines", "passages", "tokens", "mix", "language", "quality", "items"])
def test_empty_tables(spark, operator):
    docs = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    run = {
        "near": lambda: near_dup.near_duplicates(docs),
        "keep": lambda: near_dup.keep_one(docs),
        "lines": lambda: line_dedup.drop_lines(docs),
        "passages": lambda: passages.repeated_passages(docs),
        "tokens": lambda: tokens.document_token_counts(docs),
        "mix": lambda: mixing.mix(docs),
        "language": lambda: lang_id.identify(docs, lang_id.learn(docs)),
        "quality": lambda: quality.score(
            docs, quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
        ),
        "items": lambda: decontaminate.contaminated(docs, items),
    }
    assert run[operator]().collect() == []


def test_items_are_found_in_long_texts(spark):
    rng = np.random.default_rng(7)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([5, 12, 30, 60, 200])] + [(50, "too short"), (51, None)]
    texts = []
    for i, text in items[:5]:
        words = text.split()
        around = prose(rng, 3000)
        texts.append(" ".join([*around[:1500], text.upper(), *around[1500:]]))
        texts.append(" ".join([*around[:40], *words[: len(words) // 2], *around[40:80]]))
    texts += ["", "nothing of that kind " * 30]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(0, 0), (2, 1), (4, 2), (6, 3), (8, 4)]
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == docs.columns and left.count() == docs.count() - 5
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()


def brute_lines(texts, least):
    """The tree over whole lists: leaves, fixed tokens, templates, texts of each."""
    import re
    from collections import Counter, defaultdict

    lines = defaultdict(set)
    for k, text in enumerate(dict.fromkeys(texts)):
        for i, line in enumerate(text.split("\n")):
            words = re.sub(r"\S*[0-9]\S*", "<*>", line).split()
            if words:
                lines[(len(words), *words[:2]), tuple(words)].add((k, i))
    fixed, size = Counter(), Counter()
    for leaf, words in lines:
        size[leaf] += 1
        for at, w in enumerate(words):
            fixed[leaf, at, w] += w != "<*>"
    template, texts_of = {}, defaultdict(set)
    for (leaf, words), where in lines.items():
        parts = tuple(w if 2 * fixed[leaf, at, w] > size[leaf] else "<*>" for at, w in enumerate(words))
        n, plain = (sum(p != "<*>" for p in x) for x in (parts, words))
        own = len({k for k, _ in where}) >= least
        own = own and (plain == len(words) or (plain >= 4 and plain >= 0.5 * len(words)))
        if own:
            parts = words
        elif n < 4 or n < 0.75 * len(words):
            continue
        template[leaf, words] = leaf, own, parts
        texts_of[leaf, own, parts] |= {k for k, _ in where}
    gone = defaultdict(set)
    for key, name in template.items():
        if len(texts_of[name]) >= least:
            for k, i in lines[key]:
                gone[k].add(i)
    return {
        text: "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[k])
        for k, text in enumerate(dict.fromkeys(texts))
    }


def test_recurring_lines_against_whole_lists(spark):
    rng = np.random.default_rng(8)
    texts = []
    for i in range(40):
        own = [" ".join(prose(rng, int(n))) for n in rng.integers(1, 12, 4)]
        own.insert(1, "All rights reserved." if i % 2 else f"Page {i} of {i + 3} in this document")
        own.insert(3, "" if i % 3 else f"Posted by name{'abcdefgh'[i % 8]}{'xyz'[i % 3]} on this site for you today")
        texts.append("\n".join(own))
    texts += [texts[5]] * 30 + ["All rights reserved.", "", "\n\n"]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    out = line_dedup.drop_lines(docs, 4)
    assert out.columns == docs.columns and out.count() == docs.count()
    want = brute_lines(texts, 4)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert all(got[i] == want[t] for i, t in enumerate(texts))
    assert got[9000] is None and "All rights" not in got[1] and "Page" not in got[0]
    report = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.line_report(docs, 4).collect()}
    assert report[9000] == (0, 0) and report[len(texts) - 3] == (1, 1)
    copies = spark.createDataFrame([(i, "the same line in copies") for i in range(50)], "doc_id long, text string")
    assert line_dedup.drop_lines(copies).where("text = ''").count() == 0


@pytest.mark.parametrize("part", [1, 1 << 14])
def test_templates_do_not_change_when_lines_are_multiplied(spark, monkeypatch, part):
    monkeypatch.setattr(line_dedup, "PART", part)
    rng = np.random.default_rng(9)
    names, months = [f"name{'abcdefghijklmnop'[i % 16]}{'xyz'[i % 3]}" for i in range(30)], ["may", "june", "july", "march"]

    def texts(copies):
        out = []
        for c in range(copies):
            for i, name in enumerate(names):
                line = f"This article was written by {name} in {months[(i + c) % 4]}"
                out.append(f"{' '.join(prose(rng, 9))}\n{line}\n{' '.join(prose(rng, 7))}\n{c} {i} {i * 3}")
        return out

    for copies in (1, 12):
        rows = texts(copies)
        docs = spark.createDataFrame(rows_of(rows), SCHEMA)
        got = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs).collect()}
        want = brute_lines(rows, 10)
        for i, t in enumerate(rows):
            assert got[i] == want[t] == "\n".join(x for n, x in enumerate(t.split("\n")) if n != 1)


def test_lines_of_odd_and_very_long_texts(spark):
    long = "\n".join(f"a very long text with line {i} of its own kind" for i in range(30_000))
    texts = ["x y " * 700_000, long, "\t\x0b one  two\tthree\r", " one two three", "\n\none two three\n", "", "7", "7 8 9"]
    rows = [(i, t, "_k", "_d") for i, t in enumerate(texts)] + [(99, None, "_k", "_d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, _dropped string")
    out = line_dedup.drop_lines(docs, 3)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    want = brute_lines(texts, 3)
    assert all(got[i]["text"] == want[t] for i, t in enumerate(texts)) and got[99]["text"] is None
    assert got[2]["text"] == "" and got[4]["text"] == "\n\n" and got[0]["_key"] == "_k" and got[0]["_dropped"] == "_d"


def test_passages_are_found_and_short_ones_left(spark):
    rng = np.random.default_rng(9)
    shared, edited, short = prose(rng, 60), prose(rng, 120), prose(rng, 30)
    other = list(edited)
    other[60] = "changed"
    mixed = lambda part: " ".join([*prose(rng, 70), *part, *prose(rng, 70)])
    texts = [mixed(shared), mixed(shared), mixed(edited), mixed(other), mixed(short), mixed(short), "copy " * 10]
    whole = " ".join(prose(rng, 80))
    texts += [whole, whole, " ".join(shared)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = {}
    for r in passages.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["class_id"]))
    assert set(got) == {0, 1, 2, 3, 7, 8, 9}
    assert got[0] == got[1] == [(70, 130, 0)] and got[9] == [(0, 60, 0)]
    assert got[2] == [(70, 190, 2)] and got[7] == got[8] == [(0, 80, 7)]
    assert got[3] == [(0, 260, 2)] * 2, "a repeated row shares all of its text"


def test_compact_windows_against_every_stretch():
    rng = np.random.default_rng(4)
    hashes = rng.permutation(np.arange(1, 61).astype(np.uint64) << np.uint64(40))
    offsets = np.array([0, 25, 28, 60])
    found = set(zip(*(x.tolist() for x in passages.compact_windows(hashes, offsets, 6)), strict=True))
    want = set()
    for row, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
        own = hashes[a:b]
        for i in range(len(own)):
            for j in range(i + 5, len(own)):
                c = i + int(own[i : j + 1].argmin())
                left = next((k + 1 for k in range(c, -1, -1) if own[k] < own[c]), 0)
                right = next((k - 1 for k in range(c, len(own)) if own[k] < own[c]), len(own) - 1)
                want.add((row, c, left, right))
    assert found == want


def test_token_files_round_trip(spark, tmp_path):
    encoding = tokens._encoding(tokens.TOKENIZER)
    texts = ["Hello  world, été\n\n", "", None, "x" * 5000, "a b " * 300, "end"] * 7
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want = {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.document_token_counts(docs).collect()}
    assert got == want
    folder = str(tmp_path / "t")
    tokens.write_token_files(docs, folder)
    for block in (1, 7, 64):
        again = tokens.count_tokens(spark, folder, block_tokens=block)
        assert sorted(r["n_tokens"] for r in again.collect()) == sorted(want.values())
    raw = tmp_path / "raw"
    raw.mkdir()
    np.array([5, 6, tokens.END, tokens.END, 9], "uint16").tofile(raw / "a.bin")
    (raw / "b.bin").touch()
    rows = tokens.count_tokens(spark, str(raw), block_tokens=2).orderBy("place").collect()
    assert [(r["start"], r["n_tokens"], r["whole"]) for r in rows] == [(0, 2, True), (3, 0, True), (4, 1, False)]
    (raw / "c.bin").write_bytes(b"abc")
    with pytest.raises(ValueError, match="inside"):
        tokens.count_tokens(spark, str(raw))
    assert isinstance(encoding, tiktoken.Encoding)


def test_scan_over_groups_of_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP", 3)
    rng = np.random.default_rng(1)
    ids = np.where(rng.random(500) < 0.05, tokens.END, 1).astype("uint16")
    ids.tofile(tmp_path / "a.bin")
    got = tokens.count_tokens(spark, str(tmp_path), block_tokens=4).orderBy("place").collect()
    ends = np.flatnonzero(ids == tokens.END)
    want = np.diff(np.concatenate([[-1], ends])) - 1
    assert [r["n_tokens"] for r in got if r["whole"]] == want.tolist()
    assert [r["place"] for r in got] == list(range(len(got)))


def test_mix_meets_its_targets(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(prose(rng, int(n))), "en", None if i % 9 == 0 else f"s{min(i % 7, 3)}", 1, "x")
        for i, n in enumerate(rng.integers(0, 300, 500))
    ]
    rows += [(9000, None, None, None, None, None), rows[4], rows[4], (None, "some words", "en", "s1", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("target", F.lit("clash"))
    out = mixing.mix(docs)
    got = out.collect()
    assert len(got) == len(rows) and set(docs.columns) | {"size", "taken"} <= set(out.columns)
    size, target, taken = {}, {}, {}
    for r in got:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["size"] == len((r["text"] or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, free, rest = {}, set(order), 1.5 * sum(size.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * size[s]}
        if not over:
            break
        want |= {s: 2.0 * size[s] for s in over}
        rest -= sum(2.0 * size[s] for s in over)
        free -= over
        if not free:
            break
    want |= share if free else {}
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 0.5
        assert all(r["source_size"] == size[s] for r in got if r["source"] == s)
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "taken").collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_language_of_odd_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lang_id.learn(docs)
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (4, "The and of the the that is."), (4, "The and of the the that is.")]
    table = spark.createDataFrame([(i, t, "mine") for i, t in odd], "doc_id long, text string, score string")
    got = lang_id.identify(table, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and all(r["rejected"] for r in got[:3])
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    found = lang_id.identify(docs, model).where(lang_id.held_out(F.col("doc_id")))
    share = found.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert share >= 0.95
    kept = lang_id.keep_identified(table, model)
    assert kept.columns == table.columns and kept.where("doc_id < 4").count() == 0
    nothing = lang_id.learn(docs.limit(0))
    assert {r["lang_pred"] for r in lang_id.identify(table, nothing).collect()} == {"und"}


def test_quality_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.learn(docs, labels)
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "\n\n", 5), (None, "x", 5)], "doc_id long, text string, score int")
    got = quality.score(odd, model).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    found = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    right = found.where(quality.held_out(F.col("doc_id"))).select(F.avg((F.col("predicted") == F.col("quality")).cast("double")))
    assert right.first()[0] >= 0.85


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(6)
    rows = np.array([0, 3, 4, 9])
    good, move = rng.random(9), rng.random((2, 2)) + 0.1
    emit, ahead, back = quality._messages(good, move, quality._padded(rows))
    both = ahead * back
    got = both[:, 1] / both.sum(axis=1)
    for a, b in zip(rows, rows[1:], strict=False):
        n, total, hit = b - a, 0.0, np.zeros(b - a)
        for code in range(1 << n):
            y = [(code >> i) & 1 for i in range(n)]
            p = np.prod([emit[a + i, v] for i, v in enumerate(y)])
            p *= np.prod([move[u, v] for u, v in zip(y, y[1:], strict=False)])
            total += p
            hit += p * np.array(y)
        assert got[a:b] == pytest.approx(hit / total)
