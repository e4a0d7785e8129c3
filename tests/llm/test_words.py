import numpy as np
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from leadgrade.llm import words as W
from leadgrade.llm.components import components


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab c.é\n-7", max_size=40)), max_size=6))
def test_words_and_shingles_are_those_of_the_pattern(texts):
    hashes, offsets = W.word_hashes(pa.array(texts, pa.string()))
    found, edges = W.shingles(hashes, offsets, 3, short=True)
    names, runs = {}, {}
    for i, text in enumerate(texts):
        words = regex.findall(W.WORD_PATTERN, text or "")
        own = hashes[offsets[i] : offsets[i + 1]].tolist()
        assert len(words) == len(own)
        assert all(names.setdefault(w, h) == h for w, h in zip(words, own))
        expected = [tuple(words[j : j + 3]) for j in range(len(words) - 2)] or [tuple(words)][: len(words)]
        mine = found[edges[i] : edges[i + 1]].tolist()
        assert len(mine) == len(expected)
        assert all(runs.setdefault(w, h) == h for w, h in zip(expected, mine))
    assert len(set(names.values())) == len(names) and len(set(runs.values())) == len(runs)


def test_a_word_longer_than_a_block():
    text = "x" * (3 * W.BLOCK) + " y " + "z " * W.BLOCK
    hashes, offsets = W.word_hashes(pa.array([text, "y"]))
    assert offsets.tolist() == [0, W.BLOCK + 2, W.BLOCK + 3]
    assert hashes[1] == hashes[-1] and len(set(hashes[2:-1].tolist())) == 1


def test_counted():
    keys, n = W.counted(np.array([3, 1, 3, 2], np.uint64))
    assert keys.tolist() == [1, 2, 3] and n.tolist() == [1, 1, 2]
    assert len(W.counted(np.zeros(0, np.uint64))[0]) == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[top(a)] = top(b)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert set(got) == set(root)
    pairs = {(top(x), got[x]) for x in got}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
