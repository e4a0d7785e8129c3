"""Quality rules in a short-circuit cascade.

A sample tells what each rule costs and which of its documents each rule rejects. Rules are
put in order by rejections per cost, each counted on what the rules before it leave; then
every document meets the rules in this order until one rejects it, and later rules never
see it. The order changes the work alone: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.llm import words as W

#: Documents of the sample that costs and rejections are taken from, about.
SAMPLE = 2000
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Bytes of text that one step works on; a longer text is a step alone.
STEP = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LOWER = np.isin(np.arange(256), np.arange(97, 123))
#: Bytes that make a word more than digits and punctuation: ASCII letters, all non-ASCII.
_LETTER = _UPPER | _LOWER | (np.arange(256) > 127)
_MARK = np.isin(np.arange(256), list(b"!?.,;:"))
_BULLET = np.isin(np.arange(256), list(b"-*+>"))


class Texts:
    """Measures of a batch of texts, taken from their bytes when first asked for."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.data, self.offsets = W.utf8(column)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, rows: np.ndarray) -> Texts:
        """Some of the texts."""
        return self if len(rows) == len(self) else Texts(self.column.take(pa.array(rows)))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[self.offsets])

    def _owner(self, at: np.ndarray) -> np.ndarray:
        """Places of words or lines to counts per text."""
        return np.diff(np.searchsorted(at, self.offsets))

    @cached_property
    def _space(self) -> np.ndarray:
        return _SPACE[self.data]

    @cached_property
    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte of every word and the byte after its last."""
        is_word = ~self._space
        first = np.zeros(len(is_word) + 1, bool)
        first[self.offsets] = True
        before = np.concatenate([[False], is_word])[: len(is_word)]
        after = np.concatenate([is_word, [False]])[1:]
        starts = np.flatnonzero(is_word & (~before | first[:-1]))
        ends = np.flatnonzero(is_word & (~after | first[1:])) + 1
        return starts, ends

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every line; an empty text is one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]))
        ends = np.sort(np.concatenate([breaks, self.offsets[1:]]))
        return starts, ends

    @cached_property
    def _worded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and end of every line that has a word."""
        starts, ends = self._lines
        first = np.searchsorted(self._edges[0], starts)
        some = first < np.searchsorted(self._edges[0], ends)
        starts, ends = starts[some], ends[some]
        text = np.searchsorted(self.offsets, starts, side="right") - 1
        return text, self._edges[0][first[some]], ends

    @cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        power, inverse = W._powers_to(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(W._CODE[self.data] * power[: len(self.data)], out=sums[1:])
        return sums, inverse

    def _hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums, inverse = self._sums
        return W.mix((sums[ends] - sums[starts]) * inverse[starts])

    @cached_property
    def n_words(self) -> np.ndarray:
        return self._owner(self._edges[0])

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self.per_text(~self._space & ((self.data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.per_text(_SYMBOL[self.data])

    @cached_property
    def n_lines(self) -> np.ndarray:
        """Lines with a word."""
        return np.bincount(self._worded[0], minlength=len(self))

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that an earlier line equals."""
        starts, ends = self._lines
        text = np.searchsorted(self._edges[0], starts) < np.searchsorted(self._edges[0], ends)
        starts, ends = starts[text], ends[text]
        text = self._worded[0]
        keys = W.mix(self._hashes(starts, ends) ^ W.mix(text.astype(np.uint64) + W._GOLD))
        _, first = np.unique(keys, return_index=True)
        return self.n_lines - np.bincount(text[first], minlength=len(self))

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words within runs of eight words that stand in the text twice or more."""
        starts, ends = self._edges
        rows = np.concatenate([[0], np.cumsum(self.n_words)])
        runs, offsets = W.shingles(self._hashes(starts, ends), rows, WINDOW)
        if not len(runs):
            return np.zeros(len(self), np.int64)
        counts = np.diff(offsets)
        text = np.repeat(np.arange(len(self)), counts)
        keys = W.mix(runs ^ W.mix(text.astype(np.uint64) + W._GOLD))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        often = np.zeros(len(keys), bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        at = (np.arange(len(keys)) - offsets[text] + rows[text])[often]
        steps = np.bincount(at, minlength=len(starts) + 1) - np.bincount(
            at + WINDOW, minlength=len(starts) + 1
        )
        covered = np.concatenate([[0], np.cumsum(np.cumsum(steps)[:-1] > 0)])
        return np.diff(covered[rows])

    def words_with(self, kind: np.ndarray) -> np.ndarray:
        """Words that hold a byte of a kind, per text."""
        starts, ends = self._edges
        sums = np.concatenate([[0], np.cumsum(kind[self.data])])
        found = np.concatenate([[0], np.cumsum(sums[ends] > sums[starts])])
        return np.diff(found[np.searchsorted(starts, self.offsets)])


class Rule(NamedTuple):
    """``rejects`` flags texts; ``sql`` says the same of n_words, word_chars, n_symbols,
    n_dup_lines and ``text``."""

    name: str
    rejects: Callable[[Texts], np.ndarray]
    sql: str


def _line_share(texts: Texts, flags: np.ndarray, percent: int) -> np.ndarray:
    found = np.bincount(texts._worded[0][flags], minlength=len(texts))
    return 100 * found > percent * texts.n_lines


def _ellipses(texts: Texts) -> np.ndarray:
    _, _, ends = texts._worded
    dots = np.concatenate([np.zeros(3, bool), texts.data == 46])
    return _line_share(texts, dots[ends] & dots[ends + 1] & dots[ends + 2], 30)


def _bullets(texts: Texts) -> np.ndarray:
    _, first, _ = texts._worded
    after = np.concatenate([texts.data, [0]])[first + 1] if len(first) else np.zeros(0, int)
    return _line_share(texts, _BULLET[texts.data[first]] & (after == 32), 90)


def _capitals(texts: Texts) -> np.ndarray:
    upper, lower = texts.per_text(_UPPER[texts.data]), texts.per_text(_LOWER[texts.data])
    return 100 * upper > 50 * (upper + lower)


def _stutters(texts: Texts) -> np.ndarray:
    starts, ends = texts._edges
    hashes = texts._hashes(starts, ends)
    rows = np.concatenate([[0], np.cumsum(texts.n_words)])
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]])[: len(hashes)]
    same[rows[:-1][texts.n_words > 0]] = False
    found = np.diff(np.concatenate([[0], np.cumsum(same)])[rows])
    return 100 * found > 20 * texts.n_words


_WORDED = r"list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _count(words: str) -> str:
    return f"length(regexp_replace(text, '[^{words}]', '', 'g'))"


# Shares in percent and lengths that web-text filters commonly use.
RULES = (
    Rule(
        "symbols",
        lambda t: 10 * t.n_symbols > t.n_words,
        "10 * n_symbols > n_words",
    ),
    Rule(
        "word_length",
        lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 20 * t.n_words),
        "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    ),
    Rule(
        "repeated_lines",
        lambda t: 100 * t.n_dup_lines > 30 * t.n_lines,
        f"100 * n_dup_lines > 30 * len({_WORDED})",
    ),
    Rule(
        "letterless_words",
        lambda t: 100 * t.words_with(_LETTER) < 80 * t.n_words,
        r"100 * len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 80 * n_words",
    ),
    Rule("capitals", _capitals, f"100 * {_count('A-Z')} > 50 * {_count('A-Za-z')}"),
    Rule(
        "marks",
        lambda t: 100 * t.per_text(_MARK[t.data]) > 25 * t.word_chars,
        f"100 * {_count('!?.,;:')} > 25 * word_chars",
    ),
    Rule(
        "stutters",
        _stutters,
        "100 * len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) > 20 * n_words",
    ),
    Rule(
        "ellipses",
        _ellipses,
        rf"100 * len(list_filter({_WORDED}, lambda x: ends_with(x, '...'))) > 30 * len({_WORDED})",
    ),
    Rule(
        "bullets",
        _bullets,
        rf"100 * len(list_filter({_WORDED}, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*+>] '))) > 90 * len({_WORDED})",
    ),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def _observed(rules: Sequence[Rule]):
    """Per partition: seconds of every rule, and how many texts each set of rules rejects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, sets = np.zeros(len(rules)), np.zeros(1 << len(rules), np.int64)
        for batch in batches:
            for piece in W.pieces(batch, "text", STEP):
                texts = Texts(piece["text"])
                rest = np.flatnonzero(~base_failed(texts.n_words, texts.n_repeat_words))
                found = np.zeros(len(rest), np.int64)
                for i, rule in enumerate(rules):
                    # A rule pays for its own measures, as it does when it comes alone.
                    own = Texts(piece["text"].take(pa.array(rest)))
                    own.__dict__.update(_edges=own._edges, n_words=own.n_words, _lines=own._lines)
                    start = time.perf_counter()
                    found |= rule.rejects(own).astype(np.int64) << i
                    seconds[i] += time.perf_counter() - start
                np.add.at(sets, found, 1)
        used = np.flatnonzero(sets)
        yield pa.RecordBatch.from_pydict(
            {
                "rule": pa.array([*range(len(rules)), *[None] * len(used)], pa.int32()),
                "seconds": pa.array([*seconds, *[None] * len(used)], pa.float64()),
                "rejects": pa.array([*[None] * len(rules), *used], pa.int64()),
                "n": pa.array([*[None] * len(rules), *sets[used]], pa.int64()),
            }
        )

    return run


def ordered(costs: Sequence[float], rejects: dict[int, int]) -> list[int]:
    """Numbers of the rules by rejections per cost among what the rules before them leave.

    ``rejects``: documents by the set of rules that reject them, rule i as bit i. Rules that
    reject none of the rest come last, cheap ones first.
    """
    left, out = list(range(len(costs))), []
    while left:
        def worth(i: int) -> tuple[float, float]:
            n = sum(k for s, k in rejects.items() if s >> i & 1)
            return n / max(costs[i], 1e-9), -costs[i]

        best = max(left, key=worth)
        left.remove(best)
        out.append(best)
        rejects = {s: k for s, k in rejects.items() if not s >> best & 1}
    return out


def learn_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[int]:
    """The order of ``rules`` that about ``sample`` documents suggest. The driver gets one
    row per rule and per set of rules that occurs."""
    share = min(1.0, sample / max(docs.count(), 1))
    rows = docs.select("text").where("text is not null").sample(share, seed=1)
    seen = (
        rows.mapInArrow(_observed(rules), "rule int, seconds double, rejects long, n long")
        .groupBy("rule", "rejects")
        .agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n"))
        .collect()
    )
    seconds = {r["rule"]: r["seconds"] for r in seen if r["rule"] is not None}
    rejects = {r["rejects"]: r["n"] for r in seen if r["rejects"] is not None}
    return ordered([seconds.get(i, 0.0) for i in range(len(rules))], rejects)


def judged(texts: Texts, rules: Sequence[Rule]) -> np.ndarray:
    """The place of the rule that rejects each text, from 0; -1 if the base measures do, and
    the number of rules if none does. A rejected text isn't shown to the later rules."""
    out = np.where(base_failed(texts.n_words, texts.n_repeat_words), -1, len(rules))
    rows = np.flatnonzero(out >= 0)
    rest = texts.of(rows)
    for i, rule in enumerate(rules):
        if not len(rows):
            break
        bad = rule.rejects(rest)
        if bad.any():
            out[rows[bad]] = i
            rows, rest = rows[~bad], rest.of(np.flatnonzero(~bad))
    return out


def assess(
    docs: DataFrame,
    order: Sequence[int] | None = None,
    rules: Sequence[Rule] = RULES,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` (with ``text``) and, for every row: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), rejected_by (string).

    Words are runs of anything but space and tab to carriage return. word_chars counts the
    code points in words, n_symbols the characters ``#*$%&|<>``, n_dup_lines the lines (cut
    at line feeds) with a word that equal an earlier line, n_repeat_words the words within
    eight-word runs that the text has twice or more, the first included. base_failed: under
    20 words, or more than 30 percent repeated; then nothing else is asked. ``rejected_by``
    names the first rule in the cascade's order that rejects a text, ``base`` for
    base_failed, null for kept ones; ``kept`` doesn't depend on the order. A null or
    empty text has no words and fails the base. Repeated rows are judged each; columns of
    these names are replaced. ``order``: that of ``learn_order`` if not given.
    """
    order = learn_order(docs, rules, sample) if order is None else order
    chosen = [rules[i] for i in order]
    names = ["base", *[r.name for r in chosen]]
    added = (*BASE, "base_failed", "kept", "rejected_by")
    own = docs.drop(*added)
    columns_kept = own.columns
    schema = ", ".join(
        [*[f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields],
         *[f"{c} long" for c in BASE], "base_failed boolean, kept boolean, rejected_by string"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text", STEP):
                texts = Texts(piece["text"])
                where = judged(texts, chosen)
                columns = [pa.array(getattr(texts, c).astype(np.int64)) for c in BASE]
                reason = pa.array([names[w + 1] if w < len(chosen) else None for w in where], pa.string())
                columns += [pa.array(where < 0), pa.array(where == len(chosen)), reason]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], names=[*columns_kept, *added])

    return own.mapInArrow(run, schema)


def kept_documents(docs: DataFrame, order: Sequence[int] | None = None) -> DataFrame:
    """The rows and columns of ``docs`` that the cascade keeps."""
    return assess(docs, order).where("kept").select(*docs.columns)
