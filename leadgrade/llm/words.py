"""Words and word shingles of Arrow text columns as 64-bit hashes, without Python strings.

A word is a maximal run of characters other than ASCII punctuation, control
characters and white space, after ``lower``. The same words come from the regular
expression ``WORD_PATTERN`` on lower-cased text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 5
BLOCK = 1 << 16

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[:128] = [chr(i).isalnum() for i in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """Hash function number ``seed`` of a family."""
    return mix(x ^ mix(np.array([seed + 1], np.uint64) * _GOLD)[0])


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, BLOCK + 1024)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1024)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_POW):
        return _POW, _INV
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (null: empty) and the offsets of its rows."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(is_word: np.ndarray):
    """Byte ranges of about ``BLOCK`` bytes that no word crosses."""
    at, n = 0, len(is_word)
    while at < n:
        end, step = min(at + BLOCK, n), 256
        while end < n and is_word[end]:
            gap = np.flatnonzero(~is_word[end : end + step])
            end = end + int(gap[0]) if len(gap) else min(n, end + step)
            step *= 2
        yield at, end
        at = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the offsets of the rows in them.

    Texts are expected in lower case. Blocks keep the memory bounded however long
    a text is.
    """
    data, offsets = utf8(texts)
    hashes, starts = words_in(data, offsets)
    return hashes, np.searchsorted(starts, offsets)


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte of every word; no word crosses one of ``offsets``."""
    is_word = _WORD_BYTE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    hashes, starts = [], []
    for a, b in _blocks(is_word):
        w, f = is_word[a:b], first[a:b]
        before = np.empty(b - a, bool)
        before[0] = a > 0 and is_word[a - 1]
        before[1:] = w[:-1]
        start = np.flatnonzero(w & (~before | f))
        after = np.zeros(b - a, bool)
        after[:-1] = w[1:] & ~f[1:]
        end = np.flatnonzero(w & ~after) + 1
        power, inverse = _powers_to(b - a + 1)
        sums = np.empty(b - a + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_CODE[data[a:b]] * power[: b - a], out=sums[1:])
        hashes.append(mix((sums[end] - sums[start]) * inverse[start]))
        starts.append(start + a)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingles(
    words: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, short: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words within a row, and the rows' offsets.

    A row with fewer words has none, or with ``short`` and at least one word, a
    single one over all its words.
    """
    counts = np.diff(offsets)
    own = np.maximum(counts - size + 1, 0)
    n = len(words) - size + 1
    if n > 0:
        rolled = np.zeros(n, np.uint64)
        for j in range(size):
            rolled = rolled * _GOLD + words[j : j + n]
        inside = np.ones(len(words), bool)
        for j in range(1, size):
            last = offsets[1:] - j
            inside[last[last >= offsets[:-1]]] = False
        out = mix(rolled[inside[:n]])
    else:
        out = np.zeros(0, np.uint64)
    if short:
        small = np.flatnonzero((counts > 0) & (counts < size))
        at = np.concatenate([[0], np.cumsum(own)])[small]
        extra = [
            mix(np.array([_fold(words[offsets[i] : offsets[i + 1]])], np.uint64))[0]
            for i in small
        ]
        out = np.insert(out, at, np.array(extra, np.uint64)) if extra else out
        own[small] = 1
    return out, np.concatenate([[0], np.cumsum(own)])


def _fold(words: np.ndarray) -> int:
    value = len(words)
    for w in words:
        value = (value * 0x9E3779B97F4A7C15 + int(w)) & 0xFFFFFFFFFFFFFFFF
    return value


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[first], np.diff(np.concatenate([first, [len(values)]]))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Slices of a batch with at most about ``limit`` bytes of text each, so that
    arrays derived from the text stay small. A longer single row is a slice alone."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
