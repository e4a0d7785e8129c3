"""Document quality from a linear-chain conditional random field over lines.

Every line gets the label good or bad; the features are its own surface and that of the
lines around it, and transitions tie neighbours together. Forward-backward gives the
probability of good for each line, and the mean of these, weighted by line length, is the
score of the document. Training takes the label of a document for all of its lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrade.llm.words import pieces, seeded, utf8, words_in

#: The learner's bounds: so many labelled texts, of at most so many lines and bytes.
TRAIN_DOCS, TRAIN_LINES, TRAIN_CHARS = 6000, 400, 200_000
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 300, 0.1, 1e-3

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _OTHER, _HIGH, _FEED = range(8)
_KIND = np.full(256, _HIGH, np.uint8)
_KIND[:128] = _OTHER
for _c in range(128):
    _s = chr(_c)
    if _s.islower():
        _KIND[_c] = _LOWER
    elif _s.isupper():
        _KIND[_c] = _UPPER
    elif _s.isdigit():
        _KIND[_c] = _DIGIT
    elif _s in " \t\r\x0b\f":
        _KIND[_c] = _SPACE
    elif _s in ".,;:?'\"()-":
        _KIND[_c] = _STOP
_KIND[10] = _FEED
OWN = 16


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, its bytes, offsets of the texts in the lines).

    A text has one line more than line feeds; an empty or null text has one empty line.
    """
    data, offsets = utf8(texts)
    kind = _KIND[data]
    feeds = np.flatnonzero(kind == _FEED)
    # Line starts: of every text, and behind every feed.
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    per_text = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    rows = np.concatenate([[0], np.cumsum(per_text)])
    # A feed that ends one text leaves an empty line there, at the next text's start.
    ends = np.concatenate([starts[1:], [len(data)]])
    last = np.zeros(len(starts), bool)
    last[rows[1:] - 1] = True
    ends = np.where(last, np.repeat(offsets[1:], per_text), ends - 1)
    size = np.maximum(ends - starts, 0)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[ends] - sums[starts]).astype(float)

    high = kind == _HIGH
    lower, upper, digit = count(kind == _LOWER), count(kind == _UPPER), count(kind == _DIGIT)
    space, stop, other = count(kind == _SPACE), count(kind == _STOP), count(kind == _OTHER)
    pairs = np.concatenate([[False], (kind[1:] == _OTHER) & (kind[:-1] == _OTHER)]) if len(kind) else high
    words, at = words_in(data, offsets)
    line = np.searchsorted(starts, at, side="right") - 1
    n_words = np.bincount(line, minlength=len(starts)).astype(float)
    again = np.concatenate([[False], (words[1:] == words[:-1]) & (line[1:] == line[:-1])])[: len(words)]
    _, own_first = np.unique(seeded(words, 3) + line.astype(np.uint64), return_index=True)
    distinct = np.bincount(line[own_first], minlength=len(starts))
    n = np.maximum(size, 1)
    at_end = np.maximum(ends - 1, 0)
    closing = np.isin(data[at_end], np.frombuffer(b".!?:", np.uint8)) if len(data) else np.zeros(len(size))
    opening = kind[np.minimum(starts, max(len(kind) - 1, 0))] == _UPPER if len(kind) else np.zeros(len(size))
    word_like = np.maximum(n_words, 1)
    own = np.stack(
        [
            np.log1p(size),
            lower / n,
            upper / n,
            digit / n,
            space / n,
            stop / n,
            other / n,
            count(pairs) / n,
            np.minimum((lower + upper + count(high)) / word_like, 20),
            np.minimum(other / word_like, 4),
            np.minimum(stop / word_like, 4),
            closing * (size > 0),
            opening * (size > 0),
            size == 0,
            distinct / np.maximum(n_words, 1),
            np.bincount(line, again, minlength=len(starts)) / np.maximum(n_words, 1),
        ],
        axis=1,
    ).astype(np.float64)
    return own, size, rows


def with_neighbours(own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0 if there is none), and 1."""
    n = len(own)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = rows[:-1], rows[1:] - 1
    before[first] = 0
    after[last] = 0
    edge = np.zeros((n, 2))
    edge[first, 0] = 1
    edge[last, 1] = 1
    return np.concatenate([own, before, after, edge, np.ones((n, 1))], axis=1)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    transitions: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _padded(rows: np.ndarray) -> list[np.ndarray]:
    """For each place in a text, the lines there; texts with more lines come first."""
    size = np.diff(rows)
    order = np.argsort(-size, kind="stable")
    starts = rows[:-1][order]
    ascending = np.sort(size)
    return [starts[: len(size) - np.searchsorted(ascending, t, "right")] + t for t in range(int(size.max(initial=0)))]


def _messages(good: np.ndarray, move: np.ndarray, places: list[np.ndarray]):
    """Scaled forward and backward messages of every line, two labels each."""
    emit = np.stack([1 - good, good], axis=1)
    ahead, back = np.empty_like(emit), np.ones_like(emit)
    for t, at in enumerate(places):
        value = emit[at] if not t else (ahead[places[t - 1][: len(at)]] @ move) * emit[at]
        ahead[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(len(places) - 2, -1, -1):
        later = places[t + 1]
        value = (back[later] * emit[later]) @ move.T
        back[places[t][: len(later)]] = value / value.sum(axis=1, keepdims=True)
    return emit, ahead, back


def _good(x: np.ndarray, model: QualityModel) -> np.ndarray:
    value = np.clip(((x - model.mean) / model.scale) @ model.weights, -30, 30)
    return 1 / (1 + np.exp(-value))


def line_marginals(x: np.ndarray, rows: np.ndarray, model: QualityModel) -> np.ndarray:
    """The probability that a line is good, given all lines of its text."""
    places = _padded(rows)
    _, ahead, back = _messages(_good(x, model), np.exp(model.transitions), places)
    both = ahead * back
    return both[:, 1] / both.sum(axis=1)


def fit(x: np.ndarray, rows: np.ndarray, label: np.ndarray) -> QualityModel:
    """Maximum likelihood with a small penalty; each text counts as much as any other."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean, scale = np.where(scale > 0, mean, 0.0), np.where(scale > 0, scale, 1.0)
    z, places = (x - mean) / scale, _padded(rows)
    size = np.diff(rows)
    y = np.repeat(label, size).astype(float)
    share = np.repeat(1 / size, size) / len(size)
    theta = np.zeros(z.shape[1] + 4)
    momentum, spread = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros((2, 2))
    for value in (0, 1):
        seen[value, value] = ((1 - 1 / size)[label == value]).sum() / len(size)
    for step in range(1, STEPS + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        good = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        move = np.exp(moves)
        emit, ahead, back = _messages(good, move, places)
        both = ahead * back
        marginal = both[:, 1] / both.sum(axis=1)
        expected = np.zeros((2, 2))
        for t in range(1, len(places)):
            now, then = places[t], places[t - 1][: len(places[t])]
            joint = ahead[then][:, :, None] * move[None] * (emit[now] * back[now])[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            expected += (joint * share[now][:, None, None]).sum(axis=0)
        gradient = np.concatenate([z.T @ ((y - marginal) * share), (seen - expected).ravel()])
        gradient -= PENALTY * theta * np.concatenate([np.ones(len(weights)), np.full(4, 20.0)])
        momentum = 0.9 * momentum + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        theta += RATE * (momentum / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return QualityModel(theta[:-4], theta[-4:].reshape(2, 2), mean, scale)


def held_out(doc_id: Column) -> Column:
    """True for rows that are kept from learning; a null id is not held out."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(fold == 0, F.lit(False))


def _own_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text", 2 << 20):
            own, _, rows = line_features(batch["text"])
            flat = pa.array(own.astype(np.float32).ravel())
            lists = pa.ListArray.from_arrays(pa.array((rows * OWN).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch["key"], batch["label"], lists], ["key", "label", "own"])


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> QualityModel:
    """A model from texts with a label (doc_id, quality) that aren't held out.

    Of these the ``train_docs`` with the smallest hash of the id count, less those with
    over ``TRAIN_LINES`` lines or ``TRAIN_CHARS`` characters, so that the driver's part is
    bounded. Null texts and labels are skipped; an id with several labels counts as 1 if
    their mean is 0.5 or more. With one label only, or none, every text scores the same.
    """
    usable = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    draw = F.xxhash64("doc_id", F.lit(8))
    sample = usable.orderBy(draw, "doc_id").limit(train_docs)
    texts = docs.where("text is not null").where(F.length("text") <= TRAIN_CHARS).select("doc_id", "text")
    rows = (
        texts.join(F.broadcast(sample), "doc_id")
        .where(F.size(F.split("text", "\n")) <= TRAIN_LINES)
        .select(F.xxhash64("doc_id", "text").alias("key"), "text", "label")
        .mapInArrow(_own_features, "key long, label int, own array<float>")
    )
    found = sorted(rows.collect(), key=lambda r: r.key)
    label = np.array([r.label for r in found])
    if len(set(label.tolist())) < 2:
        width = 3 * OWN + 3
        prior = float(label.mean()) if len(label) else 0.5
        weights = np.zeros(width)
        weights[-1] = 30.0 if prior == 1 else -30.0 if prior == 0 else 0.0
        return QualityModel(weights, np.zeros((2, 2)), np.zeros(width), np.ones(width))
    own = np.concatenate([np.array(r.own, float).reshape(-1, OWN) for r in found])
    edges = np.concatenate([[0], np.cumsum([len(r.own) // OWN for r in found])])
    return fit(with_neighbours(own, edges), edges, label)


def _scored(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "_text", 1 << 20):
                own, size, rows = line_features(batch["_text"])
                marginal = line_marginals(with_neighbours(own, rows), rows, model)
                weight = size + 1e-6
                total = np.add.reduceat(weight, rows[:-1])
                score = np.add.reduceat(weight * marginal, rows[:-1]) / total
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(np.clip(score, 0.0, 1.0))],
                    [*batch.schema.names[:-1], "score"],
                )

    return run


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with score and predicted; same-named columns go.

    Only the text is looked at, whole; a null text is an empty one, and an empty one is
    one empty line. predicted is 1 if score >= ``THRESHOLD``, else 0. Repeated rows are all
    returned, an empty table stays empty.
    """
    kept = docs.drop("score", "predicted")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    found = kept.select("*", F.col("text").alias("_text")).mapInArrow(
        _scored(model), ", ".join([*fields, "score double"])
    )
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
