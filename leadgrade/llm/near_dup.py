"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A text is a set of five-word shingles, each weighted by how often it occurs. Every
shingle is a Poisson process whose rate is its weight; an arrival falls into a random
register, which keeps the shingle that arrives first. Two texts agree in a register
with the probability of their probability Jaccard

    J(x, y) = sum over shared d of 1 / sum over all e of max(x_e / x_d, y_e / y_d),

which is the plain Jaccard of the shingle sets when no shingle repeats. Bands of
registers find candidates, and each link is verified on the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.llm.components import components
from leadgrade.llm.filters import bits_for, maybe_in, parted
from leadgrade.llm.words import counted, mix, pieces, seeded, shingles, word_hashes
from leadgrade.plans.sizing import release, scope, written

BANDS, ROWS = 20, 5
SIMILARITY = 0.8
PIVOTS, ROUNDS = 4, 1
CHUNK_ROWS, CHUNK_CHARS = 256, 1 << 20


def prob_min_hash(
    keys: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int, registers: int
) -> np.ndarray:
    """Signatures (docs x registers): the key that arrives first in each register.

    An element's arrivals are drawn from its key alone. Each round advances all
    elements by some arrivals, more from round to round; an element whose time is
    past the latest register of its document is done.
    """
    time = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, np.uint64)
    keys, rate, at = keys.copy(), weights.astype(np.float64), np.zeros(len(keys))
    doc, drawn, step = doc.astype(np.int64), 0, 1
    while len(keys):
        tick = np.arange(drawn, drawn + step, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        draw = mix(keys[:, None] + mix(tick)[None, :])
        gap = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        arrive = at[:, None] + np.cumsum(gap, axis=1) / rate[:, None]
        register = (seeded(draw, 1) % np.uint64(registers)).astype(np.int64)
        slot = (doc[:, None] * registers + register).ravel()
        when, who = arrive.ravel(), np.repeat(keys, step)
        sooner = np.flatnonzero(when < time[slot])
        sooner = sooner[np.argsort(-when[sooner], kind="stable")]
        time[slot[sooner]], winner[slot[sooner]] = when[sooner], who[sooner]
        latest = time.reshape(docs, registers).max(axis=1)
        at = arrive[:, -1]
        going = at < latest[doc]
        keys, rate, at, doc = keys[going], rate[going], at[going], doc[going]
        drawn, step = drawn + step, step if drawn < 2 else step * 2
    return winner.reshape(docs, registers)


def bands(signatures: np.ndarray, n: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key per band (docs x n) of the registers in it."""
    keys = np.zeros((len(signatures), n), np.uint64)
    for j in range(rows):
        keys = mix(keys + signatures[:, j : n * rows : rows])
    return seeded(keys + np.arange(n, dtype=np.uint64)[None, :], 2)


def _weighted(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    found, offsets = shingles(*word_hashes(texts), short=True)
    return [counted(found[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text", 1 << 20):
            sets = _weighted(batch["text"])
            full = [i for i, s in enumerate(sets) if len(s[0])]
            if not full:
                continue
            sizes = [len(sets[i][0]) for i in full]
            signature = prob_min_hash(
                np.concatenate([sets[i][0] for i in full]),
                np.concatenate([sets[i][1] for i in full]),
                np.repeat(np.arange(len(full)), sizes),
                len(full),
                BANDS * ROWS,
            )
            keys = bands(signature).view(np.int64).ravel()
            nodes = batch["node"].take(pa.array(np.repeat(full, BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), nodes], ["bucket", "node"])


def probability_jaccard(a, b) -> float:
    """Exact probability Jaccard of two (sorted keys, counts)."""
    (ka, wa), (kb, wb) = a, b
    if not len(ka) or not len(kb):
        return 0.0
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    shared = kb[at] == ka
    both = int(shared.sum())
    if not both:
        return 0.0
    if wa.max() == wa.min() == wb.max() == wb.min():
        return both / (len(ka) + len(kb) - both)
    x, y = wa[shared].astype(float), wb[at[shared]].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    first = np.searchsorted(ratio, ratio, side="left")
    above = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])[first] + only_a
    below = np.concatenate([[0.0], np.cumsum(y)])[first] + only_b
    return float((1.0 / (above / x + below / y)).sum())


def _verified(threshold: float):
    """Rows (a, b, text_a, text_b) to links (a, b, similarity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text_a", 2 << 20):
                left, right = _weighted(batch["text_a"]), _weighted(batch["text_b"])
                likeness = np.array(
                    [probability_jaccard(a, b) for a, b in zip(left, right, strict=True)]
                )
                keep = pa.array(np.flatnonzero(likeness >= threshold))
                yield pa.RecordBatch.from_arrays(
                    [batch["a"].take(keep), batch["b"].take(keep), pa.array(likeness).take(keep)],
                    ["a", "b", "similarity"],
                )

    return run


def _chunk_links(threshold: float):
    """Rows (bucket, strays, others, both), the lists of (node, component, text, buckets), to
    links; ``both`` says that the others are strays too.

    Every stray meets every text of another component, until their components meet.
    Texts that share several buckets meet in the first of them only. The shared
    weight bounds the similarity from above, so few pairs are worked out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                strays, others = (
                    pa.RecordBatch.from_struct_array(batch[c][i].values)
                    for c in ("strays", "others")
                )
                bucket, both = batch["bucket"][i].as_py(), batch["both"][i].as_py()
                found = list(_across(strays, others, bucket, both, threshold))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in found], pa.binary()),
                        pa.array([x[1] for x in found], pa.binary()),
                        pa.array([x[2] for x in found], pa.float64()),
                    ],
                    ["a", "b", "similarity"],
                )

    return run


def _across(strays: pa.RecordBatch, others: pa.RecordBatch, bucket: int, both: bool, threshold: float):
    left, right = _weighted(strays["text"]), _weighted(others["text"])
    mass = np.array([w.sum() for _, w in right], float)
    keys = np.concatenate([k for k, _ in right])
    share = np.concatenate([w / w.sum() for _, w in right])
    owner = np.repeat(np.arange(len(right)), [len(k) for k, _ in right])
    order = np.argsort(keys, kind="stable")
    keys, share, owner = keys[order], share[order], owner[order]
    root: dict[bytes, bytes] = {}

    def top(c: bytes) -> bytes:
        while root.get(c, c) != c:
            c = root[c]
        return c

    names = [others["component"].to_pylist(), others["node"].to_pylist()]
    own_buckets = [set(x) for x in strays["buckets"].to_pylist()]
    other_buckets = [set(x) for x in others["buckets"].to_pylist()]
    for i, (own, weight) in enumerate(left):
        a, b = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        n = b - a
        hit = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        bound = np.bincount(
            owner[hit],
            np.minimum(share[hit], np.repeat(weight / weight.sum(), n)),
            len(mass),
        )
        node, mine = strays["node"][i].as_py(), strays["component"][i].as_py()
        likely = np.flatnonzero(bound >= threshold - 1e-9)
        for j in likely[np.argsort(-bound[likely], kind="stable")]:
            if top(mine) == top(names[0][j]) or node == names[1][j]:
                continue
            if both and node > names[1][j] or min(own_buckets[i] & other_buckets[j]) != bucket:
                continue
            likeness = probability_jaccard(left[i], right[j])
            if likeness >= threshold:
                root[top(mine)] = top(names[0][j])
                yield node, names[1][j], likeness


LINK = "a binary, b binary, similarity double"


def text_classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(node, component): the md5 of every text that has a near duplicate with
    another wording, and the component of its verified links.

    Each text is first tested against the smallest node of its buckets (up to
    ``PIVOTS`` different ones). Texts that share a bucket and are still apart then
    meet in chunks of bounded size, so no link within a bucket is lost and no group is
    gathered in one task. What the steps store is deleted at the end.
    """
    with scope() as kept:
        return kept.keep(written(_text_classes(docs, threshold), "classes"))


def _text_classes(docs: DataFrame, threshold: float) -> DataFrame:
    texts = docs.select(F.md5("text").alias("hex"), F.lower("text").alias("text")).where(
        "text is not null"
    )
    texts = texts.select(F.unhex("hex").alias("node"), "text")
    rows = written(texts.mapInArrow(_band_rows, "bucket long, node binary"), "bands")
    shared = written(
        rows.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .where("pivot <> last").select("bucket", "pivot"),
        "buckets",
    )
    members = maybe_in(rows, F.col("bucket"), shared.select("bucket"), bits_for(shared.count()))
    members = written(members.join(shared, "bucket").distinct(), "members")
    release(rows, shared)
    stars = (
        members.where("node <> pivot")
        .groupBy("node")
        .agg(F.slice(F.sort_array(F.collect_set("pivot")), 1, PIVOTS).alias("pivots"))
        .select(F.col("node").alias("a"), F.explode("pivots").alias("b"))
    )
    stars = written(stars, "stars")
    wanted = written(members.select("node").distinct(), "wanted")
    # An inner join: a semi join would be pushed below the filter, and shuffle all texts.
    likely = maybe_in(texts, F.col("node"), wanted, bits_for(wanted.count()))
    texts = written(likely.join(wanted, "node").dropDuplicates(["node"]), "texts")
    links = written(_verify(stars, texts, threshold), "links")
    parts = components(links)
    apart = _apart(members, parts, stars)
    for turn in range(ROUNDS):
        more = written(_verify(_again(apart, turn), texts, threshold), "links")
        links = links.union(more)
        parts = components(links)
        apart = _apart(apart.select("bucket", "node"), parts)
    more = written(_rest(apart, texts, threshold), "links")
    return parts if more.isEmpty() else components(links.union(more))


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_verified(threshold), LINK)


def _apart(members: DataFrame, parts: DataFrame, tested: DataFrame | None = None) -> DataFrame:
    """(bucket, node, component, main): buckets with texts of several components, and
    the component that holds most of each. Before that, a pivot leaves the bucket
    if all others were tested against it (``tested``: a, b)."""
    named = members.join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    if tested is not None:
        done = tested.select(F.col("a").alias("node"), F.col("b").alias("pivot"))
        named = named.join(done.withColumn("tested", F.lit(1)), ["node", "pivot"], "left")
        sizes = named.groupBy("bucket").agg(
            F.count("*").alias("n"), F.count("tested").alias("n_tested")
        )
        named = named.join(sizes, "bucket").where("node <> pivot or n_tested < n - 1")
    per = named.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    main = (
        per.groupBy("bucket")
        .agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("c"))
        .where("c > 1")
        .select("bucket", "main")
    )
    return written(named.select("bucket", "node", "component").join(main, "bucket"), "apart")


def _again(apart: DataFrame, turn: int) -> DataFrame:
    """New pairs (a, b): texts outside their bucket's main component, with texts in it."""
    draw = F.xxhash64("node", F.lit(turn))
    pivot = (
        apart.where("component = main")
        .groupBy("bucket")
        .agg(F.min(F.struct(draw, "node")).alias("pivot"))
    )
    return (
        apart.where("component <> main")
        .join(pivot, "bucket")
        .groupBy("node")
        .agg(F.slice(F.sort_array(F.collect_set("pivot")), 1, PIVOTS).alias("pivots"))
        .select(F.col("node").alias("a"), F.explode("pivots.node").alias("b"))
    )


def _rest(apart: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between texts that share a bucket and are in different components: the
    texts outside the main component meet all others in chunks of bounded size.
    Buckets that hold the same texts are worked on once."""
    key = F.xxhash64("node")
    group = (
        apart.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum(key.cast("decimal(38,0)")).alias("s"),
            F.min("node").alias("lo"),
            F.max("node").alias("hi"),
        )
        .groupBy("n", "s", "lo", "hi")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    body = written(
        apart.join(group, "bucket")
        .join(texts, "node")
        .withColumn("stray", F.expr("component <> main")),
        "open",
    )
    own = body.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    sized = body.groupBy("bucket", "stray").agg(
        F.greatest(
            F.ceil(F.count("*") / CHUNK_ROWS), F.ceil(F.sum(F.length("text")) / CHUNK_CHARS)
        ).alias("chunks")
    )
    cut = body.join(own, "node").join(sized, ["bucket", "stray"]).withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks"))
    )
    packed = written(
        cut.groupBy("bucket", "stray", "chunk").agg(
            F.collect_list(F.struct("node", "component", "text", "buckets")).alias("list")
        ),
        "chunks",
    )
    left = packed.where("stray").select("bucket", F.col("list").alias("strays"))
    right = packed.select("bucket", F.col("list").alias("others"), F.col("stray").alias("both"))
    return left.join(right, "bucket").mapInArrow(_chunk_links(threshold), LINK)


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, class_size) for every row of ``docs`` (doc_id, text).

    The class of a row is the smallest doc_id over all rows whose texts are equal to
    its own or linked to it by a chain of near duplicates (probability Jaccard of
    lower-cased five-word shingles >= ``threshold``). A text of one to four words
    is a single shingle. Texts without any word equal only themselves; a null text
    equals nothing: its class is its own doc_id, its size 1. Null doc_ids count for
    the size and never name a class unless no other id is there. Repeated rows are all
    returned. An empty table gives an empty table. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    parts = text_classes(docs, threshold)
    rows = docs.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("node"))
    texts = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    named = written(
        texts.join(parts, "node", "left").withColumn("class", F.coalesce("component", "node")),
        "named",
    )
    classes = named.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size")
    )
    label = named.select("node", "class").join(classes, "class").drop("class")
    found = rows.join(written(label, "labels"), "node").select("doc_id", "class_id", "class_size")
    alone = docs.where("text is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")
    )
    return found.union(alone)


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each class: the one with the
    smallest doc_id, then the smallest text. Texts without any word equal only
    themselves. Rows with a null text are kept as they are, since they equal nothing.
    Of equal rows (same doc_id and text) one stays.
    """
    parts = text_classes(docs.select("doc_id", "text"), threshold)
    # Only the rows that go, or that are there more than once, are looked up.
    ids = docs.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("node"))
    ids = ids.groupBy("doc_id", "node").agg(F.count("*").alias("n"))
    named = written(
        ids.join(parts, "node", "left").withColumn("class", F.coalesce("component", "node")), "named"
    )
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    best = named.groupBy("class").agg(F.min(first).alias("best"))
    odd = written(
        named.join(best, "class")
        .withColumn("gone", first != F.col("best"))
        .where("gone or n > 1")
        .select(F.xxhash64("doc_id", "node").alias("_key"), F.col("doc_id").alias("_odd_id"), F.col("node").alias("_odd_node"), F.col("gone").alias("_gone")),
        "odd",
    )
    rows = docs.where("text is not null").withColumn("_node", F.unhex(F.md5("text")))
    some, rest = parted(rows, F.xxhash64("doc_id", "_node"), odd.select("_key"))
    same = (F.col("_node") == F.col("_odd_node")) & F.col("doc_id").eqNullSafe(F.col("_odd_id"))
    some = some.join(odd.drop("_key"), same, "left").where("_gone is null or not _gone")
    twice = (
        some.where("_gone is not null")
        .groupBy("_node")
        .agg(F.min(F.struct(*docs.columns)).alias("_row"))
        .select("_row.*")
    )
    return (
        rest.select(*docs.columns)
        .union(some.where("_gone is null").select(*docs.columns))
        .union(twice)
        .union(docs.where("text is null"))
    )
