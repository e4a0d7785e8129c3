"""Recurring lines, found with a log-template tree of fixed depth and dropped.

A line's path in the tree is its token count and its two leading tokens; a token with a
digit counts as a variable field from the start. In the leaf that a path leads to, a token
is fixed if more than half of the leaf's different lines have it at its place, any other is
a variable field. A line with its fields generalised is its template; a template that many
texts have is dropped wherever it stands. Shares don't change when the corpus grows by more
of the same, and nothing depends on an order.

Lines travel as hashes: one pass counts the leaves, a second one gives the lines of leaves
that recur, as hashes of the line and of its tokens. Lines of a leaf are dealt out in parts
of bounded size; a token that more than half of a leaf has must be that frequent in one
of the parts at least, so few candidates are counted over the whole leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrade.llm import words as W
from leadgrade.llm.cascade import STEP, Texts
from leadgrade.llm.filters import bits_for, maybe_in, parted
from leadgrade.plans.sizing import scope, written

FIELD = "<*>"
#: So many different texts make a template.
MIN_TEXTS = 10
#: A template needs so many fixed tokens, and this share of them; a line that is found as it
#: is, but for tokens with digits, the smaller share.
MIN_FIXED, FIXED_SHARE, DIGITS_SHARE = 4, 0.75, 0.5
#: Different lines of a leaf that one task counts.
PART = 1 << 14

_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
#: The hash of a field among token hashes; other tokens never have it.
_FIELD = 0


def _tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, first token, end) of every line with a token, and the hashes of
    all tokens, 0 for those with a digit."""
    starts, ends = texts._edges
    hashes = texts._hashes(starts, ends) | np.uint64(1)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[texts.data])])
    hashes[digits[ends] > digits[starts]] = _FIELD
    line_starts, line_ends = texts._lines
    first, end = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    some = end > first
    line_starts, first, end = line_starts[some], first[some], end[some]
    text = np.searchsorted(texts.offsets, line_starts, side="right") - 1
    breaks = np.flatnonzero(texts.data == 10)
    number = np.searchsorted(breaks, line_starts) - np.searchsorted(breaks, texts.offsets[text])
    return text, number, first, end, hashes


def _leaf(first: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Leaves of lines: the number of tokens and the first two."""
    size = (end - first).astype(np.uint64)
    second = np.where(end - first > 1, hashes[np.minimum(first + 1, len(hashes) - 1)], np.uint64(7))
    return W.mix(W.mix(W.mix(size + W._GOLD) ^ hashes[first]) + second)


def _line(first: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One hash of all tokens of a line."""
    power, inverse = W._powers_to(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum((hashes + np.uint64(3)) * power[: len(hashes)], out=sums[1:])
    return W.mix((sums[end] - sums[first]) * inverse[first] ^ (end - first).astype(np.uint64))


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in W.pieces(batch, "text", STEP):
            _, _, first, end, hashes = _tokens(Texts(piece["text"]))
            if len(first):
                leaf, n = np.unique(_leaf(first, end, hashes), return_counts=True)
                yield pa.RecordBatch.from_pydict({"leaf": pa.array(leaf.view(np.int64)), "n": pa.array(n)})


_LINE = "key binary, line_no int, leaf long, line long, field boolean, tokens array<int>"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in W.pieces(batch, "text", STEP):
            text, number, first, end, hashes = _tokens(Texts(piece["text"]))
            if not len(first):
                continue
            size = end - first
            fields = np.concatenate([[0], np.cumsum(hashes == _FIELD)])
            # Short forms of the token hashes; 0 stays the field.
            short = (hashes >> np.uint64(32)).astype(np.uint32) | (hashes != _FIELD)
            at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": piece["key"].take(pa.array(text)),
                    "line_no": pa.array(number.astype(np.int32)),
                    "leaf": pa.array(_leaf(first, end, hashes).view(np.int64)),
                    "line": pa.array(_line(first, end, hashes).view(np.int64)),
                    "field": pa.array(fields[end] > fields[first]),
                    "tokens": pa.ListArray.from_arrays(offsets, pa.array(short.astype(np.uint32).view(np.int32)[at])),
                }
            )


def _fixed(known: DataFrame) -> DataFrame:
    """(leaf, salt, fixed): the places and tokens that more than half of a leaf's lines have,
    for every part (leaf, salt) of ``known`` (leaf, salt, m, salts, tokens)."""
    spread = known.repartition("leaf", "salt")
    places = spread.select("leaf", "salt", "m", "salts", F.posexplode("tokens").alias("place", "token"))
    counts = places.where(F.col("token") != _FIELD).groupBy("leaf", "salt", "salts", "m", "place", "token").count()
    sizes = spread.groupBy("leaf", "salt").agg(F.count("*").alias("size"))
    often = counts.join(sizes, ["leaf", "salt"]).where(F.col("count") * 2 > F.col("size"))
    often = written(often.select("leaf", "salts", "m", "place", "token", "count"), "often")
    alone = often.where(F.col("salts") == 1).select("leaf", "salts", "place", "token")
    # Candidates of leaves in several parts are counted over all of them.
    entry = F.struct("place", "token")
    wanted = often.where(F.col("salts") > 1).groupBy("leaf", "salts", "m").agg(F.collect_set(entry).alias("wanted"))
    wanted = wanted.select("leaf", "m", "wanted", F.explode(_salts()).alias("salt"))
    own = F.transform("tokens", lambda t, i: F.struct(i.alias("place"), t.alias("token")))
    held = known.where(F.col("salts") > 1).drop("m").join(wanted, ["leaf", "salt"])
    held = held.select("leaf", "salts", "m", F.explode(F.array_intersect(own, "wanted")).alias("x"))
    whole = held.groupBy("leaf", "salts", "m", "x.place", "x.token").count().where(F.col("count") * 2 > F.col("m"))
    both = alone.union(whole.select("leaf", "salts", "place", "token"))
    found = both.groupBy("leaf", "salts").agg(F.map_from_entries(F.collect_list(entry)).alias("fixed"))
    return found.select("leaf", "fixed", F.explode(_salts()).alias("salt"))


def _salts() -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)


def recurring_lines(docs: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(key, dropped): the md5 of a text and a bitmap of its lines whose template is found in
    at least ``min_texts`` different texts: line i is bit i % 64 of word i / 64."""
    with scope() as kept:
        return kept.keep(_recurring(docs, min_texts))


def _recurring(docs: DataFrame, min_texts: int) -> DataFrame:
    texts = docs.where("text is not null").select(F.unhex(F.md5("text")).alias("key"), "text")
    # A leaf with fewer lines holds no template: few leaves and lines go on.
    counts = texts.select("text").mapInArrow(_leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    leaves = written(counts.where(F.col("n") >= min_texts).select("leaf"), "leaves")
    lines = texts.mapInArrow(_lines, _LINE)
    lines = maybe_in(lines, F.col("leaf"), leaves, bits_for(leaves.count()))
    lines = written(lines.join(leaves, "leaf"), "lines")
    where = lines.select("leaf", "line", "key")
    n_texts = where.distinct().groupBy("leaf", "line").agg(F.count("*").alias("n"))
    shapes = lines.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"), F.first("field").alias("field"))
    known = written(n_texts.join(shapes, ["leaf", "line"]), "known")
    # Leaves whose texts don't reach the number, all lines together, are out.
    sizes = known.groupBy("leaf").agg(F.count("*").alias("m"), F.sum("n").alias("all")).where(F.col("all") >= min_texts)
    sizes = written(sizes.select("leaf", "m", F.ceil(F.col("m") / PART).alias("salts")), "sizes")
    known = known.join(sizes, "leaf").withColumn("salt", F.pmod(F.xxhash64("line"), F.col("salts")))
    known = written(known, "parts")
    fixed = written(_fixed(known), "fixed")
    size, plain = F.size("tokens"), F.size(F.filter("tokens", lambda t: t != _FIELD))
    part = F.transform(
        "tokens", lambda t, i: F.when((t != _FIELD) & (F.try_element_at("fixed", i) == t), t).otherwise(_FIELD)
    )
    n_fixed = F.size(F.filter("part", lambda t: t != _FIELD))
    enough = (plain >= MIN_FIXED) & (plain >= DIGITS_SHARE * size)
    as_it_is = (F.col("n") >= min_texts) & (~F.col("field") | enough)
    general = (n_fixed >= MIN_FIXED) & (n_fixed >= FIXED_SHARE * size)
    templates = known.join(fixed, ["leaf", "salt"], "left").withColumn("part", part)
    templates = templates.select(
        "leaf", "line", "n", as_it_is.alias("found"),
        F.when(~as_it_is & general, F.xxhash64("part")).alias("template"),
    ).where("found or template is not null")
    templates = written(templates, "templates")
    # Texts of a general template are counted once each; few lines get as far.
    likely = templates.where("not found")
    many = likely.groupBy("leaf", "template").agg(F.sum("n").alias("n")).where(F.col("n") >= min_texts)
    likely = written(likely.drop("n").join(many.drop("n"), ["leaf", "template"]), "likely")
    texts_of = where.join(likely.select("leaf", "line", "template"), ["leaf", "line"])
    often = (
        texts_of.select("leaf", "template", "key").distinct().groupBy("leaf", "template").count()
        .where(F.col("count") >= min_texts).select("leaf", "template")
    )
    gone = templates.where("found").select("leaf", "line")
    gone = written(gone.union(likely.join(often, ["leaf", "template"]).select("leaf", "line")), "gone")
    rows = lines.select("key", "line_no", "leaf", "line").join(gone, ["leaf", "line"])
    bit = F.expr("shiftleft(1L, line_no & 63)")
    words = rows.groupBy("key", F.shiftright("line_no", 6).alias("at")).agg(F.bit_or(bit).alias("word"))
    lists = words.groupBy("key").agg(
        F.max("at").alias("last"), F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("found")
    )
    dense = F.transform(F.sequence(F.lit(0), "last"), lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0)))
    return written(lists.select("key", dense.cast("array<long>").alias("dropped")), "dropped")


def drop_lines(docs: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``; all rows and columns stay.

    Lines end at a line feed. Blank lines and the order of the rest are kept. Copies of
    a text count as one text, so copying a document makes none of its lines
    recurring. A line that recurs itself is dropped as it is. One that differs between texts
    in tokens with digits is dropped if at least four tokens, and half of all, have none, so
    rows of numbers stay. One whose leaf has at least four fixed tokens in common with it,
    and three quarters of its tokens, is dropped as a template. A null text stays null;
    a text of recurring lines alone becomes empty. Empty tables stay empty.
    """
    marked, dropped = _marked(docs, min_texts)
    return marked.withColumn("text", _left(dropped)).drop(dropped)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the caller's table doesn't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _marked(docs: DataFrame, min_texts: int) -> tuple[DataFrame, str]:
    """``docs`` with the bitmap of the lines to drop, null if there are none, and the name
    of that column."""
    key, own = _free(docs, "_key"), _free(docs, "_dropped")
    dropped = recurring_lines(docs, min_texts).toDF(key, own)
    rows = docs.withColumn(key, F.unhex(F.md5("text")))
    # Texts that surely keep all lines stay out of the join. A null text needs some key here.
    known = F.coalesce(key, F.unhex(F.lit("00")))
    some, rest = parted(rows, known, dropped.select(key), bits_for(dropped.count()))
    marked = some.join(dropped, key, "left").select(*docs.columns, own).union(
        rest.select(*docs.columns, F.lit(None).cast("array<long>").alias(own))
    )
    return marked, own


def _left(dropped: str) -> Column:
    def stays(_, i: Column) -> Column:
        word = F.coalesce(F.try_element_at(dropped, F.shiftright(i, 6) + 1), F.lit(0).cast("long"))
        return F.getbit(word, i.bitwiseAND(63)) == 0

    kept = F.filter(F.split("text", "\n"), stays)
    return F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def line_report(docs: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for every row: what ``drop_lines`` leaves, the
    number of lines it had (null text: 0) and of those dropped."""
    marked, dropped = _marked(docs.select("doc_id", "text"), min_texts)
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    ones = F.aggregate(dropped, F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w))
    n_dropped = F.coalesce(ones, F.lit(0)).cast("long")
    return marked.select(
        "doc_id", _left(dropped).alias("text"), n_lines.alias("n_lines"), n_dropped.alias("n_dropped")
    )
