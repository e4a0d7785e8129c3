"""Language identification by compression.

Each language gets a dictionary: slices of labelled texts, used by zstandard as raw
content. A text is cut into pieces; every piece is compressed once with each
dictionary, and the language with the fewest bytes in total wins. Case is folded. The difference to
the runner-up is the margin; a text with a narrow margin is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrade.llm.words import pieces

UNKNOWN = "und"
#: The learner's bound: slices of so many characters per language.
SLICES, SLICE_CHARS = 192, 640
DICT_BYTES = 112 * 1024
PIECE_BYTES = 8192
#: A text is rejected if the runner-up needs less than this share more bytes.
NARROW = 0.004
SHORT_BYTES = 512
#: A block that hardly shrinks is stored as it is; a run behind a short text prevents that.
PADDING = bytes(256)

_FOUND = ("_lang", "_score", "_margin")
_NARROW = f"_lang = '{UNKNOWN}' or _margin < {NARROW}"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary of each language, languages in ascending order."""

    dictionaries: dict[str, bytes]


def held_out(doc_id: Column) -> Column:
    """True for rows that are kept from learning; a null id is not held out."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def learn(docs: DataFrame, slices: int = SLICES) -> LanguageModel:
    """Dictionaries from rows (doc_id, text, lang) that aren't held out.

    Per language the ``slices`` rows with the smallest hash of text and id give a slice of
    ``SLICE_CHARS`` characters each, so what the driver gets is bounded by the number
    of languages. Rows with null id, text or language, or no letter, are skipped.
    No labelled row gives a model without languages.
    """
    key = F.xxhash64("text", "doc_id")
    start = F.lit(1) + F.pmod(key, F.greatest(F.length("text") - SLICE_CHARS + 1, F.lit(1)))
    rows = (
        docs.where("doc_id is not null and lang is not null")
        .where(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
        .select("lang", key.alias("key"), F.lower(F.col("text").substr(start.cast("int"), F.lit(SLICE_CHARS))).alias("part"))
    )
    order = Window.partitionBy("lang").orderBy("key", "part")
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= slices)
    parts: dict[str, list] = {}
    for r in best.collect():
        parts.setdefault(r.lang, []).append((r.rank, r.part))
    # What stands last in a dictionary is nearest, so the order is the same each time.
    return LanguageModel(
        {
            lang: "\n".join(p for _, p in sorted(found, reverse=True)).encode()[-DICT_BYTES:]
            for lang, found in sorted(parts.items())
        }
    )


def _compressors(model: LanguageModel, short: bool) -> list[zstd.ZstdCompressor]:
    """One per language; matches of four bytes and longer count."""
    out = []
    for content in model.dictionaries.values():
        own = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        params = zstd.ZstdCompressionParameters.from_level(
            9 if short else 6,
            source_size=2 * SHORT_BYTES if short else PIECE_BYTES,
            dict_size=len(content),
            min_match=4,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        own.precompute_compress(compression_params=params)
        out.append(zstd.ZstdCompressor(dict_data=own, compression_params=params))
    return out


def _cuts(data: bytes) -> list[bytes]:
    """Pieces of at most ``PIECE_BYTES`` bytes."""
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def _identified(model: LanguageModel):
    names = list(model.dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = _compressors(model, True), _compressors(model, False)
        for batch in (part for whole in batches for part in pieces(whole, "text")):
            texts = pc.utf8_lower(batch["text"]).cast(pa.large_binary())
            usable = batch["_usable"].to_pylist()
            best = np.zeros(batch.num_rows, np.int64)
            score, margin = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, ok in enumerate(usable):
                if not ok or not names:
                    best[i] = len(names)
                    continue
                data = texts[i].as_buffer()
                if len(data) <= SHORT_BYTES:
                    raw = data.to_pybytes() + PADDING
                    size = np.array([len(c.compress(raw)) for c in short])
                else:
                    size = np.zeros(len(names), np.int64)
                    for piece in _cuts(memoryview(data)):
                        size += [len(c.compress(piece)) for c in long]
                best[i] = size.argmin()
                more = np.sort(size) - size.min()
                score[i] = 1 / np.exp2(-8.0 * more).sum()
                margin[i] = more[1] / size.min() if len(more) > 1 else 1.0
            named = pa.array([*names, UNKNOWN]).take(pa.array(best))
            columns = batch.columns[:-1] + [named, pa.array(score), pa.array(margin)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *_FOUND])

    return run


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected; same-named columns go.

    Only the text is looked at, whole. lang_pred is ``und`` and score 0 if the text is null or
    has no letter, or if the model knows no language. score is the share of the best
    language among all when a code of n bytes has the weight 2^(-8n). margin is
    the runner-up's extra bytes over the best's bytes; the first of equal languages
    wins. rejected: ``und``, or a margin below ``NARROW``.
    """
    found = _marked(docs.drop("lang_pred", "score", "margin", "rejected"), model)
    names = dict(zip(_FOUND, ("lang_pred", "score", "margin"), strict=True))
    return found.withColumn("rejected", F.expr(_NARROW)).withColumnsRenamed(names)


def _marked(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``_FOUND``. The text goes to Python once, as it is."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    kinds = [f"{n} {t}" for n, t in zip(_FOUND, ("string", "double", "double"), strict=True)]
    usable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("*", usable.alias("_usable")).mapInArrow(
        _identified(model), ", ".join([*fields, *kinds])
    )


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected, with their own columns."""
    return _marked(docs, model).where(f"not ({_NARROW})").select(*docs.columns)
