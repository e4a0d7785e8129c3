"""Feature state: fit (clip, impute, scale, categories) and apply."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import clip_upper, scale
from leadgrade.plans.ordered import interpolate, quantiles
from leadgrade.plans.selection import numbered, wide_quantiles
from leadgrade.plans.sizing import written

NUMERIC = (*C.CLIPPED_NUMERIC, *C.RATIO_NUMERIC)
STATE_VERSION = 1
SKETCH_ACCURACY = 10_000
#: Slot tables up to this size are looked up as maps; larger ones by joins over salted copies.
MAP_BYTES, SALTS = 1 << 18, 16


def _long(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    typed = df.select(*[F.col(c).cast(dtype).alias(c) for c in columns])
    return typed.unpivot([], list(columns), "column", "value")


def clip_thresholds(derived: DataFrame, q: float = C.CLIP_QUANTILE) -> DataFrame:
    """(column, clip): exact upper quantile of each clipped numeric column."""
    long = _long(derived, C.CLIPPED_NUMERIC, "double")
    return quantiles(long, "value", {"clip": q}, ["column"]).select("column", "clip")


def numeric_params(derived: DataFrame, exact: bool = True) -> DataFrame:
    """(column, clip, impute, has_indicator), one row per numeric column.

    The median is taken over clipped values. Clipping keeps the order, so it is
    the clipped pair of middle values, and one selection serves both quantiles. A
    column that is null throughout imputes zero. ``exact=False`` reads both
    quantiles off one mergeable sketch instead.
    """
    if exact:
        wanted = {c: (C.CLIP_QUANTILE, 0.5) if c in C.CLIPPED_NUMERIC else (0.5,) for c in NUMERIC}
        found = wide_quantiles(derived, wanted)
        at = lambda p, c: F.max(F.when(F.col("prob") == p, F.col(c)))
        stats = found.groupBy("column").agg(
            F.max("n").alias("n"),
            F.max("n_null").alias("_n"),
            at(C.CLIP_QUANTILE, "quantile").alias("clip"),
            at(0.5, "lo").alias("median_lo"),
            at(0.5, "hi").alias("median_hi"),
        )
        clip = F.col("clip")
        lo, hi = F.least("median_lo", clip), F.least("median_hi", clip)
        median = interpolate(lo, hi, F.col("n"), 0.5)
    else:
        long = _long(derived, NUMERIC, "double")
        sketch = F.percentile_approx("value", [C.CLIP_QUANTILE, 0.5], SKETCH_ACCURACY)
        stats = long.groupBy("column").agg(
            sketch.alias("_q"), F.count_if(F.col("value").isNull()).alias("_n")
        )
        clip = F.when(F.col("column").isin(*C.CLIPPED_NUMERIC), F.get("_q", 0))
        median = F.least(F.get("_q", 1), clip)
    clipped = F.col("column").isin(*C.CLIPPED_NUMERIC)
    return stats.select(
        "column",
        clip.alias("clip"),
        F.coalesce(median, F.lit(0.0)).alias("impute"),
        (clipped & (F.col("_n") > 0)).alias("has_indicator"),
    )


def category_column(name: str) -> Column:
    """Placeholder and missing become one explicit category."""
    return F.coalesce(
        F.nullif(F.col(name), F.lit(C.SELECT_PLACEHOLDER)), F.lit(C.UNKNOWN_CATEGORY)
    )


def category_frequencies(
    derived: DataFrame, min_count: int = C.MIN_CATEGORY_COUNT
) -> DataFrame:
    """(column, value, n, is_frequent); counts combine before the shuffle."""
    filled = derived.select(*[category_column(c).alias(c) for c in C.CATEGORICAL])
    counts = (
        filled.unpivot([], list(C.CATEGORICAL), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    return counts.withColumn("is_frequent", F.col("n") >= min_count)


def category_slots(frequencies: DataFrame) -> DataFrame:
    """Add ``slot`` (0-based within the column) and ``slot_name``.

    Frequent values take slots in sorted order; all rare known values share the
    slot after them. Values are numbered by ranges, so no task holds a whole column.
    """
    frequent = numbered(frequencies.where("is_frequent"), "column", "value")
    widths = frequent.groupBy("column").agg(F.count("*").cast("int").alias("_width"))
    rare = (
        frequencies.where(~F.col("is_frequent"))
        .join(widths, "column", "left")
        .withColumn("slot", F.coalesce("_width", F.lit(0)))
        .drop("_width")
    )
    return frequent.unionByName(rare).withColumn(
        "slot_name",
        F.concat_ws(
            "_",
            "column",
            F.when(F.col("is_frequent"), F.col("value")).otherwise(C.INFREQUENT_SUFFIX),
        ),
    )


def safe_names(names: Sequence[str]) -> list[str]:
    """Feature names without the characters some tree libraries refuse."""
    return [re.sub(r'[\[\]{}":,]', "_", name) for name in names]


@dataclass
class NumericParam:
    column: str
    clip: float | None
    impute: float
    has_indicator: bool
    mean: float = 0.0
    std: float = 1.0
    indicator_mean: float = 0.0
    indicator_std: float = 1.0

    def clipped(self) -> Column:
        value = F.col(self.column).cast("double")
        return value if self.clip is None else clip_upper(value, F.lit(self.clip))

    def imputed(self) -> Column:
        return F.coalesce(self.clipped(), F.lit(self.impute))

    def indicator(self) -> Column:
        return F.col(self.column).isNull().cast("double")

    def scaled(self) -> Column:
        return scale(self.imputed(), F.lit(self.mean), F.lit(self.std))

    def scaled_indicator(self) -> Column:
        return scale(
            self.indicator(), F.lit(self.indicator_mean), F.lit(self.indicator_std)
        )


@dataclass
class FeatureState:
    """Fitted parameters: seven numeric rows and one table of category slots.

    ``slots`` is a stored table, so the planner knows its bytes and picks the join of
    its lookups.
    """

    numeric: list[NumericParam]
    slots: DataFrame
    n_rows: int
    version: int = STATE_VERSION

    @property
    def spark(self) -> SparkSession:
        return self.slots.sparkSession

    def indicators(self) -> list[NumericParam]:
        return [p for p in self.numeric if p.has_indicator]

    def numeric_columns(self) -> dict[str, Column]:
        """Scaled numerics, then their missing indicators, then the ratios."""
        head = [p for p in self.numeric if p.column in C.CLIPPED_NUMERIC]
        tail = [p for p in self.numeric if p.column in C.RATIO_NUMERIC]
        return {
            **{p.column: p.scaled() for p in head},
            **{f"missing_{p.column}": p.scaled_indicator() for p in self.indicators()},
            **{p.column: p.scaled() for p in tail},
        }

    def lookup_bytes(self) -> int:
        """Bytes of the slot table's values, measured on the stored table."""
        size = F.sum(F.octet_length("value") + F.lit(16))
        return self.slots.agg(F.coalesce(size, F.lit(0)).alias("n")).first()["n"]

    def with_slots(self, derived: DataFrame) -> DataFrame:
        """``derived`` with ``<column>_slot`` of every categorical, null for unknown values.

        A table of at most ``MAP_BYTES`` goes to all tasks as one row of maps, and all columns
        are looked up in the same projection. A larger one is joined column by column, with
        each slot in ``SALTS`` copies, so that a frequent value is spread over tasks.
        """
        if self.lookup_bytes() <= MAP_BYTES:
            entry = F.struct("value", "slot")
            maps = self.slots.agg(
                *[
                    F.map_from_entries(F.collect_list(F.when(F.col("column") == c, entry))).alias(f"_map_{c}")
                    for c in C.CATEGORICAL
                ]
            )
            found = {
                f"{c}_slot": F.try_element_at(f"_map_{c}", category_column(c)) for c in C.CATEGORICAL
            }
            wide = derived.crossJoin(F.broadcast(maps)).withColumns(found)
            return wide.drop(*[f"_map_{c}" for c in C.CATEGORICAL])
        salt = F.pmod(F.xxhash64(*C.CATEGORICAL, *NUMERIC), F.lit(SALTS)).cast("int")
        out = derived.withColumn("_salt", salt)
        copies = self.slots.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        for c in C.CATEGORICAL:
            own = copies.where(F.col("column") == c).select(
                F.col("value").alias("_value"), "_salt", F.col("slot").alias(f"{c}_slot")
            )
            out = out.withColumn("_value", category_column(c)).join(own, ["_value", "_salt"], "left")
            out = out.drop("_value")
        return out.drop("_salt")

    def transform(self, derived: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Scaled numerics, one slot number per categorical, and the flags.

        The slot is null for a value that was not seen when the state was fitted.
        """
        out = self.with_slots(derived)
        numeric = self.numeric_columns()
        return out.select(
            *keep,
            *[col.alias(name) for name, col in numeric.items()],
            *[f"{c}_slot" for c in C.CATEGORICAL],
            "country_is_india",
            *C.BINARIES,
        )

    def one_hot(self, derived: DataFrame, key: str = "lead_id") -> DataFrame:
        """(key, column, slot_name) for every active one-hot slot."""
        filled = derived.select(
            key, *[category_column(c).alias(c) for c in C.CATEGORICAL]
        )
        long = filled.unpivot([key], list(C.CATEGORICAL), "column", "value")
        lookup = self.slots.select("column", "value", "slot_name")
        return long.join(lookup, ["column", "value"]).select(key, "column", "slot_name")

    def widths(self) -> dict[str, int]:
        """One-hot width of every categorical column (one row per column)."""
        rows = self.slots.groupBy("column").agg(F.max("slot").alias("m")).collect()
        found = {r["column"]: int(r["m"]) + 1 for r in rows}
        return {c: found.get(c, 0) for c in C.CATEGORICAL}

    def assembler(self, widths: dict[str, int]) -> PipelineModel:
        """Slots and scaled columns -> one ``features`` vector, inside the JVM.

        The encoder learns only the widths, so it is fitted on a single row that
        holds them; the index past the last slot encodes to all zeros.
        """
        widths = {c: w for c, w in widths.items() if w}
        row = self.spark.createDataFrame(
            [tuple(float(w) for w in widths.values())], [f"{c}_slot" for c in widths]
        )
        encoder = OneHotEncoder(
            inputCols=[f"{c}_slot" for c in widths],
            outputCols=[f"{c}_hot" for c in widths],
            dropLast=True,
        ).fit(row)
        inputs = [
            *self.numeric_columns(),
            *[f"{c}_hot" for c in widths],
            "country_is_india",
            *C.BINARIES,
        ]
        vector = VectorAssembler(inputCols=inputs, outputCol="features")
        return PipelineModel([encoder, vector])

    def vectors(self, derived: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        widths = self.widths()
        flat = self.transform(derived, keep).withColumns(
            {
                f"{c}_slot": F.coalesce(f"{c}_slot", F.lit(w)).cast("double")
                for c, w in widths.items()
            }
        )
        return self.assembler(widths).transform(flat).select(*keep, "features")

    def catalog(self) -> DataFrame:
        """(position, name, source_column, kind) of every vector element."""
        head = []
        for name in self.numeric_columns():
            if name.startswith("missing_"):
                source, kind = name.removeprefix("missing_"), "missing_indicator"
            elif name in C.CLIPPED_NUMERIC:
                source, kind = name, "numeric_clipped"
            else:
                source, kind = "derived", "numeric_ratio"
            head.append((0, len(head), 0, name, source, kind))
        tail = [(2, 0, 0, "country_is_india", "country", "binary_derived")]
        for name in C.BINARIES:
            derived = name in C.ACTIVITY_FLAGS
            source = "last_activity" if derived else name
            kind = "binary_derived" if derived else "binary_passthrough"
            tail.append((2, len(tail), 0, name, source, kind))
        schema = "block int, major int, slot int, name string, source_column string, kind string"
        fixed = self.spark.createDataFrame(head + tail, schema)
        major = F.array_position(
            F.array(*[F.lit(c) for c in C.CATEGORICAL]), F.col("column")
        )
        kind = F.when(F.col("is_frequent"), "onehot").otherwise("onehot_rare")
        hot = self.slots.select(
            F.lit(1).alias("block"),
            major.cast("int").alias("major"),
            "slot",
            F.col("slot_name").alias("name"),
            F.col("column").alias("source_column"),
            kind.alias("kind"),
        ).distinct()
        return fixed.unionByName(hot)


def scaling_row(derived: DataFrame, params: Sequence[NumericParam]) -> DataFrame:
    """One row: row count, mean and population deviation after clip and impute."""
    aggs = [F.count("*").alias("n_rows")]
    for p in params:
        for prefix, col in (("v", p.imputed()), ("i", p.indicator())):
            aggs += [
                F.avg(col).alias(f"{prefix}_mean_{p.column}"),
                F.stddev_pop(col).alias(f"{prefix}_std_{p.column}"),
            ]
    return derived.agg(*aggs)


def fit(
    derived: DataFrame, min_count: int = C.MIN_CATEGORY_COUNT, exact: bool = True
) -> FeatureState:
    """Three aggregation jobs: quantiles, then moments, then category counts.

    Only parameters come back to the driver: seven numeric rows and one row of
    moments; the category table is stored. Fit on the training part unless the
    whole table is meant.
    """
    by_name = {r["column"]: r for r in numeric_params(derived, exact).collect()}
    params = [
        NumericParam(c, row["clip"], row["impute"], row["has_indicator"])
        for c in NUMERIC
        for row in [by_name[c]]
    ]
    moments = scaling_row(derived, params).first()
    for p in params:
        p.mean, p.std = moments[f"v_mean_{p.column}"], moments[f"v_std_{p.column}"]
        p.indicator_mean = moments[f"i_mean_{p.column}"]
        p.indicator_std = moments[f"i_std_{p.column}"]
    slots = written(category_slots(category_frequencies(derived, min_count)), "slots")
    return FeatureState(params, slots, moments["n_rows"])


def params_frame(state: FeatureState) -> DataFrame:
    """The numeric parameters as a table."""
    rows = [
        (
            p.column,
            p.clip,
            p.impute,
            p.has_indicator,
            p.mean,
            p.std,
            p.indicator_mean,
            p.indicator_std,
        )
        for p in state.numeric
    ]
    return state.spark.createDataFrame(
        rows,
        "column string, clip double, impute double, has_indicator boolean, mean double, "
        "std double, indicator_mean double, indicator_std double",
    )


def missing_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null, n_nan, n_inf): all must be zero after the transform."""
    inf = float("inf")
    rows = []
    for c in columns:
        value = F.col(c).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(value.isNull()).alias("n_null"),
                F.count_if(F.isnan(value)).alias("n_nan"),
                F.count_if(F.abs(value) == inf).alias("n_inf"),
            )
        )
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
