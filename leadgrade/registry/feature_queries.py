"""Derived features, fitted state and its application."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6, r9
from leadgrade.operators import features, models, segments
from leadgrade.operators.derive import derive_features
from leadgrade.operators.derive import dropped_columns as drop_reasons
from leadgrade.operators.features import NUMERIC
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.views import with_ctes


def _yes(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) = 'yes' THEN 1 ELSE 0 END"


def _in(c: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {c} IN ({listed}) THEN 1 ELSE 0 END"


DERIVED_SQL = f"""
derived AS (
  SELECT lead_id, converted, {', '.join(C.CLIPPED_NUMERIC)},
    total_time_spent / CASE WHEN total_visits > 0 THEN total_visits ELSE 1.0 END AS total_time_per_visit,
    {' + '.join(_yes(c) for c in C.CHANNEL_FLAGS)} AS channel_diversity_count,
    {', '.join(f"nullif({c}, 'Select') AS {c}" for c in C.CATEGORICAL)},
    CASE WHEN trim(country) = 'India' THEN 1 ELSE 0 END AS country_is_india,
    {', '.join(f"{_yes(c)} AS {c}" for c in C.YES_NO_FLAGS)},
    {_in('last_activity', C.HIGH_INTENT_ACTIVITIES)} AS is_high_intent_activity,
    {_in('last_activity', C.NEGATIVE_ACTIVITIES)} AS is_negative_activity
  FROM leads)"""
DERIVED = (V.LEADS_SQL, DERIVED_SQL)


def derived_leads(spark, sf, keep=("lead_id",)):
    wanted = {*C.REQUIRED_RAW, *keep}
    return derive_features(V.raw_leads(spark, sf, wanted), keep)


# The ratio is one IEEE division, equal in both engines; rounding it could split ties.
_EDGE = {c: f"round({c}, 6) AS {c}" for c in C.CLIPPED_NUMERIC}


def _edge_sql(c: str) -> str:
    return c if c == "total_time_per_visit" else f"round({c}, 9) AS {c}"


@register(
    "derive_features",
    with_ctes(*DERIVED)
    + "SELECT lead_id, "
    + ", ".join(_EDGE.get(c, c) for c in C.DERIVED_ORDER)
    + " FROM derived",
)
def derive(spark, sf):
    out = derived_leads(spark, sf)
    return out.withColumns({c: r6(c) for c in _EDGE}).withColumns(
        {
            c: F.col(c).cast("int")
            for c in ("channel_diversity_count", "country_is_india", *C.BINARIES)
        }
    )


CLIP_SQL = "clips AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.95) AS clip FROM derived"
    for c in C.CLIPPED_NUMERIC
) + ")"


def _clip(c: str) -> str:
    return f"(SELECT clip FROM clips WHERE \"column\" = '{c}')"


def _clipped(c: str) -> str:
    if c not in C.CLIPPED_NUMERIC:
        return f"CAST({c} AS DOUBLE)"
    return f"CASE WHEN {c} > {_clip(c)} THEN {_clip(c)} ELSE {c} END"


CLIPPED_SQL = (
    "clipped AS (SELECT lead_id, "
    + ", ".join(f"{_clipped(c)} AS {c}" for c in NUMERIC)
    + " FROM derived)"
)
IMPUTE_SQL = "imputes AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS impute, "
    + (f"count(*) > count({c})" if c in C.CLIPPED_NUMERIC else "false")
    + " AS has_indicator FROM clipped"
    for c in NUMERIC
) + ")"


def _impute(c: str) -> str:
    return f"(SELECT impute FROM imputes WHERE \"column\" = '{c}')"


IMPUTED_SQL = (
    "imputed AS (SELECT lead_id, "
    + ", ".join(f"coalesce({c}, {_impute(c)}) AS {c}" for c in NUMERIC)
    + ", "
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END AS missing_{c}"
        for c in C.CLIPPED_NUMERIC
    )
    + " FROM clipped)"
)
_MOMENTS = (*NUMERIC, *[f"missing_{c}" for c in C.CLIPPED_NUMERIC])
MOMENTS_SQL = (
    "moments AS (SELECT "
    + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS std_{c}"
        for c in _MOMENTS
    )
    + " FROM imputed)"
)
INDICATED = tuple(c for c in C.CLIPPED_NUMERIC if c != "total_time_spent")
SCALED_NAMES = (*NUMERIC, *[f"missing_{c}" for c in INDICATED])
SCALED_SQL = (
    "scaled AS (SELECT lead_id, "
    + ", ".join(
        f"(CAST({c} AS DOUBLE) - mean_{c}) / CASE WHEN std_{c} = 0 THEN 1.0 ELSE std_{c} END AS {c}"
        for c in SCALED_NAMES
    )
    + " FROM imputed, moments)"
)
STATE = (*DERIVED, CLIP_SQL, CLIPPED_SQL, IMPUTE_SQL, IMPUTED_SQL, MOMENTS_SQL)


@register(
    "clip_thresholds",
    with_ctes(*DERIVED, CLIP_SQL) + 'SELECT "column", round(clip, 9) AS clip FROM clips',
)
def clip_thresholds(spark, sf):
    out = features.clip_thresholds(derived_leads(spark, sf))
    return out.withColumn("clip", r9("clip"))


@register(
    "clip_upper",
    with_ctes(*DERIVED, CLIP_SQL, CLIPPED_SQL)
    + "SELECT lead_id, "
    + ", ".join(f"round({c}, 9) AS {c}" for c in C.CLIPPED_NUMERIC)
    + " FROM clipped",
)
def clip_upper(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    clipped = {p.column: p.clipped() for p in state.numeric if p.clip is not None}
    return derived.select("lead_id", *[r9(col).alias(c) for c, col in clipped.items()])


@register(
    "impute_values",
    with_ctes(*DERIVED, CLIP_SQL, CLIPPED_SQL, IMPUTE_SQL)
    + 'SELECT "column", round(impute, 9) AS impute, has_indicator FROM imputes',
)
def impute_values(spark, sf):
    return features.numeric_params(derived_leads(spark, sf)).select(
        "column", r9("impute").alias("impute"), "has_indicator"
    )


@register(
    "impute_indicator",
    with_ctes(*STATE)
    + "SELECT lead_id, "
    + ", ".join(_edge_sql(c) for c in NUMERIC)
    + ", "
    + ", ".join(f"CAST(missing_{c} AS DOUBLE) AS missing_{c}" for c in INDICATED)
    + " FROM imputed",
)
def impute_indicator(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    return derived.select(
        "lead_id",
        *[
            (p.imputed() if p.column == "total_time_per_visit" else r9(p.imputed())).alias(
                p.column
            )
            for p in state.numeric
        ],
        *[p.indicator().alias(f"missing_{p.column}") for p in state.indicators()],
    )


@register(
    "scaler_params",
    with_ctes(*STATE)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(mean_{c}, 6) AS mean, round(std_{c}, 6) AS std FROM moments"
        for c in NUMERIC
    ),
)
def scaler_params(spark, sf):
    state = features.fit(derived_leads(spark, sf))
    return features.params_frame(state).select(
        "column", r6("mean").alias("mean"), r6("std").alias("std")
    )


@register(
    "scaled_numeric",
    with_ctes(*STATE, SCALED_SQL)
    + "SELECT lead_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in SCALED_NAMES)
    + " FROM scaled",
)
def scaled_numeric(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    return derived.select(
        "lead_id", *[r6(col).alias(c) for c, col in state.numeric_columns().items()]
    )


FREQ_SQL = (
    "filled AS ("
    + " UNION ALL ".join(
        f"SELECT lead_id, '{c}' AS col, coalesce({c}, 'Unknown') AS val FROM derived"
        for c in C.CATEGORICAL
    )
    + "), freq AS (SELECT col, val, count(*) AS n, count(*) >= 20 AS is_frequent"
    " FROM filled GROUP BY col, val)"
)


@register(
    "category_frequencies",
    with_ctes(*DERIVED, FREQ_SQL)
    + 'SELECT col AS "column", val AS "value", n, is_frequent FROM freq',
)
def category_frequencies(spark, sf):
    return features.category_frequencies(derived_leads(spark, sf))


@register(
    "one_hot_min_frequency",
    with_ctes(*DERIVED, FREQ_SQL)
    + """SELECT lead_id, filled.col AS "column",
      filled.col || '_' || CASE WHEN is_frequent THEN filled.val ELSE 'infrequent' END AS slot_name
      FROM filled JOIN freq ON freq.col = filled.col AND freq.val = filled.val""",
)
def one_hot(spark, sf):
    derived = derived_leads(spark, sf)
    return features.fit(derived).one_hot(derived)


@register(
    "fit_feature_state",
    with_ctes(*STATE, FREQ_SQL)
    + " UNION ALL ".join(
        f"""SELECT 'numeric' AS kind, '{c}' AS "column",
        {f"(SELECT round(clip, 9) FROM clips WHERE {chr(34)}column{chr(34)} = '{c}')" if c in C.CLIPPED_NUMERIC else "CAST(NULL AS DOUBLE)"} AS clip,
        round({_impute(c)}, 9) AS impute, round(mean_{c}, 6) AS mean, round(std_{c}, 6) AS std,
        CAST(0 AS BIGINT) AS n_slots FROM moments"""
        for c in NUMERIC
    )
    + """ UNION ALL SELECT 'categorical', col, NULL, NULL, NULL, NULL,
      count(*) FILTER (WHERE is_frequent) + CAST(bool_or(NOT is_frequent) AS BIGINT)
      FROM freq GROUP BY col""",
)
def fit_feature_state(spark, sf):
    state = features.fit(derived_leads(spark, sf))
    numeric = features.params_frame(state).select(
        F.lit("numeric").alias("kind"),
        "column",
        *[r9(c).alias(c) for c in ("clip", "impute")],
        *[r6(c).alias(c) for c in ("mean", "std")],
        F.lit(0).cast("bigint").alias("n_slots"),
    )
    none = F.lit(None).cast("double")
    slots = state.slots.groupBy("column").agg(
        F.count_distinct("slot").cast("bigint").alias("n_slots")
    )
    return numeric.unionByName(
        slots.select(
            F.lit("categorical").alias("kind"),
            "column",
            *[none.alias(c) for c in ("clip", "impute", "mean", "std")],
            "n_slots",
        )
    )


_SLOT_SQL = """
slots AS (
  SELECT col, val, CASE WHEN is_frequent
      THEN count(*) FILTER (WHERE is_frequent) OVER (PARTITION BY col ORDER BY val ROWS UNBOUNDED PRECEDING) - 1
      ELSE count(*) FILTER (WHERE is_frequent) OVER (PARTITION BY col) END AS slot FROM freq),
hot AS (
  SELECT lead_id, """ + ", ".join(
    f"max(CASE WHEN filled.col = '{c}' THEN slot END) AS {c}_slot" for c in C.CATEGORICAL
) + """ FROM filled JOIN slots ON slots.col = filled.col AND slots.val = filled.val GROUP BY lead_id)"""
FLAGS = ("country_is_india", *C.BINARIES)


@register(
    "transform_features",
    with_ctes(*STATE, SCALED_SQL, FREQ_SQL, _SLOT_SQL)
    + "SELECT scaled.lead_id, "
    + ", ".join(f"round(scaled.{c}, 6) AS {c}" for c in SCALED_NAMES)
    + ", "
    + ", ".join(f"CAST({c}_slot AS INTEGER) AS {c}_slot" for c in C.CATEGORICAL)
    + ", "
    + ", ".join(FLAGS)
    + " FROM scaled JOIN hot ON hot.lead_id = scaled.lead_id JOIN derived ON derived.lead_id = scaled.lead_id",
)
def transform_features(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    out = state.transform(derived, ["lead_id"])
    return out.withColumns(
        {c: r6(c) for c in state.numeric_columns()}
        | {f"{c}_slot": F.col(f"{c}_slot").cast("int") for c in C.CATEGORICAL}
        | {c: F.col(c).cast("int") for c in FLAGS}
    )


@register(
    "feature_sanity",
    with_ctes(*STATE, SCALED_SQL)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_null,
        count(*) FILTER (WHERE isnan({c})) AS n_nan, count(*) FILTER (WHERE isinf({c})) AS n_inf FROM scaled"""
        for c in SCALED_NAMES
    ),
)
def feature_sanity(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    scaled = state.transform(derived, ["lead_id"])
    return features.missing_cells(scaled, list(state.numeric_columns()))


@register(
    "feature_catalog",
    with_ctes(*STATE, FREQ_SQL)
    + f"""SELECT kind, count(*) AS n FROM (
      SELECT 'onehot' AS kind FROM freq WHERE is_frequent
      UNION ALL SELECT DISTINCT ON (col) 'onehot_rare' FROM freq WHERE NOT is_frequent
      UNION ALL SELECT CASE WHEN "column" IN ('total_time_per_visit', 'channel_diversity_count')
        THEN 'numeric_ratio' ELSE 'numeric_clipped' END FROM imputes
      UNION ALL SELECT 'missing_indicator' FROM imputes WHERE has_indicator
      UNION ALL SELECT unnest(['binary_derived', 'binary_derived', 'binary_derived'])
      UNION ALL SELECT unnest([{", ".join("'binary_passthrough'" for _ in C.YES_NO_FLAGS)}])
      ) GROUP BY kind""",
)
def feature_catalog(spark, sf):
    """Number of vector elements per kind."""
    catalog = features.fit(derived_leads(spark, sf)).catalog()
    return catalog.groupBy("kind").agg(F.count("*").alias("n"))


_DROPPED = {
    **dict.fromkeys(C.ID_COLUMNS, "identifier"),
    **dict.fromkeys(C.POST_OUTCOME_COLUMNS, "known only after the outcome"),
    **dict.fromkeys(C.DEAD_FLAGS, "constant"),
}


@register(
    "dropped_columns",
    with_ctes(V.LEADS_SQL)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{why}' AS reason, count({c}) AS n_present FROM leads"
        for c, why in _DROPPED.items()
    ),
)
def dropped_columns(spark, sf):
    """Why raw columns are no features, and how often they hold a value."""
    return drop_reasons(V.raw_leads(spark, sf))


COEFFICIENTS = {
    "total_visits": 0.5,
    "total_time_spent": 0.8,
    "page_views_per_visit": -0.2,
    "activity_score": 0.3,
    "profile_score": 0.1,
    "total_time_per_visit": -0.4,
    "channel_diversity_count": 0.05,
}


@register(
    "linear_attribution",
    with_ctes(*STATE, SCALED_SQL)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(abs(CAST({b} AS DOUBLE) * {c})), 6) AS mean_abs FROM scaled"
        for c, b in COEFFICIENTS.items()
    ),
)
def linear_attribution(spark, sf):
    derived = derived_leads(spark, sf)
    state = features.fit(derived)
    scaled = derived.select(*[c.alias(n) for n, c in state.numeric_columns().items()])
    rows = models.linear_attribution(scaled, COEFFICIENTS)
    return models.mean_absolute_contribution(rows, list(COEFFICIENTS))


# --- segments ---

ENGAGEMENT = ("total_time_spent", "total_visits", "page_views_per_visit", "last_activity")
_BONUS = "CASE last_activity " + " ".join(
    f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in C.ACTIVITY_BONUS.items()
) + " ELSE 0.0 END"


def _norm(c: str) -> str:
    return (
        f"CASE WHEN q_{c} > 0 THEN greatest(0.0, least(1.0, coalesce({c}, 0.0) / q_{c})) ELSE 0.0 END"
    )


def _normal(seed: str) -> str:
    return (
        f"(sqrt(-2.0 * ln(CAST(1.0 AS DOUBLE) - {V.u_sql('lead_id', seed + 'a')})) "
        f"* cos(CAST(6.283185307179586 AS DOUBLE) * {V.u_sql('lead_id', seed + 'b')}))"
    )


def engagement_sql(noise: float) -> str:
    mean = " + ".join(
        f"CAST({C.ENGAGEMENT_WEIGHTS[c]} AS DOUBLE) * {_norm(c)}" for c in ENGAGEMENT[:3]
    )
    extra = f" + CAST({noise} AS DOUBLE) * {_normal('noise42')}" if noise else ""
    return f"""
limits AS (SELECT {', '.join(f"quantile_cont(coalesce({c}, 0.0), 0.95) AS q_{c}" for c in ENGAGEMENT[:3])}
  FROM leads),
engaged AS (
  SELECT lead_id, CAST(0.0 AS DOUBLE) + {mean}
    + CAST(0.35 AS DOUBLE) * {_BONUS}{extra} AS engagement FROM leads, limits)"""


@register(
    "engagement_score",
    with_ctes(V.LEADS_SQL, engagement_sql(0.0))
    + "SELECT lead_id, round(engagement, 6) AS engagement FROM engaged",
)
def engagement_score(spark, sf):
    leads = V.raw_leads(spark, sf, ("lead_id", *ENGAGEMENT))
    out = segments.engagement_score(leads, noise=0.0)
    return out.select("lead_id", r6("engagement").alias("engagement"))


@register(
    "assign_segments",
    with_ctes(V.LEADS_SQL, engagement_sql(0.3))
    + f"""SELECT lead_id, CASE WHEN engagement >= (SELECT quantile_cont(engagement, 0.5) FROM engaged)
        THEN CASE WHEN f >= -0.5 THEN 'positive_engagement' ELSE 'objection' END
        ELSE CASE WHEN f < 0.25 THEN 'disengaged' ELSE 'neutral' END END AS attitude
      FROM (SELECT *, {_normal('friction42')} AS f FROM engaged)""",
)
def assign_segments(spark, sf):
    leads = V.raw_leads(spark, sf, ("lead_id", *ENGAGEMENT))
    return segments.assign_segments(leads).select("lead_id", "attitude")


_TIME_SQL = """CASE WHEN total_time_spent IS NULL THEN 'unknown' WHEN total_time_spent < 60 THEN 'very_low'
  WHEN total_time_spent < 300 THEN 'low' WHEN total_time_spent < 900 THEN 'medium' ELSE 'high' END"""


@register(
    "time_bucket",
    with_ctes(V.LEADS_SQL) + f"SELECT lead_id, {_TIME_SQL} AS time_bucket FROM leads",
)
def time_bucket(spark, sf):
    leads = V.raw_leads(spark, sf, ("lead_id", "total_time_spent"))
    return segments.with_time_bucket(leads).select("lead_id", "time_bucket")


CONTEXT = ("lead_source", "specialization", "occupation", "last_activity")
CONTEXT_SQL = (
    "SELECT lead_id, "
    + ", ".join(
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower(trim({c})) = 'select'"
        f" THEN '{C.NOT_GIVEN}' ELSE trim({c}) END AS {c}"
        for c in CONTEXT
    )
    + f", {_TIME_SQL} AS time_bucket FROM leads"
)


@register("neutral_context", with_ctes(V.LEADS_SQL) + CONTEXT_SQL)
def neutral_context(spark, sf):
    leads = V.raw_leads(spark, sf, ("lead_id", *CONTEXT, "total_time_spent"))
    return segments.neutral_context(leads).select("lead_id", "context.*")


LANGUAGE_SQL = f"""CASE WHEN {V.u_sql('lead_id', 'lang42')} < CAST(0.5 AS DOUBLE) THEN 'tr'
  WHEN {V.u_sql('lead_id', 'lang42')} < CAST(0.7 AS DOUBLE) THEN 'en' ELSE 'mix' END"""


@register(
    "weighted_assignment",
    with_ctes(V.LEADS_SQL) + f"SELECT lead_id, {LANGUAGE_SQL} AS language FROM leads",
)
def weighted_assignment(spark, sf):
    return segments.assign_language(V.raw_leads(spark, sf, ["lead_id"]))
