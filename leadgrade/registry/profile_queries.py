"""Profiling, contingency and leakage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.functions.scoring import attitude_score
from leadgrade.functions.text import token_total
from leadgrade.operators import contingency, leakage, priority, profile, sketches
from leadgrade.operators.ranking import argmax_row
from leadgrade.plans.sizing import work_dir, written
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.views import with_ctes
from leadgrade.sources import ranked as ranked_store

RAW_AUDIT = tuple(a for a in C.RAW_COLUMNS.values())


@register(
    "class_balance",
    with_ctes(V.LEADS_SQL)
    + """SELECT count(*) AS n, CAST(sum(converted) AS BIGINT) AS n_positive,
      round(avg(CAST(converted AS DOUBLE)), 6) AS positive_rate FROM leads""",
)
def class_balance(spark, sf):
    return profile.class_balance(V.raw_leads(spark, sf, ["converted"]))


@register(
    "label_distribution",
    with_ctes(V.NOTES_SQL)
    + """SELECT 'attitude' AS field, attitude AS value, count(*) AS n FROM notes GROUP BY attitude
      UNION ALL SELECT 'language', language, count(*) FROM notes GROUP BY language""",
)
def label_distribution(spark, sf):
    notes = V.notes(spark, sf, ("attitude", "language"))
    long = notes.unpivot([], ["attitude", "language"], "field", "value")
    return long.groupBy("field", "value").agg(F.count("*").alias("n"))


@register(
    "conversion_by_category",
    with_ctes(V.LEADS_SQL)
    + """SELECT lead_source, count(*) AS n,
      round(avg(CAST(converted AS DOUBLE)) * 100, 1) AS converted_pct
      FROM leads WHERE lead_source IS NOT NULL GROUP BY lead_source""",
)
def conversion_by_category(spark, sf):
    leads = V.raw_leads(spark, sf, ["lead_source", "converted"])
    return profile.positive_rate_by(leads, "lead_source")


@register(
    "missing_rates",
    with_ctes(V.LEADS_SQL)
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6)"
        " AS missing_rate FROM leads"
        for c in RAW_AUDIT
    )
    + ') ORDER BY missing_rate DESC, "column" LIMIT 15',
)
def missing_rates(spark, sf):
    return profile.missing_rates(V.raw_leads(spark, sf), RAW_AUDIT)


@register(
    "placeholder_audit",
    with_ctes(V.LEADS_SQL)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} = 'Select') AS n_select,
        count(*) FILTER (WHERE {c} IS NULL) AS n_null,
        round(avg(CASE WHEN {c} = 'Select' OR {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)
        AS pct_combined FROM leads"""
        for c in C.PLACEHOLDER_COLUMNS
    ),
)
def placeholder_audit(spark, sf):
    return profile.placeholder_audit(V.raw_leads(spark, sf, C.PLACEHOLDER_COLUMNS))


_ALL = " AND ".join(f"{c} IS NULL" for c in C.BLOCK_MISSING_COLUMNS)
_ANY = " OR ".join(f"{c} IS NULL" for c in C.BLOCK_MISSING_COLUMNS)


@register(
    "co_missingness",
    with_ctes(V.LEADS_SQL)
    + f"""SELECT count(*) AS n, count(*) FILTER (WHERE {_ALL}) AS n_all_null,
      count(*) FILTER (WHERE {_ANY}) AS n_any_null,
      round(CAST(count(*) FILTER (WHERE {_ALL}) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE {_ANY}), 0), 6) AS overlap FROM leads""",
)
def co_missingness(spark, sf):
    return profile.co_missingness(V.raw_leads(spark, sf, C.BLOCK_MISSING_COLUMNS))


_FLAGS = (*C.DEAD_FLAGS, *C.CHANNEL_FLAGS)


@register(
    "boolean_variance",
    with_ctes(V.LEADS_SQL)
    + "SELECT *, CASE WHEN n_yes = 0 THEN 'drop (dead)' ELSE 'merge into channel_diversity_count' END"
    + " AS decision FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} = 'Yes') AS n_yes,
        count(*) FILTER (WHERE {c} = 'No') AS n_no FROM leads"""
        for c in _FLAGS
    )
    + ")",
)
def boolean_variance(spark, sf):
    return profile.flag_variance(V.raw_leads(spark, sf, _FLAGS))


@register(
    "top_categories",
    with_ctes(V.LEADS_SQL)
    + """SELECT coalesce(specialization, '(missing)') AS specialization, count(*) AS n
      FROM leads GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def top_categories(spark, sf):
    return profile.top_categories(
        V.raw_leads(spark, sf, ["specialization"]), "specialization"
    )


@register(
    "note_failure_rate",
    with_ctes(V.NOTES_SQL)
    + """SELECT count(*) AS n, count(*) FILTER (WHERE length(text) = 0 OR text IS NULL) AS n_empty,
      round(avg(CASE WHEN length(text) = 0 OR text IS NULL THEN 1.0 ELSE 0.0 END), 6)
      AS failure_rate FROM notes""",
)
def note_failure_rate(spark, sf):
    return profile.note_failures(V.notes(spark, sf, ("text",)))


@register(
    "class_weights",
    with_ctes(V.LEADS_SQL)
    + """SELECT n_neg, n_pos,
      round(CASE WHEN n_pos > 0 THEN CAST(n_neg AS DOUBLE) / n_pos ELSE 1.0 END, 6) AS scale_pos_weight,
      round(CAST(n_neg + n_pos AS DOUBLE) / (2 * n_neg), 6) AS weight_neg,
      round(CAST(n_neg + n_pos AS DOUBLE) / (2 * n_pos), 6) AS weight_pos
      FROM (SELECT count(*) FILTER (WHERE converted = 0) AS n_neg,
                   count(*) FILTER (WHERE converted = 1) AS n_pos FROM leads)""",
)
def class_weights(spark, sf):
    return profile.class_weights(V.raw_leads(spark, sf, ["converted"]))


@register(
    "limit_ordered",
    with_ctes(V.LEADS_SQL)
    + "SELECT lead_id, lead_source, converted FROM leads ORDER BY lead_id LIMIT 100",
)
def limit_ordered(spark, sf):
    leads = V.raw_leads(spark, sf, ["lead_id", "lead_source", "converted"])
    return profile.limit_ordered(leads, "lead_id", 100)


LABELLED_SQL = """
labelled AS (
  SELECT notes.lead_id, attitude, converted FROM notes JOIN leads ON leads.lead_id = notes.lead_id
  WHERE length(text) > 0)"""
LABELLED = (V.LEADS_SQL, V.NOTES_SQL, LABELLED_SQL)


def labelled(spark, sf):
    leads = V.raw_leads(spark, sf, ["lead_id", "converted"])
    notes = V.notes(spark, sf, ("lead_id", "attitude", "text"))
    return notes.where(F.length("text") > 0).drop("text").join(leads, "lead_id")


_CROSSTAB = """SELECT attitude,
  count(*) FILTER (WHERE converted = 0) AS converted_0,
  count(*) FILTER (WHERE converted = 1) AS converted_1,
  round(count(*) FILTER (WHERE converted = 0) * 100.0 / CAST(count(*) AS DOUBLE), 2) AS converted_0_pct,
  round(count(*) FILTER (WHERE converted = 1) * 100.0 / CAST(count(*) AS DOUBLE), 2) AS converted_1_pct
  FROM labelled GROUP BY attitude"""


@register("leakage_crosstab", with_ctes(*LABELLED) + _CROSSTAB)
def leakage_crosstab(spark, sf):
    return contingency.crosstab_pct(labelled(spark, sf), "attitude")


@register(
    "crosstab_margins",
    with_ctes(V.NOTES_SQL)
    + """SELECT coalesce(attitude, 'All') AS attitude, coalesce(language, 'All') AS language,
      count(*) AS n FROM notes GROUP BY CUBE (attitude, language)""",
)
def crosstab_margins(spark, sf):
    notes = V.notes(spark, sf, ("attitude", "language"))
    return contingency.crosstab_margins(notes, "attitude", "language")


ASSOCIATION_SQL = """
cells AS (SELECT attitude, converted, CAST(count(*) AS DOUBLE) AS o FROM labelled GROUP BY ALL),
sums AS (
  SELECT sum(o) AS n, count(DISTINCT attitude) AS r, count(DISTINCT converted) AS k,
    sum(o * o / (rt * ct)) AS s, sum(o * ln(o / (rt * ct))) AS m
  FROM (SELECT *, sum(o) OVER (PARTITION BY attitude) AS rt,
               sum(o) OVER (PARTITION BY converted) AS ct FROM cells)),
association AS (
  SELECT CAST(n AS BIGINT) AS n, r, k, round(n * (s - 1), 6) AS chi_square,
    round(coalesce(CASE WHEN least(kc - 1, rc - 1) > 0
      THEN sqrt(greatest(0, s - 1 - (k - 1) * (r - 1) / (n - 1)) / least(kc - 1, rc - 1)) END, 0), 6) AS cramers_v,
    round(m / n + ln(n), 6) AS mutual_information
  FROM (SELECT *, r - (r - 1) * (r - 1) / (n - 1) AS rc, k - (k - 1) * (k - 1) / (n - 1) AS kc FROM sums))"""


def _association(columns):
    def run(spark, sf):
        found = contingency.association(labelled(spark, sf), "attitude", "converted")
        return found.select(*columns)

    return run


for _name in ("chi_square", "cramers_v", "mutual_information"):
    register(
        _name,
        with_ctes(*LABELLED, ASSOCIATION_SQL) + f"SELECT n, r, k, {_name} FROM association",
    )(_association(["n", "r", "k", _name]))


def suspects_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col, coalesce({c}, 'Missing') AS lev, converted AS y FROM leads"
        for c in C.POST_OUTCOME_COLUMNS
    )
    return f"""
levels AS (
  SELECT col, lev, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
  FROM ({long}) GROUP BY col, lev),
level_scores AS (
  SELECT col, CAST(pos AS DOUBLE) / (pos + neg) AS score, CAST(sum(pos) AS DOUBLE) AS pos,
    CAST(sum(neg) AS DOUBLE) AS neg FROM levels GROUP BY 1, 2),
suspect_auc AS (
  SELECT col, round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 4) AS auc
  FROM (SELECT *, sum(pos) OVER (PARTITION BY col ORDER BY score DESC
          ROWS UNBOUNDED PRECEDING) - pos AS above FROM level_scores) GROUP BY col),
suspects AS (
  SELECT suspect_auc.col AS "column", auc, n_unique, n_missing FROM suspect_auc JOIN (
    SELECT col, count(*) AS n_unique,
      CAST(coalesce(sum(CASE WHEN lev = 'Missing' THEN pos + neg END), 0) AS BIGINT) AS n_missing
    FROM levels GROUP BY col) f ON f.col = suspect_auc.col)"""


SUSPECT_INPUTS = (*C.POST_OUTCOME_COLUMNS, "converted")


@register("suspect_auc", with_ctes(V.LEADS_SQL, suspects_sql()) + "SELECT * FROM suspects")
def suspect_auc(spark, sf):
    return leakage.suspect_auc(V.raw_leads(spark, sf, SUSPECT_INPUTS))


def fold_sql(source: str, strata: str, k: int = 5) -> str:
    cases = " ".join(f"WHEN r <= floor(n * {i} / {k}.0) THEN {i - 1}" for i in range(1, k))
    return f"""
folded AS (
  SELECT * EXCLUDE (r, n), CASE {cases} ELSE {k - 1} END AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY {strata}) AS n, row_number() OVER (
          PARTITION BY {strata} ORDER BY {V.u_sql('lead_id', 'fold42')}, lead_id) AS r
        FROM {source}))"""


CV_SQL = (
    fold_sql("labelled", "converted")
    + """,
fold_cells AS (
  SELECT attitude AS lev, fold, CAST(sum(converted) AS DOUBLE) AS pos,
    CAST(sum(1 - converted) AS DOUBLE) AS neg FROM folded GROUP BY ALL),
fold_rates AS (
  SELECT fold, pos, neg, coalesce(po / nullif(po + no, 0), pr / nullif(pr + nr, 0)) AS score
  FROM (SELECT *, sum(pos) OVER (PARTITION BY lev) - pos AS po,
               sum(neg) OVER (PARTITION BY lev) - neg AS no,
               sum(pos) OVER () - sum(pos) OVER (PARTITION BY fold) AS pr,
               sum(neg) OVER () - sum(neg) OVER (PARTITION BY fold) AS nr FROM fold_cells)),
fold_scores AS (
  SELECT fold, score, sum(pos) AS pos, sum(neg) AS neg FROM fold_rates GROUP BY fold, score),
fold_auc AS (
  SELECT fold, sum(neg * (above + pos / 2)) / nullif(sum(pos) * sum(neg), 0) AS a
  FROM (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC
          ROWS UNBOUNDED PRECEDING) - pos AS above FROM fold_scores) GROUP BY fold),
cv AS (SELECT round(avg(a), 6) AS auc, count(a) AS n_folds FROM fold_auc)"""
)


@register("cv_category_auc", with_ctes(*LABELLED, CV_SQL) + "SELECT * FROM cv")
def cv_category_auc(spark, sf):
    return leakage.cv_category_auc(labelled(spark, sf), "attitude")


FLAGS_SQL = """SELECT 'attitude_auc' AS rule, 'attitude' AS subject,
      CASE WHEN auc > 0.85 THEN 'leakage' WHEN auc < 0.55 THEN 'weak' ELSE 'healthy' END AS level,
      auc AS value FROM cv
    UNION ALL SELECT 'cramers_v', 'attitude', CASE WHEN cramers_v > 0.4 THEN 'too_high'
      WHEN cramers_v < 0.2 THEN 'low' ELSE 'in_band' END, cramers_v FROM association
    UNION ALL SELECT 'one_sided_class', attitude, 'leakage', CAST(0 AS DOUBLE) FROM crosstab
      WHERE converted_0 = 0 OR converted_1 = 0
    UNION ALL SELECT 'suspect_column', "column", 'drop', auc FROM (
      SELECT * FROM suspects ORDER BY auc DESC, "column" LIMIT 1) WHERE auc > 0.9"""


@register(
    "leakage_flags",
    with_ctes(*LABELLED, ASSOCIATION_SQL, CV_SQL, suspects_sql(), f"crosstab AS ({_CROSSTAB})")
    + FLAGS_SQL,
)
def leakage_flags(spark, sf):
    rows = labelled(spark, sf)
    return leakage.leakage_flags(
        leakage.cv_category_auc(rows, "attitude"),
        contingency.association(rows, "attitude", "converted"),
        contingency.crosstab_pct(rows, "attitude"),
        leakage.suspect_auc(V.raw_leads(spark, sf, SUSPECT_INPUTS)),
    )


def _tidy_sql(section: str, key: str, source: str, metrics: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {key} AS key, '{m}' AS metric, CAST({m} AS DOUBLE) AS value"
        f" FROM {source}"
        for m in metrics
    )


@register(
    "leakage_report",
    with_ctes(
        *LABELLED,
        ASSOCIATION_SQL,
        CV_SQL,
        suspects_sql(),
        f"crosstab AS ({_CROSSTAB})",
        """balance AS (SELECT count(*) AS n,
          round(avg(CAST(converted AS DOUBLE)), 6) AS positive_rate FROM labelled)""",
        "attitudes AS (SELECT attitude, count(*) AS n FROM labelled GROUP BY attitude)",
        f"flags AS ({FLAGS_SQL})",
    )
    + " UNION ALL ".join(
        [
            "SELECT 'flag' AS section, subject AS key, rule || ':' || level AS metric,"
            " CAST(value AS DOUBLE) AS value FROM flags",
            _tidy_sql("balance", "'all'", "balance", ("n", "positive_rate")),
            _tidy_sql("attitude", "attitude", "attitudes", ("n",)),
            _tidy_sql(
                "association",
                "'all'",
                "association",
                ("chi_square", "cramers_v", "mutual_information"),
            ),
            _tidy_sql(
                "crosstab",
                "attitude",
                "crosstab",
                ("converted_0", "converted_1", "converted_0_pct", "converted_1_pct"),
            ),
            _tidy_sql("cv", "'all'", "cv", ("auc",)),
            _tidy_sql("suspect", '"column"', "suspects", ("auc", "n_unique", "n_missing")),
        ]
    ),
)
def leakage_report(spark, sf):
    return leakage.leakage_report(
        V.notes(spark, sf, ("lead_id", "attitude", "text")),
        V.raw_leads(spark, sf, ("lead_id", *SUSPECT_INPUTS)),
    )


# --- priority tables ---


@register(
    "sentiment_scores",
    with_ctes(*V.PREDICTIONS)
    + f"""SELECT predicted_attitude, count(*) AS n, round(avg({V.SCORE_CASE}), 6) AS mean_score
      FROM predictions GROUP BY predicted_attitude""",
)
def sentiment_scores(spark, sf):
    pred = V.predictions(spark, sf).select("predicted_attitude")
    scored = pred.withColumn("sentiment_score", attitude_score(F.col("predicted_attitude")))
    return profile.sentiment_score_stats(scored)


PRIORITY_COLUMNS = (
    "lead_id",
    "p_conversion",
    "predicted_attitude",
    "sentiment_score",
    "priority",
    "language",
)


@register(
    "priority_table",
    with_ctes(*V.PRIORITY)
    + "SELECT lead_id AS prospect_id, converted, p_conversion, true_attitude, predicted_attitude,"
    + " language, sentiment_score, priority FROM ranked",
)
def priority_table(spark, sf):
    return (
        V.priority_rows(spark, sf)
        .withColumnsRenamed({"lead_id": "prospect_id"})
        .select(
            "prospect_id",
            "converted",
            "p_conversion",
            "true_attitude",
            "predicted_attitude",
            "language",
            "sentiment_score",
            "priority",
        )
    )


@register(
    "priority_score",
    with_ctes(*V.SCORED)
    + f"""SELECT lead_id, predicted_attitude,
      CAST(0.3 AS DOUBLE) * p_conversion + CAST(0.7 AS DOUBLE) * {V.SCORE_CASE} AS priority
      FROM scored CROSS JOIN (VALUES ('positive_engagement'), ('objection'), ('neutral'), ('disengaged'))
      AS l(predicted_attitude)""",
)
def priority_score(spark, sf):
    """Every lead scored under every label with overridden weights."""
    labels = F.explode(F.array(*[F.lit(a) for a in C.ATTITUDES]))
    rows = V.scored(spark, sf).withColumn("predicted_attitude", labels)
    out = priority.checked_priority(rows, 0.3, 0.7)
    return out.select("lead_id", "predicted_attitude", "priority")


@register(
    "top_leads",
    with_ctes(*V.PRIORITY)
    + f"SELECT {', '.join(PRIORITY_COLUMNS)} FROM ranked ORDER BY priority DESC, lead_id LIMIT 10",
)
def top_leads(spark, sf):
    return priority.top_leads(V.priority_rows(spark, sf)).select(*PRIORITY_COLUMNS)


@register(
    "top_leads_min_priority",
    with_ctes(*V.PRIORITY)
    + f"SELECT {', '.join(PRIORITY_COLUMNS)}, (SELECT count(*) FROM ranked) AS total_available"
    + " FROM ranked WHERE priority >= 0.6 ORDER BY priority DESC, lead_id LIMIT 100",
)
def top_leads_min_priority(spark, sf):
    ranked = V.priority_rows(spark, sf)
    total = ranked.agg(F.count("*").alias("total_available"))
    top = priority.top_leads(ranked, 100, 0.6).select(*PRIORITY_COLUMNS)
    return top.crossJoin(F.broadcast(total))


@register(
    "top_list_any_length",
    with_ctes(*V.PRIORITY)
    + f"SELECT {', '.join(PRIORITY_COLUMNS)}, (SELECT count(*) FROM ranked) AS total_available"
    + " FROM (SELECT * FROM ranked ORDER BY priority DESC, lead_id LIMIT 5000)",
)
def top_list_any_length(spark, sf):
    ranked = V.priority_rows(spark, sf)
    return priority.top_list(ranked, 5000).select(*PRIORITY_COLUMNS, "total_available")


@register(
    "top_leads_stored",
    with_ctes(*V.PRIORITY)
    + f"SELECT {', '.join(PRIORITY_COLUMNS)}, (SELECT count(*) FROM ranked) AS total_available,"
    + " (SELECT count(*) FROM ranked WHERE priority >= 0.6) AS above_floor"
    + " FROM ranked WHERE priority >= 0.6 ORDER BY priority DESC, lead_id LIMIT 100",
)
def top_leads_stored(spark, sf):
    """The list out of the stored ranking, of which it reads few files."""
    path = work_dir(spark, "ranked")
    ranked_store.write_ranked(V.priority_rows(spark, sf), path)
    top = ranked_store.top_leads(spark, path, 100, 0.6)
    above = ranked_store.count_above(spark, path, 0.6)
    return top.select(*PRIORITY_COLUMNS, "total_available", F.lit(above).cast("long").alias("above_floor"))


COUNTED = ("lead_source", "last_activity", "city", "total_time_spent", "lead_id")


@register(
    "distinct_kept",
    with_ctes(*V.LEADS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, TRUE AS within_two_percent FROM leads"
        for c in COUNTED
    ),
)
def distinct_kept(spark, sf):
    """Distinct values exactly, and from sketches that four loads have left."""
    leads = V.raw_leads(spark, sf, COUNTED).withColumn("load", F.pmod(F.xxhash64("lead_id"), F.lit(4)))
    kept = written(sketches.distinct_sketches(leads, COUNTED, "load"), "sketches")
    long = leads.select(*[F.col(c).cast("string").alias(c) for c in COUNTED])
    exact = long.unpivot([], list(COUNTED), "column", "value").where("value is not null")
    exact = exact.distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))
    off = F.abs(F.col("n_estimate") - F.col("n_distinct")) <= 0.02 * F.col("n_distinct")
    return exact.join(sketches.distinct_counts(kept), "column").select(
        "column", "n_distinct", off.alias("within_two_percent")
    )


@register(
    "top_list_empty",
    with_ctes(*V.PRIORITY)
    + "SELECT (SELECT count(*) FROM ranked) AS total_available, CAST(NULL AS BIGINT) AS lead_id",
)
def top_list_empty(spark, sf):
    """No lead asked for: the total is still there."""
    return priority.top_list(V.priority_rows(spark, sf), 0).select("total_available", "lead_id")


@register(
    "validate_scores",
    with_ctes(*V.PRIORITY)
    + """SELECT lead_id, CASE WHEN p IS NULL OR p < 0 OR p > 1 THEN 'p_conversion_out_of_range'
        WHEN a IS NULL OR a NOT IN ('positive_engagement', 'objection', 'neutral', 'disengaged')
        THEN 'unknown_attitude' END AS reject_reason
      FROM (SELECT lead_id, CASE lead_id % 10 WHEN 0 THEN p_conversion + 1 WHEN 1 THEN -p_conversion
              WHEN 2 THEN NULL ELSE p_conversion END AS p,
            CASE lead_id % 7 WHEN 0 THEN 'very_positive' WHEN 1 THEN NULL
              ELSE predicted_attitude END AS a FROM ranked)""",
)
def validate_scores(spark, sf):
    """Good and spoiled rows side by side; the tag tells them apart."""
    k, p = F.col("lead_id"), F.col("p_conversion")
    spoiled = V.priority_rows(spark, sf).select(
        "lead_id",
        F.when(k % 10 == 0, p + 1)
        .when(k % 10 == 1, -p)
        .when(k % 10 == 2, F.lit(float("nan")))
        .otherwise(p)
        .alias("p_conversion"),
        F.when(k % 7 == 0, "very_positive")
        .when(k % 7 == 1, F.lit(None))
        .otherwise(F.col("predicted_attitude"))
        .alias("predicted_attitude"),
    )
    return priority.quarantine(spoiled).select("lead_id", "reject_reason")


@register(
    "join_overlap",
    with_ctes(*V.LEADS, *V.PREDICTIONS)
    + """SELECT count(*) AS n_predictions, count(l.lead_id) AS n_matched,
      round(CAST(count(l.lead_id) AS DOUBLE) / count(*), 6) AS overlap,
      CAST(count(l.lead_id) AS DOUBLE) / count(*) >= 0.95 AS ok
      FROM (SELECT DISTINCT lead_id FROM predictions) p
      LEFT JOIN (SELECT DISTINCT lead_id FROM leads) l ON l.lead_id = p.lead_id""",
)
def join_overlap(spark, sf):
    return priority.join_overlap(
        V.raw_leads(spark, sf, ["lead_id"]), V.predictions(spark, sf)
    )


@register(
    "semi_cached_leads",
    with_ctes(*V.LEADS, *V.PREDICTIONS)
    + "SELECT lead_id, lead_source FROM leads WHERE lead_id IN (SELECT lead_id FROM predictions)",
)
def semi_cached_leads(spark, sf):
    leads = V.raw_leads(spark, sf, ["lead_id", "lead_source"])
    return leads.join(V.predictions(spark, sf), "lead_id", "left_semi")


@register(
    "id_set_diff",
    """SELECT count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS n_both,
      count(*) FILTER (WHERE r IS NULL) AS n_only_left, count(*) FILTER (WHERE l IS NULL) AS n_only_right,
      count(*) FILTER (WHERE r IS NULL OR l IS NULL) = 0 AS same
      FROM (SELECT DISTINCT doc_id AS l FROM documents) a
      FULL JOIN (SELECT DISTINCT doc_id AS r FROM labels) b ON l = r""",
)
def id_set_diff(spark, sf):
    return profile.id_set_difference(
        V.table(spark, sf, "documents"), V.table(spark, sf, "labels"), "doc_id"
    )


@register(
    "priority_histogram",
    with_ctes(*V.PRIORITY)
    + """SELECT CAST(b AS INTEGER) AS bin, round(b / 30.0, 6) AS lower, count(priority) AS n
      FROM range(30) g(b) LEFT JOIN ranked ON least(floor(priority * 30), 29) = b GROUP BY b""",
)
def priority_histogram(spark, sf):
    return profile.histogram(V.priority_rows(spark, sf), "priority")


_QUARTILES = ", ".join(
    f"round(quantile_cont(priority, {q}), 9) AS {name}"
    for name, q in (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1))
)


@register(
    "priority_quartiles",
    with_ctes(*V.PRIORITY)
    + f"SELECT predicted_attitude, {_QUARTILES} FROM ranked GROUP BY predicted_attitude",
)
def priority_quartiles(spark, sf):
    return profile.five_numbers(
        V.priority_rows(spark, sf), "priority", "predicted_attitude"
    )


@register(
    "segment_distribution",
    with_ctes(*V.PRIORITY)
    + """SELECT predicted_attitude, count(*) AS n, round(avg(priority), 6) AS priority_mean,
      round(quantile_cont(priority, 0.5), 9) AS priority_median,
      round(stddev_samp(priority), 6) AS priority_std,
      round(avg(CAST(converted AS DOUBLE)), 6) AS converted_rate
      FROM ranked GROUP BY predicted_attitude""",
)
def segment_distribution(spark, sf):
    return profile.segment_stats(V.priority_rows(spark, sf))


@register(
    "priority_summary",
    with_ctes(*V.PRIORITY)
    + """SELECT count(*) AS n, round(avg(priority), 6) AS mean, round(stddev_samp(priority), 6) AS std,
      round(min(priority), 6) AS min, round(max(priority), 6) AS max,
      round(quantile_cont(priority, 0.5), 9) AS median FROM ranked""",
)
def priority_summary(spark, sf):
    return profile.priority_summary(V.priority_rows(spark, sf))


@register(
    "argmax_lead",
    with_ctes(*V.SCORED)
    + "SELECT * FROM scored ORDER BY p_conversion DESC, lead_id LIMIT 1",
)
def argmax_lead(spark, sf):
    return argmax_row(V.scored(spark, sf), "p_conversion")


@register(
    "token_totals",
    with_ctes(*V.PREDICTIONS)
    + """SELECT lead_id, CASE WHEN prompt_tokens IS NOT NULL
      THEN prompt_tokens + coalesce(completion_tokens, 0) END AS tokens_total,
      round(latency_ms, 6) AS latency_ms FROM predictions""",
)
def token_totals(spark, sf):
    return V.predictions(spark, sf).select(
        "lead_id",
        token_total(F.col("prompt_tokens"), F.col("completion_tokens")).alias("tokens_total"),
        r6("latency_ms").alias("latency_ms"),
    )
