"""Lead-shaped views over the given star-schema tables, with their SQL twins.

A customer is a lead, orders before the cut date are its behaviour, later orders
are its outcome, events feed the block-missing scores, documents are notes. Flags
and placeholders follow from keys, so every null path occurs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade.functions.hashing import hash_uniform
from leadgrade.functions.scoring import literal_map, logistic
from leadgrade.operators import derive, priority

CUT_DATE = "2000-01-01"
PRIORITY_ACTIVITY = {
    "1-URGENT": "SMS Sent",
    "2-HIGH": "Email Opened",
    "3-MEDIUM": "Page Visited on Website",
    "4-NOT SPECIFIED": "Email Bounced",
    "5-LOW": "Had a Phone Conversation",
}
FROM_LINES = {"page_views_per_visit"}
FROM_EVENTS = {"activity_score", "profile_score", "activity_index", "profile_index"}
FROM_NATION = {"country", "specialization"}
FROM_ORDERS = {
    "total_visits",
    "total_time_spent",
    "page_views_per_visit",
    "last_activity",
    "converted",
    "tags",
    "lead_quality",
    "last_notable_activity",
}


# Declared schemas: a scan then needs no footer read before it is planned.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders_by_lead(spark: SparkSession, sf_dir: str, with_lines: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if with_lines:
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.count("*").alias("n_lines"))
        )
        orders = orders.join(lines, "o_orderkey", "left")
    else:
        orders = orders.withColumn("n_lines", F.lit(0))
    pre = F.col("o_orderdate") < F.lit(CUT_DATE).cast("timestamp_ntz")
    when = F.struct("o_orderdate", "o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return orders.groupBy(F.col("o_custkey").alias("lead_id")).agg(
        F.count_if(pre).alias("n_pre"),
        F.count_if(~pre).alias("n_post"),
        F.sum(F.when(pre, cents)).alias("cents"),
        F.sum(F.when(pre, F.coalesce("n_lines", F.lit(0)))).alias("n_lines"),
        F.max_by(F.when(pre, F.col("o_orderpriority")), F.when(pre, when)).alias(
            "pre_priority"
        ),
        F.max_by("o_orderpriority", when).alias("any_priority"),
        F.max_by(
            F.when(~pre, F.col("o_orderstatus")), F.when(~pre, when)
        ).alias("post_status"),
    )


def _events_by_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.round(F.col("value") * 100).cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("lead_id"))
        .agg(F.count("*").alias("n_events"), F.sum(value).alias("event_cents"))
    )


_ACTIVITY_EXPR = "CASE {} " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_ACTIVITY.items()
) + " END"

# Raw lead column -> Spark expression over customer, nation and the two aggregates.
RAW_EXPRESSIONS = {
    "lead_id": "lead_id",
    "lead_number": "lead_id + 600000",
    "lead_origin": """CASE WHEN c_acctbal < 0 THEN 'API' WHEN c_acctbal < 4000
        THEN 'Landing Page Submission' WHEN c_acctbal < 9900 THEN 'Lead Add Form'
        ELSE 'Lead Import' END""",
    "lead_source": "c_mktsegment",
    "do_not_email": """CASE lead_id % 9 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes '
        WHEN 2 THEN NULL ELSE 'No' END""",
    "do_not_call": "if(lead_id % 50 = 0, 'YES', 'No')",
    "converted": "if(coalesce(n_post, 0) >= 3, 1, 0)",
    "total_visits": "if(lead_id % 40 = 3, 0D, cast(nullif(n_pre, 0) AS double))",
    "total_time_spent": "coalesce(cents, 0) / 100000D",
    "page_views_per_visit": "n_lines / nullif(n_pre, 0)",
    "last_activity": _ACTIVITY_EXPR.format("pre_priority"),
    "country": """CASE WHEN c_nationkey % 3 = 0 THEN 'India' WHEN c_nationkey = 1
        THEN ' India ' WHEN c_nationkey = 2 THEN 'india'
        WHEN c_nationkey != 4 THEN n_name END""",
    "specialization": """CASE lead_id % 7 WHEN 0 THEN 'Select' WHEN 1 THEN NULL
        WHEN 2 THEN concat('Niche ', lead_id % 89) ELSE n_name END""",
    "heard_about": """CASE lead_id % 4 WHEN 0 THEN 'Online Search'
        WHEN 1 THEN 'Word Of Mouth' ELSE 'Select' END""",
    "occupation": """CASE lead_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Student'
        WHEN 2 THEN 'Working Professional' ELSE 'Unemployed' END""",
    "matters_most": """CASE lead_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Flexibility'
        ELSE 'Better Career Prospects' END""",
    "search": "if(lead_id % 101 = 0, 'Yes', 'No')",
    "magazine": "'No'",
    "newspaper_article": "if(lead_id % 211 = 0, 'Yes', 'No')",
    "education_forums": "if(lead_id % 307 = 0, 'Yes', 'No')",
    "newspaper": "if(lead_id % 401 = 0, 'Yes', 'No')",
    "digital_advertisement": "if(lead_id % 151 = 0, 'Yes', 'No')",
    "through_recommendations": """CASE lead_id % 97 WHEN 0 THEN 'Yes' WHEN 1 THEN NULL
        ELSE 'No' END""",
    "receive_updates": "'No'",
    "tags": """CASE post_status WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Will revert'
        WHEN 'P' THEN 'Ringing' END""",
    "lead_quality": """CASE WHEN coalesce(n_post, 0) >= 4 THEN 'High in Relevance'
        WHEN coalesce(n_post, 0) >= 2 THEN 'Might be' END""",
    "supply_chain_updates": "'No'",
    "dm_updates": "'No'",
    "lead_profile": """CASE lead_id % 5 WHEN 0 THEN 'Potential Lead' WHEN 1 THEN NULL
        WHEN 2 THEN 'Other Leads' ELSE 'Select' END""",
    "city": """CASE lead_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Select'
        WHEN 2 THEN 'Thane & Outskirts' ELSE 'Mumbai' END""",
    "activity_index": """CASE WHEN n_events >= 75 THEN '01.High' WHEN n_events >= 60
        THEN '02.Medium' WHEN n_events IS NOT NULL THEN '03.Low' END""",
    "profile_index": """CASE WHEN event_cents >= 400000 THEN '01.High'
        WHEN event_cents >= 300000 THEN '02.Medium' WHEN n_events IS NOT NULL
        THEN '03.Low' END""",
    "activity_score": "cast(n_events AS double)",
    "profile_score": "event_cents / 1000D",
    "pay_by_cheque": "'No'",
    "free_copy": "if(lead_id % 3 = 0, 'Yes', 'No')",
    "last_notable_activity": _ACTIVITY_EXPR.format("any_priority"),
}


def raw_leads(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Raw leads; tables no wanted column comes from are not read at all."""
    names = set(columns) if columns else set(RAW_EXPRESSIONS)
    leads = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "lead_id")
    if names & FROM_ORDERS:
        by_lead = _orders_by_lead(spark, sf_dir, bool(names & FROM_LINES))
        leads = leads.join(by_lead, "lead_id", "left")
    if names & FROM_EVENTS:
        leads = leads.join(_events_by_lead(spark, sf_dir), "lead_id", "left")
    if names & FROM_NATION:
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name"
        )
        leads = leads.join(nation, "c_nationkey", "left")
    return leads.selectExpr(
        *[f"{expr} AS {name}" for name, expr in RAW_EXPRESSIONS.items() if name in names]
    )


_ACTIVITY_SQL = "CASE {} " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_ACTIVITY.items()
) + " END"

LEADS_SQL = f"""
lines_per_order AS (
  SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
orders_pre AS (
  SELECT o_custkey, count(*) AS n_pre,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
    CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_lines,
    arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS pre_priority
  FROM orders LEFT JOIN lines_per_order ON l_orderkey = o_orderkey
  WHERE o_orderdate < TIMESTAMP '{CUT_DATE}' GROUP BY o_custkey),
orders_post AS (
  SELECT o_custkey, count(*) AS n_post,
    arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS post_status
  FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT_DATE}' GROUP BY o_custkey),
orders_any AS (
  SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS any_priority
  FROM orders GROUP BY o_custkey),
events_by_user AS (
  SELECT user_id, count(*) AS n_events,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS event_cents
  FROM events GROUP BY user_id),
leads AS (
  SELECT c_custkey AS lead_id, c_custkey + 600000 AS lead_number,
    CASE WHEN c_acctbal < 0 THEN 'API' WHEN c_acctbal < 4000 THEN 'Landing Page Submission'
         WHEN c_acctbal < 9900 THEN 'Lead Add Form' ELSE 'Lead Import' END AS lead_origin,
    c_mktsegment AS lead_source,
    CASE c_custkey % 9 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes ' WHEN 2 THEN NULL ELSE 'No' END AS do_not_email,
    CASE WHEN c_custkey % 50 = 0 THEN 'YES' ELSE 'No' END AS do_not_call,
    CASE WHEN coalesce(n_post, 0) >= 3 THEN 1 ELSE 0 END AS converted,
    CASE WHEN c_custkey % 40 = 3 THEN 0.0 ELSE CAST(n_pre AS DOUBLE) END AS total_visits,
    CAST(coalesce(cents, 0) AS DOUBLE) / 100000.0 AS total_time_spent,
    CAST(n_lines AS DOUBLE) / CAST(n_pre AS DOUBLE) AS page_views_per_visit,
    {_ACTIVITY_SQL.format('pre_priority')} AS last_activity,
    CASE WHEN c_nationkey % 3 = 0 THEN 'India' WHEN c_nationkey = 1 THEN ' India '
         WHEN c_nationkey = 2 THEN 'india' WHEN c_nationkey <> 4 THEN n_name END AS country,
    CASE WHEN c_custkey % 7 = 0 THEN 'Select' WHEN c_custkey % 7 = 1 THEN NULL
         WHEN c_custkey % 7 = 2 THEN 'Niche ' || CAST(c_custkey % 89 AS VARCHAR)
         ELSE n_name END AS specialization,
    CASE c_custkey % 4 WHEN 0 THEN 'Online Search' WHEN 1 THEN 'Word Of Mouth' ELSE 'Select' END AS heard_about,
    CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Student' WHEN 2 THEN 'Working Professional'
         ELSE 'Unemployed' END AS occupation,
    CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Flexibility' ELSE 'Better Career Prospects' END AS matters_most,
    CASE WHEN c_custkey % 101 = 0 THEN 'Yes' ELSE 'No' END AS search,
    'No' AS magazine,
    CASE WHEN c_custkey % 211 = 0 THEN 'Yes' ELSE 'No' END AS newspaper_article,
    CASE WHEN c_custkey % 307 = 0 THEN 'Yes' ELSE 'No' END AS education_forums,
    CASE WHEN c_custkey % 401 = 0 THEN 'Yes' ELSE 'No' END AS newspaper,
    CASE WHEN c_custkey % 151 = 0 THEN 'Yes' ELSE 'No' END AS digital_advertisement,
    CASE c_custkey % 97 WHEN 0 THEN 'Yes' WHEN 1 THEN NULL ELSE 'No' END AS through_recommendations,
    'No' AS receive_updates,
    CASE post_status WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Will revert' WHEN 'P' THEN 'Ringing' END AS tags,
    CASE WHEN coalesce(n_post, 0) >= 4 THEN 'High in Relevance'
         WHEN coalesce(n_post, 0) >= 2 THEN 'Might be' END AS lead_quality,
    'No' AS supply_chain_updates, 'No' AS dm_updates,
    CASE c_custkey % 5 WHEN 0 THEN 'Potential Lead' WHEN 1 THEN NULL WHEN 2 THEN 'Other Leads'
         ELSE 'Select' END AS lead_profile,
    CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Select' WHEN 2 THEN 'Thane & Outskirts'
         ELSE 'Mumbai' END AS city,
    CASE WHEN n_events >= 75 THEN '01.High' WHEN n_events >= 60 THEN '02.Medium'
         WHEN n_events IS NOT NULL THEN '03.Low' END AS activity_index,
    CASE WHEN event_cents >= 400000 THEN '01.High' WHEN event_cents >= 300000 THEN '02.Medium'
         WHEN n_events IS NOT NULL THEN '03.Low' END AS profile_index,
    CAST(n_events AS DOUBLE) AS activity_score,
    CAST(event_cents AS DOUBLE) / 1000.0 AS profile_score,
    'No' AS pay_by_cheque,
    CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS free_copy,
    {_ACTIVITY_SQL.format('any_priority')} AS last_notable_activity
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN orders_pre ON orders_pre.o_custkey = c_custkey
  LEFT JOIN orders_post ON orders_post.o_custkey = c_custkey
  LEFT JOIN orders_any ON orders_any.o_custkey = c_custkey
  LEFT JOIN events_by_user ON user_id = c_custkey)"""


def notes(spark: SparkSession, sf_dir: str, columns: Iterable[str] = ()) -> DataFrame:
    """Notes with an attitude that follows from their length."""
    n = F.col("n_chars")
    attitude = (
        F.when(n < 500, "disengaged")
        .when(n < 1000, "neutral")
        .when(n < 2000, "objection")
        .otherwise("positive_engagement")
    )
    out = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("lead_id"),
        attitude.alias("attitude"),
        F.col("lang").alias("language"),
        "text",
        "n_chars",
    )
    return out.select(*columns) if columns else out


NOTES_SQL = """
notes AS (
  SELECT doc_id AS lead_id,
    CASE WHEN n_chars < 500 THEN 'disengaged' WHEN n_chars < 1000 THEN 'neutral'
         WHEN n_chars < 2000 THEN 'objection' ELSE 'positive_engagement' END AS attitude,
    lang AS language, text, n_chars
  FROM documents)"""

MODEL_NAME = "vendor/Note-Labeller-2.0:free"
_NEXT = {
    "disengaged": "neutral",
    "neutral": "positive_engagement",
    "objection": "positive_engagement",
    "positive_engagement": "objection",
}


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted attitudes: right for most notes, the next label for the others."""
    base = notes(spark, sf_dir, ("lead_id", "language", "attitude", "n_chars"))
    wrong = hash_uniform(F.col("lead_id"), "pred") < 0.12
    confused = F.try_element_at(literal_map(_NEXT), F.col("attitude"))
    return base.select(
        "lead_id",
        "language",
        F.col("attitude").alias("true_attitude"),
        F.when(wrong, confused).otherwise(F.col("attitude")).alias("predicted_attitude"),
        F.lit(MODEL_NAME).alias("model_name"),
        F.when(F.col("lead_id") % 10 != 9, F.floor(F.col("n_chars") / 4) + 500)
        .cast("int")
        .alias("prompt_tokens"),
        F.when(F.col("lead_id") % 15 != 4, F.lit(12)).cast("int").alias(
            "completion_tokens"
        ),
        (F.col("n_chars") / 10.0).alias("latency_ms"),
    )


U_SQL = (
    "(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"
    " / 4294967296.0)"
)


def u_sql(key: str, seed: int | str) -> str:
    """SQL twin of ``hash_uniform``."""
    return "CAST(" + U_SQL.format(key=key, seed=seed) + " AS DOUBLE)"


PREDICTIONS_SQL = f"""
predictions AS (
  SELECT lead_id, language, attitude AS true_attitude,
    CASE WHEN {u_sql('lead_id', 'pred')} < 0.12 THEN CASE attitude
      {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _NEXT.items())} END
      ELSE attitude END AS predicted_attitude,
    '{MODEL_NAME}' AS model_name,
    CASE WHEN lead_id % 10 <> 9 THEN CAST(floor(n_chars / 4.0) AS INTEGER) + 500 END AS prompt_tokens,
    CASE WHEN lead_id % 15 <> 4 THEN 12 END AS completion_tokens,
    CAST(n_chars AS DOUBLE) / 10.0 AS latency_ms
  FROM notes)"""

# A fixed scoring formula stands in for a trained model where SQL must agree.
SCORE_INPUTS = (
    "lead_id",
    "total_visits",
    "total_time_spent",
    "last_activity",
    "do_not_email",
    "free_copy",
    "converted",
)


def formula_score(columns: list[str]) -> Column:
    """Probability by the fixed formula from raw lead columns, to six places."""
    flags = derive.flag_columns(columns)
    z = (
        F.lit(-1.5)
        + F.lit(0.12) * F.coalesce("total_visits", F.lit(0.0))
        + F.lit(0.0004) * F.col("total_time_spent")
        + F.lit(0.3) * flags["is_high_intent_activity"]
        - F.lit(0.5) * flags["is_negative_activity"]
        - F.lit(0.2) * flags["do_not_email"]
        + F.lit(0.1) * flags["free_copy"]
    )
    return F.round(logistic(z), 6)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lead_id, converted, p_conversion) by the fixed formula."""
    leads = raw_leads(spark, sf_dir, SCORE_INPUTS)
    p = formula_score(leads.columns)
    return leads.select("lead_id", "converted", p.alias("p_conversion"))


SCORED_SQL = """
scored AS (
  SELECT lead_id, converted, round(1.0 / (1.0 + exp(-(CAST(-1.5 AS DOUBLE)
    + CAST(0.12 AS DOUBLE) * coalesce(total_visits, 0.0)
    + CAST(0.0004 AS DOUBLE) * total_time_spent
    + CAST(0.3 AS DOUBLE) * (CASE WHEN last_activity IN ('SMS Sent', 'Had a Phone Conversation') THEN 1 ELSE 0 END)
    - CAST(0.5 AS DOUBLE) * (CASE WHEN last_activity = 'Email Bounced' THEN 1 ELSE 0 END)
    - CAST(0.2 AS DOUBLE) * (CASE WHEN lower(trim(do_not_email)) = 'yes' THEN 1 ELSE 0 END)
    + CAST(0.1 AS DOUBLE) * (CASE WHEN free_copy = 'Yes' THEN 1 ELSE 0 END)))), 6) AS p_conversion
  FROM leads)"""


def priority_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored leads joined with their predicted attitude and priority."""
    pred = predictions(spark, sf_dir).select(
        "lead_id", "language", "true_attitude", "predicted_attitude"
    )
    return priority.priority_table(scored(spark, sf_dir), pred)


SCORE_CASE = (
    "CASE predicted_attitude WHEN 'positive_engagement' THEN CAST(1.0 AS DOUBLE) "
    "WHEN 'objection' THEN CAST(0.65 AS DOUBLE) WHEN 'neutral' THEN CAST(0.4 AS DOUBLE) "
    "WHEN 'disengaged' THEN CAST(0.1 AS DOUBLE) END"
)
PRIORITY_SQL = f"""
ranked AS (
  SELECT scored.lead_id, converted, language, true_attitude, predicted_attitude,
    p_conversion, {SCORE_CASE} AS sentiment_score,
    round(CAST(0.6 AS DOUBLE) * p_conversion + CAST(0.4 AS DOUBLE) * {SCORE_CASE}, 6) AS priority
  FROM scored JOIN predictions ON predictions.lead_id = scored.lead_id)"""


def split_sql(name: str, source: str, strata: str, seed: str, cuts: list[tuple[str, str]], other: str, column: str = "split") -> str:
    """SQL twin of an exact stratified cut: (part, cumulative quota) pairs."""
    cases = " ".join(f"WHEN r <= {quota} THEN '{part}'" for part, quota in cuts)
    return f"""
{name} AS (
  SELECT * EXCLUDE (r, n_stratum, n_total), CASE {cases} ELSE '{other}' END AS {column}
  FROM (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {u_sql('lead_id', seed)}, lead_id) AS r,
          count(*) OVER (PARTITION BY {strata}) AS n_stratum, count(*) OVER () AS n_total
        FROM {source}))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


LEADS = (LEADS_SQL,)
SCORED = (LEADS_SQL, SCORED_SQL)
NOTES = (NOTES_SQL,)
PREDICTIONS = (NOTES_SQL, PREDICTIONS_SQL)
PRIORITY = (LEADS_SQL, SCORED_SQL, NOTES_SQL, PREDICTIONS_SQL, PRIORITY_SQL)
