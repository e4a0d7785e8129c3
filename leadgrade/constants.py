"""CRM column names, label maps, thresholds.

Everything in this module is data the results depend on. Nothing here is
computed from a table.
"""

from __future__ import annotations

DEFAULT_SEED = 42

# --- Fixed values: CRM export header -> column name used inside the engine ---
RAW_COLUMNS: dict[str, str] = {
    "Prospect ID": "lead_id",
    "Lead Number": "lead_number",
    "Lead Origin": "lead_origin",
    "Lead Source": "lead_source",
    "Do Not Email": "do_not_email",
    "Do Not Call": "do_not_call",
    "Converted": "converted",
    "TotalVisits": "total_visits",
    "Total Time Spent on Website": "total_time_spent",
    "Page Views Per Visit": "page_views_per_visit",
    "Last Activity": "last_activity",
    "Country": "country",
    "Specialization": "specialization",
    "How did you hear about X Education": "heard_about",
    "What is your current occupation": "occupation",
    "What matters most to you in choosing a course": "matters_most",
    "Search": "search",
    "Magazine": "magazine",
    "Newspaper Article": "newspaper_article",
    "X Education Forums": "education_forums",
    "Newspaper": "newspaper",
    "Digital Advertisement": "digital_advertisement",
    "Through Recommendations": "through_recommendations",
    "Receive More Updates About Our Courses": "receive_updates",
    "Tags": "tags",
    "Lead Quality": "lead_quality",
    "Update me on Supply Chain Content": "supply_chain_updates",
    "Get updates on DM Content": "dm_updates",
    "Lead Profile": "lead_profile",
    "City": "city",
    "Asymmetrique Activity Index": "activity_index",
    "Asymmetrique Profile Index": "profile_index",
    "Asymmetrique Activity Score": "activity_score",
    "Asymmetrique Profile Score": "profile_score",
    "I agree to pay the amount through cheque": "pay_by_cheque",
    "A free copy of Mastering The Interview": "free_copy",
    "Last Notable Activity": "last_notable_activity",
}

# --- Fixed values: column groups ---
ID_COLUMNS = ("lead_id", "lead_number")
POST_OUTCOME_COLUMNS = ("tags", "lead_quality", "last_notable_activity")
DEAD_FLAGS = (
    "magazine",
    "receive_updates",
    "supply_chain_updates",
    "dm_updates",
    "pay_by_cheque",
)
CHANNEL_FLAGS = (
    "newspaper_article",
    "education_forums",
    "newspaper",
    "digital_advertisement",
    "search",
)
CLIPPED_NUMERIC = (
    "total_visits",
    "total_time_spent",
    "page_views_per_visit",
    "activity_score",
    "profile_score",
)
RATIO_NUMERIC = ("total_time_per_visit", "channel_diversity_count")
CATEGORICAL = (
    "lead_origin",
    "lead_source",
    "last_activity",
    "specialization",
    "occupation",
    "matters_most",
    "heard_about",
    "lead_profile",
    "city",
    "activity_index",
    "profile_index",
)
PLACEHOLDER_COLUMNS = ("specialization", "heard_about", "lead_profile", "city")
YES_NO_FLAGS = (
    "do_not_email",
    "do_not_call",
    "free_copy",
    "through_recommendations",
)
ACTIVITY_FLAGS = ("is_high_intent_activity", "is_negative_activity")
BINARIES = (*YES_NO_FLAGS, *ACTIVITY_FLAGS)
BLOCK_MISSING_COLUMNS = (
    "activity_score",
    "profile_score",
    "activity_index",
    "profile_index",
)

REQUIRED_RAW = (
    *CLIPPED_NUMERIC,
    *CATEGORICAL,
    "country",
    *YES_NO_FLAGS,
    *CHANNEL_FLAGS,
)
DERIVED_ORDER = (
    *CLIPPED_NUMERIC,
    *RATIO_NUMERIC,
    *CATEGORICAL,
    "country_is_india",
    *BINARIES,
)

# --- Fixed values: activity sets, placeholders, encoding thresholds ---
HIGH_INTENT_ACTIVITIES = (
    "SMS Sent",
    "Had a Phone Conversation",
    "Approached upfront",
    "Form Submitted on Website",
)
NEGATIVE_ACTIVITIES = ("Email Bounced", "Unsubscribed", "Unreachable")
SELECT_PLACEHOLDER = "Select"
UNKNOWN_CATEGORY = "Unknown"
CLIP_QUANTILE = 0.95
MIN_CATEGORY_COUNT = 20
INFREQUENT_SUFFIX = "infrequent"

# --- Fixed values: tokens a CSV reader of CRM exports takes as missing ---
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- Fixed values: attitude labels, their scores, priority weights ---
ATTITUDE_SCORES: dict[str, float] = {
    "positive_engagement": 1.0,
    "objection": 0.65,
    "neutral": 0.40,
    "disengaged": 0.10,
}
ATTITUDES = tuple(ATTITUDE_SCORES)
FALLBACK_ATTITUDE = "neutral"
WEIGHT_CONVERSION = 0.6
WEIGHT_SENTIMENT = 0.4
WEIGHT_TOLERANCE = 1e-6

# --- Fixed values: engagement score ---
ACTIVITY_BONUS: dict[str, float] = {
    "SMS Sent": 1.5,
    "Had a Phone Conversation": 1.5,
    "Email Link Clicked": 0.3,
    "Email Opened": 0.3,
    "Page Visited on Website": 0.2,
    "Olark Chat Conversation": 0.0,
    "Form Submitted on Website": 0.6,
    "Approached upfront": 0.6,
    "Converted to Lead": 0.0,
    "Email Bounced": -1.0,
    "Unsubscribed": -1.0,
    "Unreachable": -1.0,
    "Email Marked Spam": -1.0,
}
ENGAGEMENT_WEIGHTS = {
    "total_time_spent": 0.50,
    "total_visits": 0.10,
    "page_views_per_visit": 0.05,
    "activity_bonus": 0.35,
}
ENGAGEMENT_NOISE = 0.30
FRICTION_CUT_ENGAGED = -0.5
FRICTION_CUT_DISENGAGED = 0.25
TIME_BUCKETS = ((60.0, "very_low"), (300.0, "low"), (900.0, "medium"))
LANGUAGE_MIX = {"tr": 0.50, "en": 0.20, "mix": 0.30}
NOT_GIVEN = "Belirtilmemiş"

# --- Fixed values: evaluation settings ---
DECISION_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
GAIN_FRACTIONS = (0.10, 0.20, 0.30)
CAPTURE_SIZES = (10, 25, 50, 100)
WEIGHT_GRID = (0.4, 0.5, 0.6, 0.7, 0.8)
CALIBRATION_BINS = 10
BOOTSTRAP_DRAWS = 1000
CONFIDENCE_ALPHA = 0.05
NOTE_MIN_CHARS = 1
NOTE_MAX_CHARS = 4000
JOIN_OVERLAP_FLOOR = 0.95

# --- Fixed values: leakage rules ---
AUC_TOO_HIGH = 0.85
AUC_TOO_WEAK = 0.55
CRAMERS_V_BAND = (0.20, 0.40)
SUSPECT_AUC_LIMIT = 0.90

# --- Fixed values: transient outcomes of a note-classification call ---
TRANSIENT_STATUSES = (
    "config_error",
    "openrouter_rate_limit",
    "openrouter_unavailable",
)
HARD_STATUSES = ("permanent", "malformed")
