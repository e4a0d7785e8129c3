from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("leadgrade-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def raw_row(**changes):
    """A raw lead with every column, in engine names."""
    row = {
        "lead_id": "lead-1",
        "lead_number": 660737,
        "lead_origin": "API",
        "lead_source": "Google",
        "do_not_email": "No",
        "do_not_call": "No",
        "converted": 0,
        "total_visits": 5.0,
        "total_time_spent": 500.0,
        "page_views_per_visit": 2.5,
        "last_activity": "Email Opened",
        "country": "India",
        "specialization": "Finance",
        "heard_about": "Select",
        "occupation": "Unemployed",
        "matters_most": "Better Career Prospects",
        "search": "No",
        "magazine": "No",
        "newspaper_article": "No",
        "education_forums": "No",
        "newspaper": "No",
        "digital_advertisement": "No",
        "through_recommendations": "No",
        "receive_updates": "No",
        "tags": "Ringing",
        "lead_quality": "Might be",
        "supply_chain_updates": "No",
        "dm_updates": "No",
        "lead_profile": "Select",
        "city": "Mumbai",
        "activity_index": "02.Medium",
        "profile_index": "02.Medium",
        "activity_score": 15.0,
        "profile_score": 15.0,
        "pay_by_cheque": "No",
        "free_copy": "No",
        "last_notable_activity": "Modified",
    }
    return {**row, **changes}


@pytest.fixture
def leads_of(spark):
    from leadgrade.sources.schema import RAW_LEAD_SCHEMA

    def make(*rows):
        names = RAW_LEAD_SCHEMA.fieldNames()
        data = [tuple(raw_row(**r)[n] for n in names) for r in rows]
        return spark.createDataFrame(data, RAW_LEAD_SCHEMA)

    return make
