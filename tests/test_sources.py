import json

import pytest
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.sources import readers, sinks, state_store
from leadgrade.sources.schema import PREDICTION_SCHEMA, MissingColumnsError
from tests.conftest import raw_row

HEADERS = {alias: name for name, alias in C.RAW_COLUMNS.items()}


def write_csv(path, rows, order=None):
    names = order or list(C.RAW_COLUMNS.values())
    lines = [",".join(f'"{HEADERS[n]}"' for n in names)]
    for r in rows:
        cells = ("" if r[n] is None else str(r[n]).replace('"', '""') for n in names)
        lines.append(",".join(f'"{c}"' for c in cells))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "leads.csv"
    write_csv(
        path,
        [
            raw_row(total_visits=None, city="NaN", tags="N/A", lead_source='say "hi", ok'),
            raw_row(total_visits="nan", country=" India ", activity_score="12", specialization="a\nb"),
        ],
    )
    one, two = readers.read_leads_csv(spark, str(path), line_breaks=True).collect()
    assert one["total_visits"] is None and one["city"] is None and one["tags"] is None
    assert one["lead_source"] == 'say "hi", ok'
    assert two["total_visits"] is None and two["country"] == " India "
    assert two["activity_score"] == 12.0 and two["specialization"] == "a\nb"
    assert one["lead_number"] == 660737 and one["converted"] == 0


def test_line_break_without_the_option_fails(spark, tmp_path):
    path = tmp_path / "leads.csv"
    write_csv(path, [raw_row(specialization="a\nb")])
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_leads_csv(spark, str(path)).collect()


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "leads.csv"
    write_csv(path, [raw_row()], list(reversed(C.RAW_COLUMNS.values())))
    row = readers.read_leads_csv(spark, str(path)).first()
    assert row["lead_source"] == "Google" and row["total_visits"] == 5.0


def test_bad_number_fails(spark, tmp_path):
    path = tmp_path / "leads.csv"
    write_csv(path, [raw_row(total_visits="many")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_leads_csv(spark, str(path)).collect()


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_leads_csv(spark, str(tmp_path / "absent.csv"))


def request(drop=(), **changes):
    lead = {HEADERS[k]: v for k, v in raw_row(**changes).items() if k not in drop}
    return json.dumps({"lead": {**lead, "Unknown Key": 1}, "interaction_text": "hi"})


def test_json_records(spark, tmp_path):
    path = tmp_path / "requests.json"
    path.write_text("\n".join([request(country=None), request(drop=("city", "converted")), "oops"]))
    good, cut, broken = readers.read_lead_json(spark, str(path)).collect()
    assert good["missing_keys"] == [] and good["total_visits"] == 5.0
    assert good["country"] is None and good["interaction_text"] == "hi"
    assert cut["missing_keys"] == ["City"]
    assert len(broken["missing_keys"]) == len(C.REQUIRED_RAW)


def prediction(i, label="neutral"):
    return (f"l{i}", "en", "neutral", label, "m", 1, 2, 3.0)


def predictions(spark, *rows):
    fields = PREDICTION_SCHEMA.fields[:-1]
    return spark.createDataFrame(list(rows), type(PREDICTION_SCHEMA)(fields))


def test_append_never_repeats_and_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "pred")
    sinks.append_predictions(spark, predictions(spark, prediction(1), prediction(1)), path)
    sinks.append_predictions(spark, predictions(spark, prediction(1, "objection"), prediction(2)), path)
    got = {r["lead_id"]: r for r in readers.read_predictions(spark, path).collect()}
    assert set(got) == {"l1", "l2"} and got["l1"]["predicted_attitude"] == "neutral"
    assert got["l1"]["timestamp_utc"] is not None
    sinks.append_predictions(spark, predictions(spark, prediction(9)), path, force_refresh=True)
    assert [r["lead_id"] for r in readers.read_predictions(spark, path).collect()] == ["l9"]


def test_stored_predictions_are_checked(spark, tmp_path):
    path = str(tmp_path / "pred")
    predictions(spark, prediction(1)).drop("language").write.parquet(path)
    with pytest.raises(MissingColumnsError, match="language"):
        sinks.stored_predictions(spark, path)
    assert sinks.stored_predictions(spark, str(tmp_path / "none")).count() == 0


def test_pair_sink_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([("a", ' x "y", z ')], "lead_id string, text string")
    sinks.write_both(df, str(tmp_path / "notes"))
    csv = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "notes.csv"))
    assert csv.collect() == spark.read.parquet(str(tmp_path / "notes.parquet")).collect()


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("auc", 0.5, [1, 2])], "metric string, value double, bins array<int>")
    sinks.write_report(df, str(tmp_path / "r"))
    assert readers.read_report(spark, str(tmp_path / "r"), df.schema).collect() == df.collect()


def test_versions_are_attached(spark):
    df = state_store.with_versions(spark.range(2), {"model_kind": "boosted_trees", "w": 0.6})
    assert {tuple(r[1:]) for r in df.collect()} == {("boosted_trees", 0.6)}


def test_work_dir_follows_the_session(spark, monkeypatch):
    from leadgrade.plans.sizing import work_dir

    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(root)
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_written_reads_back(spark):
    from leadgrade.plans.sizing import written

    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = written(df, "t")
    assert sorted(back.collect()) == sorted(df.collect())
    assert "FileScan" in back._jdf.queryExecution().executedPlan().toString()
