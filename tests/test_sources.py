from __future__ import annotations

import base64
import datetime as dt
import json

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from millwatch import fixtures as X
from millwatch.sources import lake as L, models as O, readings as A, versions as U

GOOD = {"timestamp": "2024-01-01T10:00:00Z", "equipment_id": "A", "sensor_type": "rpm", "value": 1800.5, "unit": "1/min",
        "location": "hall", "metadata": {"load": 85.5, "note": "text", "rpm": 1800}}


def lines(*records):
    return "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n"


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


def test_json_lines_lose_only_the_bad_line(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.json").write_text(lines(GOOD, "", "{broken", without("unit"), {**GOOD, "timestamp": "2024-01-01T12:00:00+02:00"}))
    rows = A.read_json_lines(spark, str(tmp_path)).collect()
    assert [r["timestamp"] for r in rows] == [dt.datetime(2024, 1, 1, 10)] * 2
    assert rows[0]["metadata"] == {"load": 85.5, "rpm": 1800.0}
    assert json.loads(rows[0]["metadata_json"])["note"] == "text"


def test_missing_metadata_is_empty(spark, tmp_path):
    (tmp_path / "a.json").write_text(lines(without("metadata")))
    assert A.read_json_lines(spark, str(tmp_path)).first()["metadata"] == {}


def test_batch_files(spark, tmp_path):
    good, bad, csv = tmp_path / "a.json", tmp_path / "b.json", tmp_path / "c.csv"
    good.write_text(lines(GOOD, GOOD))
    bad.write_text(lines(GOOD, "{broken"))
    csv.write_text('timestamp,equipment_id,sensor_type,value,unit,location,metadata\n'
                   '2024-01-01 10:00:00,A,rpm,1800.5,1/min,hall,"{""load"": 85.5}"\n')
    assert A.read_batch(spark, str(good)).count() == 2
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        A.read_batch(spark, str(bad)).collect()
    row = A.read_batch(spark, str(csv)).first()
    assert (row["value"], row["metadata"], row["timestamp"]) == (1800.5, {"load": 85.5}, dt.datetime(2024, 1, 1, 10))
    with pytest.raises(ValueError):
        A.read_batch(spark, "x.xml")


def test_validation_report_names_the_fields(spark):
    df = spark.createDataFrame([(json.dumps(r),) for r in (GOOD, without("value"), without("unit"))] + [("{broken",)], "value string")
    report = {r["measure"]: r["records"] for r in A.ingest_report(A.parse_readings(df, drop_bad=False)).collect()}
    assert (report["processed_count"], report["failed_count"], report["value"], report["unit"], report["location"]) == (1, 3, 2, 2, 1)


def test_envelopes_that_cannot_be_decoded_are_dropped(spark):
    good = base64.b64encode(json.dumps(GOOD).encode()).decode()
    df = spark.createDataFrame([(good,), ("***",), (base64.b64encode(b"no json").decode(),), (None,)], "data string")
    assert [r["equipment_id"] for r in A.decode_envelopes(df).collect()] == ["A"]


def test_publish_and_read_back(spark, folder):
    df = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    typed = A.parse_readings(df)
    A.write_json_lines(typed, f"{folder}/lines")
    assert A.read_json_lines(spark, f"{folder}/lines").select("value", "metadata").collect() == typed.select("value", "metadata").collect()
    A.publish(typed.withColumn("equipment_id", F.lit(None).cast("string")), "json", path=f"{folder}/topic")
    assert spark.read.json(f"{folder}/topic").first()["key"] == "default"


def test_unknown_time_is_stamped(spark):
    df = A.parse_readings(spark.createDataFrame([(json.dumps(GOOD),)], "value string")).withColumn("timestamp", F.lit(None).cast("timestamp"))
    sent = json.loads(A.publish_envelope(df).first()["value"])
    assert sent["timestamp"].startswith(str(dt.datetime.now(dt.timezone.utc).year))


def test_lake_reads_only_the_days_asked_for(spark, sf, folder):
    raw = L.store_raw(X.readings(spark, sf), folder)
    day = L.read_range(spark, raw, "2024-01-10 00:00:00", "2024-01-10 23:59:59", ["reading_id", "timestamp"])
    expected = X.readings(spark, sf).filter("timestamp >= timestamp_ntz'2024-01-10' AND timestamp < timestamp_ntz'2024-01-11'")
    assert day.count() == expected.count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    files = {f.split("day=")[1].split("/")[0] for f in [r[0] for r in day.select(F.input_file_name()).distinct().collect()]}
    assert files == {"10"}
    found = L.object_summary(spark, raw).first()
    assert (str(found["start_date"]), str(found["end_date"])) == ("2024-01-01", "2024-01-30")
    assert found["total_objects"] == L.list_objects(spark, raw).count() and found["total_size_bytes"] > 0


def test_objects_tell_their_equipment(spark, tmp_path):
    for key in ("year=2024/month=01/day=02/equipment_A7_0001.json", "x/equipment_B_9.json", "x/equipment_id=C-1/part-0", "x/equipment_A7_0002.json", "x/other.json"):
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_text("{}")
    found = L.object_summary(spark, str(tmp_path)).first()
    assert found["equipment_ids"] == ["A7", "B", "C-1"] and found["total_objects"] == 5 and str(found["start_date"]) == "2024-01-02"


def test_processed_data_by_type(spark, sf, folder):
    path = L.store_processed(X.readings(spark, sf), folder, "cleaned")
    L.store_processed(X.readings(spark, sf).limit(5), folder, "features")
    counts = {r["type"]: r["count"] for r in spark.read.parquet(path).groupBy("type").count().collect()}
    assert counts == {"cleaned": X.readings(spark, sf).count(), "features": 5}


def test_training_data_leaves_out_absent_labels(spark, sf):
    df = X.readings(spark, sf).withColumn("will_fail", F.lit(0))
    assert L.training_data(df, "2024-01-01", "2024-02-01", ["value"]).columns == ["value", "will_fail"]


@pytest.mark.parametrize("format,compress", [("parquet", True), ("json", True), ("csv", True), ("csv", False)])
def test_formats(spark, folder, format, compress):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    L.save(df, f"{folder}/t", format, compress)
    assert sorted(L.load(spark, f"{folder}/t", format, df.schema).collect()) == sorted(df.collect())
    names = [r["key"] for r in L.list_objects(spark, f"{folder}/t").collect()]
    assert any(n.endswith(".gz") for n in names) == (compress and format != "parquet")
    with pytest.raises(ValueError):
        L.save(df, f"{folder}/u", "pickle")


def test_dataset_versions(spark, folder):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    U.add_version(one, folder, 1, "first", "2024-01-01 00:00:00")
    U.add_version(two, folder, 2, "second", "2024-01-02 00:00:00")
    assert [(r["version"], r["message"], r["records"]) for r in U.history(spark, folder).collect()] == [(2, "second", 3), (1, "first", 3)]
    changes = U.difference(U.checkout(spark, folder, 1), U.checkout(spark, folder, 2))
    assert sorted((r["k"], r["change"], r["copies"]) for r in changes.collect()) == [(2, "removed", 1), (3, "added", 1)]


def test_models_by_version(spark, folder):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    for version, columns in ((1, ["a"]), (2, ["a", "b"])):
        model = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="x")]).fit(df)
        O.save_model(spark, model, folder, "m", version, {"auc": 0.5 + version / 10})
    size = lambda m: m.transform(df).first()["x"].size
    assert size(O.load_model(spark, folder, "m")) == 2 and size(O.load_model(spark, folder, "m", 1)) == 1
    assert {r["version"]: r["metrics"]["auc"] for r in O.list_models(spark, folder).collect()} == {1: 0.6, 2: 0.7}
    with pytest.raises(ValueError):
        O.load_model(spark, folder, "other")
    O.batch_transform(O.load_model(spark, folder, "m"), df, f"{folder}/scored", ["a", "b"])
    assert spark.read.parquet(f"{folder}/scored").count() == 1
