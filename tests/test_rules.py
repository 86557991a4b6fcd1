"""Hand-computed cases of the rules, one per edge that matters."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millwatch.functions import scores as S
from millwatch.operators import (
    alerts as I, cleaning as B, drift as H, equipment as J, evaluation as V, features as C, health as G, metrics as M,
    registry as R, sessions, stream_rules as D, voting as E,
)
from millwatch.operators.failure import failure_probability, maintenance_recommendations

T0 = dt.datetime(2024, 1, 1)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def readings(spark, rows):
    """Rows of (minute, equipment, sensor, value)."""
    data = [(i, minutes(m), e, s, v) for i, (m, e, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "reading_id long, timestamp timestamp, equipment_id string, sensor_type string, value double")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def one(df, name):
    return df.first()[name]


def test_cold_start_flags_large_values_and_skip_does_not(spark):
    df = readings(spark, [(i, "A", "rpm", 5.0) for i in range(9)])
    assert D.zscore_anomaly(df).filter("is_anomaly").count() == 9
    assert D.zscore_anomaly(df, cold_start="skip").filter("is_anomaly").count() == 0


def test_constant_values_have_no_zscore(spark):
    df = readings(spark, [(i, "A", "rpm", 5.0) for i in range(12)])
    last = D.zscore_anomaly(df).orderBy(F.desc("reading_id")).first()
    assert (last["z_score"], last["is_anomaly"], last["anomaly_confidence"]) == (0.0, False, 0.0)


def test_zscore_of_the_window_includes_the_value_itself(spark):
    values = [1.0, 2.0] * 6 + [50.0]
    df = readings(spark, [(i, "A", "rpm", v) for i, v in enumerate(values)])
    last = D.zscore_anomaly(df).orderBy(F.desc("reading_id")).first()
    mean = sum(values) / 13
    spread = (sum((v - mean) ** 2 for v in values) / 13) ** 0.5
    assert last["z_score"] == pytest.approx((50 - mean) / spread)
    assert last["anomaly_confidence"] == 1.0


def test_incomplete_readings_are_left_out(spark):
    df = readings(spark, [(0, "A", "rpm", None), (1, None, "rpm", 1.0), (2, "", "rpm", 1.0), (3, "A", "", 1.0), (4, "A", "rpm", 0.0)])
    assert [r["reading_id"] for r in D.zscore_anomaly(df).collect()] == [4]


def test_health_takes_the_last_value_of_each_type(spark):
    df = readings(spark, [(0, "A", "vibration", 0.9), (5, "A", "vibration", 0.2), (3, "A", "temperature", 50.0), (4, "A", "other", 7.0)])
    rows = {r["reading_id"]: r for r in D.multisensor_health(df).collect()}
    assert rows[0]["sensor_health"] == pytest.approx(0.8)
    assert rows[3]["sensor_health"] == 0.5
    assert rows[0]["overall_health"] == pytest.approx((0.4 * 0.8 + 0.3 * 0.5) / 0.7)


def test_health_without_known_type_is_neutral(spark):
    rows = D.multisensor_health(readings(spark, [(0, "A", "other", 7.0)])).first()
    assert (rows["overall_health"], rows["health_status"]) == (0.5, "fair")


def test_range_ends_of_health(spark):
    df = spark.createDataFrame([(1500.0,), (2000.0,), (1750.0,), (None,)], "v double")
    got = [r[0] for r in df.select(S.range_health(F.col("v"), 1500.0, 2000.0)).collect()]
    assert got == [1.0, 0.0, 0.5, None]


@pytest.mark.parametrize("score,status,urgency,target", [
    (0.8, "excellent", "low", "low"), (0.6, "good", "medium", "low"), (0.4, "fair", "high", "medium"),
    (0.3, "poor", "high", "medium"), (0.2, "poor", "critical", "high"), (0.19, "critical", "critical", "high")])
def test_band_edges(spark, score, status, urgency, target):
    c = F.lit(score)
    row = spark.range(1).select(S.health_status(c), S.score_urgency(c), S.target_urgency(c)).first()
    assert tuple(row) == (status, urgency, target)


def test_alert_severities_and_both_alerts_of_one_reading(spark):
    df = spark.createDataFrame([
        (minutes(0), "A", True, 0.85, 0.25), (minutes(1), "B", True, 0.95, 0.2), (minutes(2), "C", True, 0.79, 0.31)],
        "timestamp timestamp, equipment_id string, is_anomaly boolean, anomaly_confidence double, overall_health double")
    got = {(r["equipment_id"], r["alert_type"]): r["severity"] for r in D.stream_alerts(df).collect()}
    assert got == {("A", "anomaly"): "medium", ("A", "health"): "high", ("B", "anomaly"): "high", ("B", "health"): "critical"}
    message = D.stream_alerts(df).filter("alert_type = 'health' AND equipment_id = 'A'").first()["message"]
    assert message == "Poor health detected in A (score: 0.25)"


def test_missing_value_is_no_threshold_anomaly(spark):
    df = readings(spark, [(0, "A", "vibration", None), (1, "A", "vibration", 1.5), (2, "A", "unknown", 1.5)])
    got = [(r["is_anomaly"], r["health_score"]) for r in D.threshold_health(df).orderBy("reading_id").collect()]
    assert got == [(False, 0.5), (True, 0.0), (True, 0.5)]


def test_alert_message_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, T0)],
                               "equipment_id string, sensor_type string, value double, health_score double, timestamp timestamp")
    text = df.select(D.alert_message("x")).first()[0]
    assert text == ('{"equipment_id":"unknown","sensor_type":"unknown","value":0.0,"health_score":0.0,'
                    '"alert_type":"x","timestamp":"2024-01-01T00:00:00"}')


def _alerts(spark, seconds, rule="r"):
    rows = [(f"a{i}", rule, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "alert_id string, rule string, timestamp timestamp")


def test_cooldown_edges(spark):
    kept = I.cooldown(_alerts(spark, [0, 299, 300, 301, 599.999999, 600, 5000]))
    assert sorted(r["alert_id"] for r in kept.collect()) == ["a0", "a2", "a5", "a6"]


def test_cooldown_equals_a_plain_walk(spark):
    seconds = sorted({(i * i * 37 + i * 101) % 60000 for i in range(900)})
    alerts = _alerts(spark, seconds, "p").unionByName(_alerts(spark, [s * 3 % 50000 for s in seconds], "q"))
    expected = []
    for rule in ("p", "q"):
        last = None
        for row in sorted((r for r in alerts.collect() if r["rule"] == rule), key=lambda r: (r["timestamp"], r["alert_id"])):
            if last is None or (row["timestamp"] - last).total_seconds() >= 300:
                last = row["timestamp"]
                expected.append((rule, row["alert_id"]))
    got = [(r["rule"], r["alert_id"]) for r in I.cooldown(alerts).collect()]
    assert sorted(got) == sorted(expected)


def test_disabled_rules_and_missing_fields_never_fire(spark):
    df = spark.createDataFrame([(1, T0, "A", 0.1)], "row long, timestamp timestamp, equipment_id string, health_score double")
    assert [r["rule"] for r in I.rule_alerts(df, "row").collect()] == ["critical_health"]
    off = [I.AlertRule("x", "health_score < 1", "info", "d", "s", enabled=False), I.AlertRule("y", "health_score < 1", "info", "d", "s")]
    assert [r["rule"] for r in I.rule_alerts(df, "row", off).collect()] == ["y"]
    with pytest.raises(ValueError):
        I.AlertRule("x", "true", "loud", "d", "s")


def test_actions_on_unknown_alerts_have_no_effect(spark):
    alerts = _alerts(spark, [0, 1]).withColumns({"status": F.lit("active"), "severity": F.lit("info")})
    actions = spark.createDataFrame([
        ("a0", "acknowledged", "me", minutes(1), 1), ("a0", "resolved", "me", minutes(2), 2), ("zz", "resolved", "me", minutes(2), 3)],
        "alert_id string, action string, actor string, at timestamp, action_id long")
    got = {r["alert_id"]: (r["status"], r["acknowledged_by"]) for r in I.apply_actions(alerts, actions).collect()}
    assert got == {"a0": ("resolved", "me"), "a1": ("active", None)}
    events = [r["event"] for r in I.lifecycle_events(alerts, actions).collect()]
    assert sorted(events) == ["alert.acknowledged", "alert.created", "alert.created", "alert.resolved"]
    stats = I.alert_statistics(I.apply_actions(alerts, actions)).first()
    assert (stats["total_alerts"], stats["active_alerts"], stats["info_alerts"], stats["critical_alerts"]) == (2, 1, 2, 0)


def test_page_edges(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    first, last = I.page(df, ["k"], 2, 0).collect(), I.page(df, ["k"], 2, 4).collect()
    assert [(r["k"], r["total_count"], r["has_next"], r["has_previous"]) for r in first] == [(0, 5, True, False), (1, 5, True, False)]
    assert [(r["k"], r["has_next"], r["has_previous"]) for r in last] == [(4, False, True)]


def test_sessions_split_only_beyond_the_gap(spark):
    df = readings(spark, [(0, "A", "rpm", 1.0), (60, "A", "rpm", 1.0), (121, "A", "rpm", 1.0), (1439, "A", "rpm", 1.0), (1441, "A", "rpm", 1.0)])
    got = [(r["session_start"], r["readings"]) for r in sessions.operating_sessions(df, 3600).orderBy("session_start").collect()]
    assert got == [(minutes(0), 2), (minutes(121), 1), (minutes(1439), 2)]


def test_whole_days_are_floored(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-02 01:00:00' a, timestamp_ntz'2024-01-01 02:00:00' b").select(
        S.whole_days(F.col("a"), F.col("b")), S.whole_days(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (0, -1)


def test_rolling_windows_of_other_sizes_and_gaps(spark):
    values = [3.0, None, 4.0, 8.0, 1.0, 7.0, None, 2.0, 9.0]
    df = readings(spark, [(i, "A", "rpm", v) for i, v in enumerate(values)])
    got = C.rolling_features(df, D.READING_ORDER, ["value"], [2, 3, 6]).orderBy("reading_id").toPandas()
    series = got["value"]
    for w in (2, 3, 6):
        for name, fn in (("mean", "mean"), ("std", "std"), ("max", "max"), ("min", "min")):
            expected = getattr(series.rolling(w, min_periods=1), fn)()
            assert got[f"value_{name}_{w}"].tolist() == pytest.approx(expected.tolist(), nan_ok=True), (w, name)


def test_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "c double, v double")
    for method in ("standard", "minmax", "robust"):
        assert [r["c"] for r in C.scale(df, method).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        C.scale(df, "other")


def test_targets_without_measures_and_with_overall_health(spark):
    bare = C.health_target(spark.createDataFrame([("a",)], "equipment_id string")).first()
    assert (bare["health_score"], bare["maintenance_urgency"]) == (0.5, "medium")
    known = C.health_target(spark.createDataFrame([(0.1,), (None,)], "overall_health double")).collect()
    assert [r["maintenance_urgency"] for r in known] == ["high", "low"]


def test_model_data_fills_gaps(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (3.0, 2.0)], "x double, y double")
    assert sorted((r["x"], r["y"]) for r in C.model_data(df, ["y"]).collect()) == [(1.0, 0.0), (2.0, 1.0), (3.0, 2.0)]


def test_sparse_columns_go_only_above_the_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, 1.0, None), (4, 1.0, None)], "a int, half double, sparse string")
    assert B.drop_sparse(df).columns == ["a", "half"]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "s string")
    assert sorted(r["s"] for r in B.impute_mode(df).collect()) == ["a", "a", "a", "b", "b"]


def test_drift_recommendations(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    still = H.drift_summary(H.feature_drift(ref, ref)).first()
    assert (still["has_drift"], still["drift_score"], still["recommendation"]) == (False, 0.0, "No retraining needed")
    moved = H.drift_summary(H.feature_drift(ref, ref.select((F.col("x") + 1).alias("x")))).first()
    assert moved["drift_score"] == pytest.approx(0.5) and moved["recommendation"] == "Immediate retraining required"


def test_retrain_needs_a_recent_record(spark):
    log = spark.createDataFrame([("m", 1, minutes(0), 0.5), ("n", 2, minutes(0) - dt.timedelta(days=30), 0.1)],
                                "model string, run_id long, timestamp timestamp, accuracy double")
    log = log.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))

    def asked(at):
        return {r["model"]: r["should_retrain"] for r in H.should_retrain(log, at, ["accuracy"]).collect()}

    assert asked("2024-01-08 23:59:59") == {"m": True, "n": False}
    assert asked("2024-01-09 00:00:00") == {"m": False, "n": False}


def test_votes_and_ties(spark):
    df = spark.createDataFrame([(1, -1, 0.1, 0.9), (1, 1, 0.2, 0.2)], "a int, b int, sa double, sb double")
    p, s = {"a": F.col("a"), "b": F.col("b")}, {"a": F.col("sa"), "b": F.col("sb")}
    for method in ("majority", "average"):
        assert [r["ensemble_prediction"] for r in E.anomaly_vote(df, p, s, method).collect()] == [-1, 1]
    with pytest.raises(ValueError):
        E.anomaly_vote(df, p, s, "loud")
    soft = E.failure_vote(df, s).collect()
    assert [r["will_fail"] for r in soft] == [0, 0]


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, p double")
    assert one(V.auc(df, "y", "p"), "auc") == pytest.approx(0.875)


def test_split_shares(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {(r["y"], r["split"]): r["count"] for r in V.stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}
    dealt = V.stratified_split(df.repartition(7), "y", ["id"])
    assert dealt.exceptAll(V.stratified_split(df, "y", ["id"])).count() == 0


def test_failure_probability_and_advice(spark):
    df = spark.createDataFrame([(0.8,), (0.9,), (1.2,)], "y double")
    assert [r[0] for r in df.select(failure_probability(F.col("y"))).collect()] == pytest.approx([0.0, 0.5, 1.0])
    p = spark.createDataFrame([(0.5,), (0.6,), (0.71,), (0.95,)], "failure_probability double")
    got = [(r["urgency"], r["estimated_failure_time"]) for r in maintenance_recommendations(p).collect()]
    assert got == [("medium", "Within 1 month"), ("high", "Within 1 week"), ("high", "Within 24 hours")]


def test_schedule_order_and_horizon(spark):
    df = spark.createDataFrame([(0.9,), (0.5,), (0.1,), (0.3,)], "health_score double")
    rows = G.maintenance_schedule(df, "2024-01-31").collect()
    assert [(r["urgency"], str(r["recommended_date"])) for r in rows] == [
        ("critical", "2024-02-01"), ("high", "2024-02-01"), ("medium", "2024-02-07"), ("low", "2024-03-01")]
    assert G.maintenance_schedule(df, "2024-01-31", 7).count() == 3
    assert rows[0]["description"] == "Health score: 0.10 - critical condition"


def test_wide_health_without_known_columns_is_neutral(spark):
    assert spark.range(1).select(G.wide_sensor_health({"id": "sound"})).first()[0] == 0.5


def test_component_metrics_ignore_unknown_names(spark):
    df = spark.createDataFrame([("data_ingestion", "errors", 1.0, T0, 1), ("data_ingestion", "errors", 2.0, minutes(1), 2),
                                ("data_ingestion", "processing_time", 5.0, T0, 3), ("data_ingestion", "processing_time", 4.0, minutes(2), 4),
                                ("data_ingestion", "nope", 9.0, T0, 5), ("nope", "errors", 9.0, T0, 6)],
                               "component string, metric string, value double, timestamp timestamp, metric_id long")
    assert {(r["metric"], r["value"]) for r in M.component_metrics(df).collect()} == {("errors", 3.0), ("processing_time", 4.0)}


def test_history_pages_are_bounded_and_whole(spark):
    dim = spark.createDataFrame([("A", "n", "t", "l", "s", "operational"), ("B", "n", "t", "l", "s", "operational")],
                                "equipment_id string, name string, type string, location string, site string, status string")
    log = spark.createDataFrame([("A", minutes(i), "x", i) for i in range(25)], "equipment_id string, date timestamp, type string, order_key long")
    rows = J.equipment_detail(dim, log, ["date", "order_key"], page_size=10, hot_rows=8).orderBy("equipment_id", "history_page").collect()
    assert [(r["equipment_id"], r["history_page"], len(r["maintenance_history"] or [])) for r in rows] == [("A", 0, 10), ("A", 1, 10), ("A", 2, 5), ("B", 0, 0)]


def test_registry_promotion(spark):
    log = spark.createDataFrame([(1, "m", 1, "Production", T0), (2, "m", 2, "Staging", minutes(1))],
                                "run_id long, model string, version int, stage string, timestamp timestamp")
    after = R.promote(log, "m", 2, "Production", "2024-01-02 00:00:00", 3)
    assert [(r["version"], r["uri"]) for r in R.production_models(after).collect()] == [(2, "models:/m/2")]


def test_array_requests(spark):
    df = spark.createDataFrame([("q", [0.45, 0.52, 0.48]), ("w", [0.1, 5.0])], "request_id string, sensor_readings array<double>")
    got = {r["request_id"]: (r["is_anomaly"], r["anomaly_score"]) for r in J.array_anomaly(df).collect()}
    assert got == {"q": (False, 0.52), "w": (True, 5.0)}


def test_messages_round_as_the_exact_number_does(spark):
    """0.245 is stored a little below the tie, 0.145 a little above; 0.125 is a tie and goes to the even neighbour."""
    import random

    draw = random.Random(5)
    values = [0.245, 0.145, 0.105, 0.125, 0.375, 0.295, 0.0, 1.0, 0.999, 0.07, 0.29, -0.245, 12345.675, 1e20, *[round(draw.random(), 3) for _ in range(500)]]
    found = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.fixed(F.col("v")).alias("two"), S.fixed(F.col("v"), 6).alias("six")).collect()
    assert [(r["two"], r["six"]) for r in found] == [(f"{r['v']:.2f}", f"{r['v']:.6f}") for r in found]
    rows = spark.createDataFrame([("e", False, 0.0, 0.245)], "equipment_id string, is_anomaly boolean, anomaly_confidence double, overall_health double")
    alert = D.stream_alerts(rows.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))).first()
    assert alert["message"] == "Poor health detected in e (score: 0.24)"
