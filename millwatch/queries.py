"""The registered queries: name -> function of (spark, table directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwatch import fixtures as X
from millwatch.functions import scores as S
from millwatch.operators import (
    alerts as I, anomaly as N, cleaning as B, drift as H, ensembles as Z, equipment as J, evaluation as V, failure as P, features as C, forecast as Y, health as G,
    knn as K, learners as Q, metrics as M, registry as R, sessions, stream_rules as D, voting as E,
)
from millwatch.plans import storage
from millwatch.plans.slices import running
from millwatch.schemas import MEASURES
from millwatch.sources import lake as L, readings as A, versions as U
from millwatch.streaming import jobs as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r(c, places: int = 4, nudge: float = 0.0):
    """Round for comparison across engines, in plain double arithmetic (``round`` goes by decimals)."""
    unit = 10.0 ** places
    c = F.col(c) if isinstance(c, str) else c
    return F.floor((c + nudge if nudge else c) * unit + 0.5) / unit


# Means of values with few decimals often end in an exact 5; this offset keeps them off
# the rounding tie, where two engines may differ by one unit in the last place.
NUDGE = 1.23e-6


def rn(c, places: int = 4):
    return r(c, places, NUDGE)


def flag(c):
    return (F.col(c) if isinstance(c, str) else c).cast("int")


# --- stream rules -----------------------------------------------------------------


@query
def stream_alerts(spark, d):
    a = D.flagged_alerts(X.readings(spark, d))
    return a.select("data.reading_id", "timestamp", "equipment_id", "alert_type", "severity", "message",
                    r("data.z_score").alias("z_score"))


@query
def zscore_anomaly(spark, d):
    z = D.zscore_anomaly(X.readings(spark, d))
    return z.select("reading_id", "equipment_id", "sensor_type", r("z_score").alias("z_score"),
                    flag("is_anomaly").alias("is_anomaly"), r("anomaly_confidence").alias("anomaly_confidence"))


@query
def multisensor_health(spark, d):
    h = D.multisensor_health(X.readings(spark, d))
    return h.select("reading_id", "equipment_id", "sensor_type", r("sensor_health").alias("sensor_health"),
                    r("overall_health", 8).alias("overall_health"), "health_status")


@query
def threshold_health(spark, d):
    h = D.threshold_health(X.dirty_readings(spark, d))
    return h.select("reading_id", "sensor_type", flag("is_anomaly").alias("is_anomaly"),
                    r("health_score", 6).alias("health_score"), "health_status", "maintenance_urgency")


@query
def fixed_threshold_anomaly(spark, d):
    a = D.fixed_threshold_anomaly(X.readings(spark, d))
    return a.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("anomalies_detected"), F.max("anomaly_confidence").alias("confidence"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query
def fixed_threshold_alerts(spark, d):
    a = D.fixed_threshold_alerts(X.readings(spark, d))
    told = lambda name: F.get_json_object("message", f"$.{name}")
    return a.select("reading_id", flag("is_anomaly").alias("is_anomaly"), "anomaly_confidence", told("alert_type").alias("alert_type"),
                    told("equipment_id").alias("message_equipment"), told("sensor_type").alias("message_sensor"), told("timestamp").alias("message_time"),
                    r(told("value").cast("double"), 6).alias("message_value"), told("health_score").cast("double").alias("message_score"))


@query
def critical_health_alerts(spark, d):
    a = D.critical_health_alerts(X.readings(spark, d))
    return a.select("reading_id", "equipment_id", "health_status", "maintenance_urgency",
                    F.get_json_object("message", "$.alert_type").alias("alert_type"),
                    F.get_json_object("message", "$.equipment_id").alias("message_equipment"),
                    F.get_json_object("message", "$.timestamp").alias("message_time"),
                    r(F.get_json_object("message", "$.value").cast("double"), 6).alias("message_value"),
                    r(F.get_json_object("message", "$.health_score").cast("double"), 6).alias("message_score"))


@query
def anomaly_runs(spark, d):
    runs = D.anomaly_runs(D.zscore_anomaly(X.readings(spark, d)))
    return runs.select("equipment_id", "sensor_type", "run_length", "run_start", "run_end", r("peak_z").alias("peak_z"))


def _stats(df):
    return df.select("window_start", "window_end", "sensor_type", rn("mean").alias("mean"), rn("std").alias("std"),
                     r("min", 6).alias("min"), r("max", 6).alias("max"), "count")


@query
def window_stats(spark, d):
    return _stats(D.window_stats(X.readings(spark, d)))


@query
def sliding_window_stats(spark, d):
    return _stats(D.window_stats(X.readings(spark, d), "1 hour", "30 minutes"))


@query
def throughput_5m(spark, d):
    t = D.throughput(X.readings(spark, d), F.col("metadata"))
    return t.withColumn("average_bytes", r("average_bytes"))


@query
def operating_sessions(spark, d):
    s = sessions.operating_sessions(X.readings(spark, d), 12 * 3600)
    return s.select("equipment_id", "session_number", "session_start", "session_end", "readings", r("total").alias("total"))


# --- cleaning ---------------------------------------------------------------------


@query
def clean_dedup(spark, d):
    return B.remove_duplicates(X.dirty_readings(spark, d))


@query
def null_profile(spark, d):
    p = B.null_profile(X.dirty_readings(spark, d), 0.0095)
    return p.select("column", r("null_ratio", 8).alias("null_ratio"), flag("dropped").alias("dropped"))


@query
def impute_mode(spark, d):
    return B.impute_mode(X.dirty_readings(spark, d), ["sensor_type"]).select("reading_id", "equipment_id", "sensor_type")


@query
def impute_median(spark, d):
    p = X.dirty_plant(spark, d).withColumn("target", F.col("value"))
    filled = B.impute_median(p, ["value", "rpm"], ["target"])
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "equipment_id",
                         r("value", 6).alias("value"), r("rpm", 6).alias("rpm"), r("target", 6).alias("target"))


@query
def iqr_filter(spark, d):
    kept = B.remove_outliers(X.dirty_plant(spark, d), MEASURES)
    return kept.select("equipment_id", "timestamp", "l_orderkey", "l_linenumber", "l_partkey", r("value", 6).alias("value"))


@query
def coerce_types(spark, d):
    text = F.when(F.col("reading_id") % 89 == 0, "bad").otherwise(F.col("value").cast("string"))
    raw = X.readings(spark, d).select(
        "reading_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), text.alias("value"))
    typed = B.coerce_types(raw)
    return typed.select("reading_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value")


@query
def drift_reference(spark, d):
    all_rows = X.readings(spark, d).select("reading_id", "timestamp", "equipment_id", "value")
    old = all_rows.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    new = all_rows.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return H.refresh_reference(old, new, "2024-02-05 00:00:00", 30)


# --- features ---------------------------------------------------------------------

PLANT_ID = ["l_orderkey", "l_linenumber", "l_partkey", "equipment_id", "timestamp"]


@query
def time_features(spark, d):
    t = C.time_features(X.readings(spark, d))
    return t.select("reading_id", "hour", "day_of_week", "day_of_month", "month", "is_weekend", "is_night")


@query
def rolling_features(spark, d):
    p = C.rolling_features(X.plant(spark, d), X.PLANT_ORDER)
    made = [c for c in p.columns if c.rsplit("_", 1)[-1] in ("5", "10", "30", "60")]
    return p.select(*PLANT_ID, *[rn(c).alias(c) for c in made])


@query
def equipment_features(spark, d):
    first = X.maintenance(spark, d).groupBy("equipment_id").agg(F.min("date").alias("start_date"))
    p = X.plant(spark, d).join(first, "equipment_id", "left")
    e = C.equipment_features(p, X.PLANT_ORDER)
    return e.select(*PLANT_ID, "equipment_age_days", "operating_hours")


@query
def days_since_maintenance(spark, d):
    m = C.days_since_maintenance(X.plant(spark, d), X.maintenance(spark, d), X.PLANT_ORDER)
    return m.select(*PLANT_ID, "last_maintenance",
                    F.col("days_since_maintenance").cast("double").alias("days_since_maintenance"))


@query
def pair_features(spark, d):
    p = C.pair_features(X.plant(spark, d))
    ratios, gaps = ([c for c in p.columns if c.endswith(e)] for e in ("_ratio", "_diff"))
    # A zero divisor leaves only the guard, so ratios reach 1e11: scale before rounding.
    return p.select(*PLANT_ID, *[r(F.col(c) / 1000, 3).alias(c) for c in ratios], *[rn(c).alias(c) for c in gaps])


@query
def health_indicators(spark, d):
    h = C.health_indicators(X.dirty_plant(spark, d))
    return h.select(*PLANT_ID, *[r(c, 6).alias(c) for c in ("vibration_health", "temperature_health", "overall_health")])


@query
def minmax_health_target(spark, d):
    h = C.health_target(X.plant(spark, d))
    return h.select(*PLANT_ID, r("health_score", 8).alias("health_score"), "maintenance_urgency")


@query
def feature_importance(spark, d):
    p = C.feature_importance(C.health_target(X.plant(spark, d)), features=MEASURES)
    return p.select("feature", r("importance", 6).alias("importance"), "type")


def _scaled(spark, d, method):
    p = C.scale(X.plant(spark, d), method, MEASURES)
    return p.select(*PLANT_ID, *[r(c, 6).alias(c) for c in MEASURES])


@query
def scale_standard(spark, d):
    return _scaled(spark, d, "standard")


@query
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query
def scale_robust(spark, d):
    return _scaled(spark, d, "robust")


@query
def sequence_windows(spark, d):
    s = C.sequence_windows(X.plant(spark, d), X.PLANT_ORDER, "temperature")
    total = F.aggregate("sequence", F.lit(None).cast("double"), lambda a, x: F.coalesce(a + x, x, a))
    return s.select(*PLANT_ID, F.size("sequence").alias("length"), F.col("sequence")[0].alias("first"),
                    F.element_at("sequence", -1).alias("last"), r(total, 3).alias("total"))


# --- detectors, votes and evaluation ----------------------------------------------


def detectors(spark, d):
    """Three rule detectors side by side: prediction 1 or -1, score lower = more anomalous."""
    z = D.zscore_anomaly(X.readings(spark, d))
    own = S.single_reading_health(F.col("sensor_type"), F.col("value"))
    limit = S.sensor_limit(F.col("sensor_type"))
    label = F.when(F.get_json_object("metadata", "$.k").cast("int") < 10, -1).otherwise(1)
    return z.select(
        "reading_id", label.alias("label"),
        F.when(F.col("z_score") > 2, -1).otherwise(1).alias("zscore"), (-F.col("z_score")).alias("zscore_score"),
        F.when(F.col("value") > limit, -1).otherwise(1).alias("limit"), (-F.col("value") / limit).alias("limit_score"),
        F.when(own < 0.2, -1).otherwise(1).alias("health"), (own - 1).alias("health_score"))


DETECTORS = ["zscore", "limit", "health"]


def training_rows(df, row_id):
    """Four rows in five, by a hash of the id: ensembles are fitted on these and score all."""
    return df.where(V.hash_bucket(F.col(row_id), 5) != 0)


@query
def anomaly_vote(spark, d):
    rows = detectors(spark, d)
    out = Z.AnomalyEnsemble(members=DETECTORS, method="majority").fit(rows).transform(rows).withColumnsRenamed(
        {"ensemble_prediction": "majority_vote", "ensemble_score": "mean_score"})
    out = Z.AnomalyEnsemble(members=DETECTORS, method="weighted").fit(training_rows(rows, "reading_id")).transform(out)
    return out.select("reading_id", "majority_vote", r("mean_score").alias("mean_score"),
                      F.col("ensemble_prediction").alias("weighted_vote"), r("ensemble_score").alias("weighted_score"))


def _detector_metrics(spark, d):
    rows = V.long_form(detectors(spark, d), {n: F.col(n) for n in DETECTORS}, ["label"], "model", "prediction")
    return V.binary_metrics(rows, "label", "prediction", ["model"], positive=-1)


@query
def binary_metrics(spark, d):
    m = _detector_metrics(spark, d)
    return m.select("model", *[r(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")])


@query
def best_model(spark, d):
    rows = V.predictions_of_best(detectors(spark, d), {n: F.col(n) for n in DETECTORS}, _detector_metrics(spark, d))
    return rows.filter(F.col("prediction") == -1).select("reading_id", "model_used", "label")


# --- failure prediction -----------------------------------------------------------


def labelled_plant(spark, d):
    """``plant`` with rule probabilities and a noisy binary label, all by row id."""
    noise = (X.plant_id() * 7919 % 1000) / 1000.0
    heat = (F.col("temperature") - 36) / 49.0
    return X.plant(spark, d).withColumns({
        "row_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "equipment_id"),
        "p_vibration": F.col("value"), "p_heat": heat, "p_speed": (F.col("rpm") - 1500) / 525.0,
        "will_fail": (F.col("value") + heat + 0.5 * noise > 1.3).cast("int"),
    })


PROBABILITIES = ["p_vibration", "p_heat", "p_speed"]


@query
def class_weights(spark, d):
    w = V.class_weights(labelled_plant(spark, d), "will_fail")
    return w.select("will_fail", "n", r("weight", 6).alias("weight"))


@query
def stratified_split(spark, d):
    s = V.stratified_split(labelled_plant(spark, d), "will_fail", ["row_id", "l_partkey"])
    return s.select("row_id", "timestamp", "will_fail", "split")


@query
def auc_rank(spark, d):
    p = labelled_plant(spark, d).withColumn("p", (F.col("p_heat") + F.col("p_speed")) / 2)
    e = V.binary_evaluation(p, "will_fail", "p")
    return e.select(*[r(c, 6).alias(c) for c in ("accuracy", "auc", "precision", "recall", "f1_score")])


@query
def failure_vote(spark, d):
    p = labelled_plant(spark, d)
    probabilities = {c: F.col(c) for c in PROBABILITIES}
    weights = E.auc_weights(p, probabilities, "will_fail", F.col("row_id")).scalar()
    out = E.failure_vote(p, probabilities, "soft", weights).withColumnsRenamed({"will_fail": "soft_vote", "failure_probability": "soft_probability"})
    out = E.failure_vote(out, probabilities, "hard")
    return out.select("row_id", "timestamp", r("soft_probability", 6).alias("soft_probability"), "soft_vote",
                      F.col("will_fail").alias("hard_vote"))


@query
def failure_label(spark, d):
    f = P.failure_label(X.readings(spark, d), X.failures(spark, d), X.READING_ORDER)
    return f.select("reading_id", "equipment_id", "next_failure", "will_fail")


@query
def maintenance_recommendations(spark, d):
    p = labelled_plant(spark, d).withColumn("failure_probability", (F.col("p_vibration") + F.col("p_heat")) / 2)
    m = P.maintenance_recommendations(p)
    return m.select("row_id", "timestamp", rn("failure_probability").alias("failure_probability"), "urgency",
                    "recommendation", "estimated_failure_time")


@query
def forecast_trend_season(spark, d):
    f = P.forecast(X.plant(spark, d), 30)
    return f.select("equipment_id", "timestamp", r("yhat", 6).alias("yhat"), r("failure_probability", 6).alias("failure_probability"))


@query
def forecast_history(spark, d):
    f = Y.fit_forecast(X.plant(spark, d)).predict(30)
    return f.select("equipment_id", "timestamp", r("yhat", 6).alias("yhat"), r("failure_probability", 6).alias("failure_probability"))


# --- health scoring ---------------------------------------------------------------

WIDE_SENSORS = {"value": "vibration", "temperature": "temperature", "load": "pressure", "rpm": "rpm"}
CENTRES = [[0.5, 60.0, 1750.0, 40.0], [0.2, 45.0, 1600.0, 10.0], [0.8, 75.0, 1900.0, 70.0]]


@query
def wide_sensor_health(spark, d):
    p = X.plant(spark, d).withColumn("health", G.wide_sensor_health(WIDE_SENSORS))
    return p.select(*PLANT_ID, r("health", 8).alias("health"))


@query
def cluster_distance_health(spark, d):
    p = X.plant(spark, d).withColumn("distance", G.centre_distance(MEASURES, CENTRES))
    return G.distance_health(p).select(*PLANT_ID, r("distance", 6).alias("distance"), r("health_score", 6).alias("health_score"))


def health_scores(spark, d):
    """Three health scores and a target for the votes."""
    p = C.health_target(X.plant(spark, d))
    return p.select(
        *PLANT_ID, F.col("health_score").alias("target"), G.wide_sensor_health(WIDE_SENSORS).alias("sensors"),
        S.range_health(F.col("value"), 0.0, 1.0).alias("vibration"),
        S.range_health(F.col("temperature"), 20.0, 80.0).alias("heat"))


HEALTH_SCORES = ["sensors", "vibration", "heat"]


@query
def health_vote(spark, d):
    p = health_scores(spark, d).withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "equipment_id"))
    train = training_rows(p, "row_id")
    for method in ("average", "weighted", "median"):
        model = Z.HealthEnsemble(members=HEALTH_SCORES, method=method, label="target").fit(train)
        p = model.transform(p).withColumnRenamed("health_score", method)
    return p.select(*PLANT_ID, *[r(c, 8).alias(c) for c in ("average", "weighted", "median")])


@query
def regression_metrics(spark, d):
    p = V.long_form(health_scores(spark, d), {c: F.col(c) for c in HEALTH_SCORES}, ["target"], "model", "score")
    m = V.regression_metrics(p, "target", "score", ["model"])
    return m.select("model", *[r(c, 6).alias(c) for c in ("mse", "rmse", "mae", "r2_score")])


@query
def health_report(spark, d):
    p = X.plant(spark, d).withColumn("health_score", G.wide_sensor_health(WIDE_SENSORS))
    return G.health_report(p).select(*PLANT_ID, r("health_score", 8).alias("health_score"), "status", "urgency", "is_critical")


@query
def maintenance_schedule(spark, d):
    latest = J.latest_health(D.health_by_window(X.readings(spark, d)))
    s = G.maintenance_schedule(latest, X.EVENTS_AS_OF)
    return s.select("equipment_id", r("health_score", 8).alias("health_score"), "status", "urgency",
                    F.col("recommended_date").cast("timestamp_ntz").alias("recommended_date"),
                    F.substring_index("description", " - ", -1).alias("condition"))


# --- drift, performance, registry -------------------------------------------------


@query
def drift_report(spark, d):
    p = X.plant(spark, d)
    split = F.lit(X.DRIFT_SPLIT).cast("timestamp_ntz")
    moved = p.filter(F.col("timestamp") >= split).withColumn("temperature", F.col("temperature") + 10)
    drifts = H.feature_drift(p.filter(F.col("timestamp") < split), moved, MEASURES)
    return H.with_summary(drifts).select("feature", r("drift", 6).alias("drift"), flag("has_drift").alias("has_drift"),
                                         r("drift_score", 6).alias("drift_score"), r("max_drift", 6).alias("max_drift"), "recommendation")


@query
def weighted_metrics(spark, d):
    rows = D.multisensor_health(X.readings(spark, d))
    own = S.health_status(S.single_reading_health(F.col("sensor_type"), F.col("value")))
    m = V.weighted_metrics(rows.withColumn("own_status", own), "health_status", "own_status")
    return m.select(*[r(c, 6).alias(c) for c in m.columns])


@query
def should_retrain(spark, d):
    s = H.should_retrain(X.model_log(spark, d), "2001-08-05 00:00:00", ["accuracy", "f1_score"])
    return s.select("model", F.col("run_id").cast("double").alias("run_id"), r("performance", 6).alias("performance"),
                    flag("should_retrain").alias("should_retrain"))


@query
def retrain_decision(spark, d):
    kinds = ["vibration", "temperature", "pressure", "rpm"]
    wide = X.readings(spark, d).select(
        "timestamp", *[F.when(F.col("sensor_type") == k, F.col("value")).alias(k) for k in kinds])
    w = H.retrain_decision(wide, X.EVENTS_AS_OF, kinds)
    return w.select(flag("has_drift").alias("has_drift"), r("drift_score", 6).alias("drift_score"),
                    r("max_drift", 6).alias("max_drift"), "recommendation", flag("retrain").alias("retrain"))


@query
def best_run(spark, d):
    log = X.model_log(spark, d)
    best, worst = R.best_run(log, "f1_score"), R.best_run(log, "accuracy", ascending=True)
    return best.select(F.lit("max f1_score").alias("by"), "model", "run_id", F.col("f1_score").alias("metric")).unionByName(
        worst.select(F.lit("min accuracy").alias("by"), "model", "run_id", F.col("accuracy").alias("metric")))


@query
def registry_latest(spark, d):
    return R.latest_versions(X.model_log(spark, d))


@query
def model_performance(spark, d):
    m = R.model_performance(X.model_log(spark, d), "1999-01-01 00:00:00", "2000-12-31 23:59:59")
    return m.select("model", *[r(c, 6).alias(c) for c in ("accuracy", "f1_score", "error_rate")], "prediction_count", "last_updated")


# --- alerts -----------------------------------------------------------------------


def alert_records(spark, d):
    """Scored readings in the shape the alert rules look at."""
    z = D.zscore_anomaly(X.readings(spark, d))
    k = F.get_json_object("metadata", "$.k").cast("double")
    return z.select(
        "reading_id", "timestamp", "equipment_id", "is_anomaly", "anomaly_confidence",
        S.single_reading_health(F.col("sensor_type"), F.col("value")).alias("health_score"),
        (k / 100).alias("failure_probability"), F.when(F.col("sensor_type") == "other", k / 100).alias("model_accuracy"))


def raised(spark, d):
    return I.rule_alerts(alert_records(spark, d), "reading_id")


def actions(spark, d):
    """A log of acknowledgements and resolutions, by reading id."""
    a = raised(spark, d)
    rid = F.col("reading_id")
    ack = a.filter(rid % 3 == 0).select(
        "alert_id", F.lit("acknowledged").alias("action"), F.concat(F.lit("operator_"), (rid % 5).cast("string")).alias("actor"),
        (F.col("timestamp") + F.expr("INTERVAL 5 MINUTES")).alias("at"), rid.alias("action_id"))
    done = a.filter(rid % 6 == 0).select(
        "alert_id", F.lit("resolved").alias("action"), F.lit("operator_9").alias("actor"),
        (F.col("timestamp") + F.expr("INTERVAL 30 MINUTES")).alias("at"), rid.alias("action_id"))
    return ack.unionByName(done)


@query
def rule_alerts(spark, d):
    return raised(spark, d).select("alert_id", "rule", "title", "description", "severity", "source", "timestamp", "equipment_id", "status")


@query
def alert_cooldown(spark, d):
    kept = I.cooldown(raised(spark, d), seconds="cooldown_seconds")
    return kept.select("alert_id", "rule", "timestamp")


@query
def alert_lifecycle(spark, d):
    return I.apply_actions(raised(spark, d), actions(spark, d)).select(
        "alert_id", "status", "acknowledged_by", "acknowledged_at", "resolved_at")


@query
def alert_stats(spark, d):
    return I.alert_statistics(I.apply_actions(raised(spark, d), actions(spark, d)))


@query
def alert_page(spark, d):
    states = I.apply_actions(raised(spark, d), actions(spark, d))
    p = I.alert_page(states, severity="critical", status="active", limit=100, offset=100)
    return p.select("alert_id", "timestamp", "severity", "status", "equipment_id", "total_count",
                    flag("has_next").alias("has_next"), flag("has_previous").alias("has_previous"))


@query
def metric_alerts(spark, d):
    rows = X.metrics(spark, d).select(
        "metric_id", "timestamp", F.col("processing_time").alias("value"),
        F.when(F.col("component") == "click", "cpu_percent").when(F.col("component") == "view", "memory_percent").alias("metric"))
    a = I.metric_alerts(rows, "metric_id")
    return a.select("metric_id", "timestamp", "metric", r("value", 6).alias("value"), "title", "severity", "source")


# --- operational metrics ----------------------------------------------------------


@query
def component_metrics(spark, d):
    e = X.metrics(spark, d)
    # Which component and metrics an event type stands for.
    of = {"click": ("data_ingestion", "records_processed", "processing_time"),
          "view": ("model_inference", "predictions_made", "inference_time"),
          "purchase": ("anomaly_detection", "anomalies_detected", "detection_time"),
          "signup": ("health_scoring", "scores_calculated", "calculation_time")}

    def name(i):
        out = F.lit("unknown")
        for event, names in of.items():
            out = F.when(F.col("component") == event, names[i]).otherwise(out)
        return out

    log = e.select("metric_id", "timestamp", name(0).alias("name"), F.inline(F.array(
        F.struct(name(1).alias("metric"), F.lit(1.0).alias("value")),
        F.struct(name(2).alias("metric"), F.col("processing_time").alias("value"))))).withColumnRenamed("name", "component")
    m = M.component_metrics(log)
    return m.select("component", "metric", r("value", 6).alias("value"))


@query
def metric_histogram(spark, d):
    h = M.metric_histogram(X.metrics(spark, d), "processing_time")
    return h.select("component", "le", "cumulative_count", r("observed_sum", 4).alias("observed_sum"), "observed_count")


@query
def metric_summary(spark, d):
    s = M.metric_summary(X.metrics(spark, d), "processing_time")
    return s.select("component", "period", rn("average").alias("average"), "peak", "samples")


@query
def component_status(spark, d):
    return M.component_status(X.metrics(spark, d), "processing_time", 50.0, 150.0)


@query
def health_changes(spark, d):
    c = I.health_changes(D.health_by_window(X.readings(spark, d)))
    return c.select("equipment_id", F.col("window_start").alias("timestamp"), "old_status", "new_status",
                    F.get_json_object("payload", "$.event").alias("event"),
                    F.get_json_object("payload", "$.data.new_status").alias("payload_status"))


# --- equipment --------------------------------------------------------------------


@query
def equipment_page(spark, d):
    health = D.health_by_window(X.readings(spark, d))
    p = J.equipment_list(X.equipment(spark, d), health, status="operational", location="ASIA", limit=100, offset=0)
    return p.select("equipment_id", "name", "type", "location", "status", r("health_score", 8).alias("health_score"),
                    "health_status", "total_count", flag("has_next").alias("has_next"))


@query
def equipment_detail(spark, d):
    e = J.equipment_detail(X.plant_equipment(spark, d), X.maintenance(spark, d), ["date", "order_key"])
    h = F.col("maintenance_history")
    return e.select("equipment_id", "name", "location", F.col("specifications")["site"].alias("site"), "status", "history_page",
                    F.size(h).alias("entries"), h[0]["date"].alias("first_date"), h[0]["type"].alias("first_type"),
                    F.element_at(h, -1)["date"].alias("last_date"), F.element_at(h, -1)["order_key"].alias("last_key"))


@query
def silent_equipment(spark, d):
    e = X.equipment(spark, d)
    silent = J.without_readings(e, X.readings(spark, d)).select("equipment_id", "name", "status", F.lit("silent").alias("kind"))
    alerted = J.with_alerts(e, raised(spark, d)).select("equipment_id", "name", "status", F.lit("alerted").alias("kind"))
    return silent.unionByName(alerted)


@query
def health_history(spark, d):
    h = J.health_history(X.readings(spark, d), "week", "2024-01-05 00:00:00", "2024-01-28 00:00:00")
    return h.select("equipment_id", "timestamp", r("health_score", 8).alias("health_score"), "status", "anomalies", "maintenance_urgency")


@query
def health_summary(spark, d):
    s = J.health_summary(J.health_history(X.readings(spark, d), "day"))
    return s.select("equipment_id", rn("average_health").alias("average_health"), "trend", "anomaly_count", "critical_alerts")


@query
def array_readings_anomaly(spark, d):
    numbered = running(X.readings(spark, d), ["equipment_id"], X.READING_ORDER, {"_n": ("count", None)})
    request = F.concat_ws("#", "equipment_id", F.floor((F.col("_n") - 1) / 20).cast("string"))
    arrays = numbered.groupBy(request.alias("request_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_n", "value"))), lambda s: s["value"]).alias("sensor_readings"))
    a = J.array_anomaly(arrays)
    return a.select("request_id", flag("is_anomaly").alias("is_anomaly"), r("confidence").alias("confidence"),
                    r("anomaly_score").alias("anomaly_score"), "readings")


@query
def component_scores(spark, d):
    c = J.component_scores(D.health_by_window(X.readings(spark, d)))
    return c.select("equipment_id", F.col("window_start").alias("timestamp"), r("overall_score", 8).alias("overall_score"), "status",
                    "maintenance_urgency", J.flatten_map(F.col("component_scores")).alias("component_scores"))


# --- sources ----------------------------------------------------------------------


def raw_payloads(spark, d):
    """Readings as the JSON text they travel in; some lack a field, some are no JSON."""
    rid = F.col("reading_id")
    rows = X.readings(spark, d).withColumns({
        "sensor_type": F.when(rid % 101 != 0, F.col("sensor_type")), "value": F.when(rid % 97 != 0, F.col("value")),
        "unit": F.lit("u"), "location": F.lit("hall"), "metadata": F.from_json("metadata", "map<string,double>")})
    return rows.select("reading_id", F.when(rid % 53 == 0, F.lit("{not json")).otherwise(A.to_json()).alias("payload"))


@query
def parse_readings(spark, d):
    p = A.parse_readings(raw_payloads(spark, d), "payload", ("reading_id",))
    return p.select("reading_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "equipment_id", "sensor_type",
                    r("value", 6).alias("value"), "unit", F.col("metadata")["k"].alias("k"))


@query
def publish_envelope(spark, d):
    rid = F.col("reading_id")
    rows = X.readings(spark, d).withColumns({
        "equipment_id": F.when(rid % 61 != 0, F.col("equipment_id")), "unit": F.lit("u"), "location": F.lit("hall"),
        "metadata": F.from_json("metadata", "map<string,double>")})
    e = A.publish_envelope(rows)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return e.select("key", field("timestamp").alias("sent_time"), field("sensor_type").alias("sensor_type"),
                    r(field("value").cast("double"), 6).alias("sent_value"), field("metadata.k").cast("double").alias("k"))


@query
def decode_envelope(spark, d):
    sent = raw_payloads(spark, d).select("reading_id", F.base64(F.col("payload").cast("binary")).alias("data"))
    p = A.decode_envelopes(sent, keep=("reading_id",))
    return p.select("reading_id", "equipment_id", "sensor_type", r("value", 6).alias("value"))


@query
def ingest_validation(spark, d):
    return A.ingest_report(A.parse_readings(raw_payloads(spark, d), "payload", drop_bad=False))


@query
def latest_readings(spark, d):
    return A.latest(X.readings(spark, d), 100).select("reading_id", "timestamp", "equipment_id", "value")


@query
def lake_summary(spark, d):
    s = L.data_summary(X.readings(spark, d), F.col("metadata"))
    return s.withColumn("total_size_mb", r("total_size_mb", 8))


@query
def training_slice(spark, d):
    rows = C.health_indicators(X.plant(spark, d)).withColumn("health_score", F.col("overall_health"))
    t = L.training_data(rows, "1998-01-01 00:00:00", "1998-12-31 23:59:59", ["equipment_id", "timestamp", *MEASURES])
    return t.select("equipment_id", "timestamp", *[r(c, 6).alias(c) for c in [*MEASURES, "health_score"]])


@query
def version_diff(spark, d):
    rid = F.col("reading_id")
    old = X.dirty_readings(spark, d).select("reading_id", "equipment_id", "sensor_type", "value")
    new = X.readings(spark, d).select("reading_id", "equipment_id", "sensor_type", "value").filter(rid % 10 != 0)
    return U.difference(old, new)


# --- streams ----------------------------------------------------------------------


def _event_stream(spark, d):
    """The event table as a file stream, in the shape of ``readings``."""
    schema = X.table(spark, d, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return X.as_readings(source)


@query
def stream_zscore(spark, d):
    path = storage.fresh_path(spark, "zscore")
    scored = T.stream_zscore(_event_stream(spark, d))
    T.await_done(T.to_parquet(scored, f"{path}/rows", f"{path}/checkpoint"), None)
    z = spark.read.schema(scored.schema).parquet(f"{path}/rows")
    return z.select("reading_id", "equipment_id", "sensor_type", r("z_score").alias("z_score"),
                    flag("is_anomaly").alias("is_anomaly"), r("anomaly_confidence").alias("anomaly_confidence"))


# --- nearest-neighbour imputation -------------------------------------------------


@query
def impute_knn(spark, d):
    rows = K.impute_knn(X.dirty_plant(spark, d), MEASURES, ["l_orderkey", "l_linenumber", "l_partkey", "equipment_id", "timestamp"])
    return rows.select(*PLANT_ID, r("value", 6).alias("value"))


# --- models -----------------------------------------------------------------------
# No SQL stands for these; tests check what they must satisfy.

ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "equipment_id", "timestamp"]


def _anomaly(model, df):
    out = model.score(df)
    return out.select(*PLANT_ID, r(f"{model.name}_score", 6).alias("score"), F.col(model.name).alias("prediction"))


@query
def isolation_forest(spark, d):
    p = X.plant(spark, d)
    return _anomaly(N.fit_isolation_forest(p, MEASURES, ROW_ID), p)


@query
def one_class_kernel(spark, d):
    p = X.plant(spark, d)
    return _anomaly(N.fit_one_class(p, MEASURES), p)


@query
def sequence_reconstruction(spark, d):
    p = X.plant(spark, d)
    return _anomaly(N.fit_sequence_reconstruction(p, "temperature", X.PLANT_ORDER), p)


def _failure_test(spark, d, fit):
    rows = V.stratified_split(labelled_plant(spark, d), "will_fail", ["row_id", "l_partkey"])
    model = fit(rows.filter(F.col("split") == "train"))
    out = model.score(rows.filter(F.col("split") == "test"))
    return out.select("row_id", "timestamp", "will_fail", r(model.name, 6).alias("probability"))


@query
def failure_rf(spark, d):
    return _failure_test(spark, d, lambda t: Q.fit_failure_forest(t, MEASURES, "will_fail"))


@query
def failure_gbt(spark, d):
    return _failure_test(spark, d, lambda t: Q.fit_failure_boosting(t, MEASURES, "will_fail"))


@query
def failure_sequence(spark, d):
    p = labelled_plant(spark, d)
    model = Q.fit_failure_sequence(p, "p_heat", "will_fail", X.PLANT_ORDER)
    return model.score(p).select("row_id", "timestamp", "will_fail", r(model.name, 6).alias("probability"))


def _health_rows(spark, d):
    return C.health_target(X.plant(spark, d))


def _health(model, df):
    return model.score(df).select(*PLANT_ID, r("health_score", 6).alias("target"), r(model.name, 6).alias("score"))


@query
def health_rf(spark, d):
    p = _health_rows(spark, d)
    return _health(Q.fit_health_forest(p, MEASURES, "health_score"), p)


@query
def health_gbt(spark, d):
    p = _health_rows(spark, d)
    return _health(Q.fit_health_boosting(p, MEASURES, "health_score"), p)


@query
def health_mlp(spark, d):
    p = _health_rows(spark, d)
    return _health(Q.fit_health_network(p, MEASURES, "health_score"), p)


@query
def health_cluster(spark, d):
    p = X.plant(spark, d)
    model = Q.fit_health_clusters(p, MEASURES)
    return model.score(p).select(*PLANT_ID, "cluster", r(model.name, 6).alias("score"))
