"""Shape of the plans that matter at scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwatch import fixtures as X
from millwatch.operators import equipment as J, evaluation as V, features as C, metrics as M, stream_rules as D


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    text = plan(df)
    return text[text.index("Final Plan"):text.index("Initial Plan")]


def test_scans_read_only_what_is_used(spark, sf):
    text = plan(D.window_stats(X.readings(spark, sf)))
    schema = text[text.index("ReadSchema: "):].split(">")[0]
    assert "props" not in schema and "user_id" not in schema and "value" in schema


def test_filters_reach_the_scan(spark, sf):
    text = plan(X.plant(spark, sf).filter(F.col("timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(l_shipdate" in text


def test_no_cross_joins_or_python_in_the_rule_path(spark, sf):
    for df in (D.flagged_alerts(X.readings(spark, sf)), C.scale(X.plant(spark, sf)), C.health_target(X.plant(spark, sf)),
               V.auc(X.plant(spark, sf).withColumn("y", (F.col("value") > 0.5).cast("int")), "y", "rpm")):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text and "InPandas" not in text


def test_rolling_features_move_the_rows_once(spark, sf):
    text = final_plan(C.rolling_features(X.plant(spark, sf), X.PLANT_ORDER))
    assert "Union" not in text
    sorts = [line for line in text.split("\n") if " Sort [" in line]
    assert len(sorts) == 1, sorts


def test_known_metric_names_are_broadcast(spark, sf):
    log = X.metrics(spark, sf).select("component", F.lit("errors").alias("metric"), F.col("processing_time").alias("value"), "timestamp", "metric_id")
    assert "BroadcastHashJoin" in plan(M.component_metrics(log))


def test_silent_equipment_folds_ids_before_the_join(spark, sf):
    text = plan(J.without_readings(X.equipment(spark, sf), X.readings(spark, sf)))
    assert "LeftAnti" in text and text.count("HashAggregate") >= 2
