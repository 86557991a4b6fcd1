"""Sliced windows over hot keys must equal the plain windows."""

from __future__ import annotations

import pandas as pd
import pytest
from compare import differences
from pyspark.sql import Window, functions as F

from millwatch import fixtures as X
from millwatch.operators import features as C, sessions, stream_rules as D
from millwatch.plans.quantiles import exact_quantiles
from millwatch.plans.slices import _hot_keys, _sliced, lookback, running


def skewed(spark, sf):
    """A third of all rows on one machine, the rest spread out, some measures missing."""
    p = X.dirty_plant(spark, sf)
    return p.withColumn("equipment_id", F.when(F.col("l_partkey") % 3 == 0, "EQ_HOT").otherwise(F.col("equipment_id")))


@pytest.mark.parametrize("rows", [1, 9, 99])
def test_lookback_equals_plain_window(spark, sf, rows):
    df = skewed(spark, sf)
    made = {
        "n": lambda w: F.count("value").over(w.rowsBetween(-rows, 0)),
        "low": lambda w: F.min("rpm").over(w.rowsBetween(-rows, 0)),
        "back": lambda w: F.lag("l_orderkey", rows).over(w),
    }
    sliced = lookback(df, ["equipment_id"], X.PLANT_ORDER, rows, made, hot_rows=400)
    plain = Window.partitionBy("equipment_id").orderBy(*X.PLANT_ORDER)
    whole = df.select("*", *[f(plain).alias(n) for n, f in made.items()])
    assert differences(sliced.toPandas(), whole.toPandas()) == ""


def test_running_equals_plain_window(spark, sf):
    df = skewed(spark, sf)
    entry = F.when(F.col("l_partkey") % 7 == 0, F.col("l_orderkey"))
    sliced = running(df, ["equipment_id"], X.PLANT_ORDER, {
        "position": ("count", None), "total": ("sum", F.col("l_linenumber")),
        "latest": ("last", entry), "following": ("next", entry)}, hot_rows=400)
    w = Window.partitionBy("equipment_id").orderBy(*X.PLANT_ORDER)
    past, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    whole = df.select(
        "*", F.row_number().over(w).cast("long").alias("position"), F.sum("l_linenumber").over(past).alias("total"),
        F.last(entry, True).over(past).alias("latest"), F.first(entry, True).over(ahead).alias("following"))
    assert differences(sliced.toPandas(), whole.toPandas()) == ""


def test_running_without_keys_is_sliced_too(spark, sf):
    df = X.readings(spark, sf)
    rows = running(df, [], ["value", "reading_id"], {"position": ("count", None)}, hot_rows=100).toPandas()
    rows = rows.sort_values(["value", "reading_id"])
    assert list(rows["position"]) == list(range(1, len(rows) + 1))


def test_null_key_is_a_key_like_any_other(spark, sf):
    df = X.plant(spark, sf).withColumn("equipment_id", F.when(F.col("l_partkey") % 2 == 0, F.col("equipment_id")))
    hot = running(df, ["equipment_id"], X.PLANT_ORDER, {"position": ("count", None)}, hot_rows=300)
    cold = running(df, ["equipment_id"], X.PLANT_ORDER, {"position": ("count", None)})
    assert differences(hot.toPandas(), cold.toPandas()) == ""


def test_zscore_and_runs_with_hot_keys(spark, sf):
    df = X.readings(spark, sf).withColumn("equipment_id", F.lit("EQ_HOT"))
    cold, hot = D.zscore_anomaly(df), D.zscore_anomaly(df, hot_rows=60)
    assert differences(hot.toPandas(), cold.toPandas()) == ""
    assert differences(D.anomaly_runs(cold, hot_rows=60).toPandas(), D.anomaly_runs(cold).toPandas()) == ""


def test_bursts_are_cut_again(spark):
    """Nearly all rows lie in the last thousandth of the time span, many at one instant."""
    rows = spark.range(3000).select(
        F.lit("A").alias("k"), F.col("id"),
        F.when(F.col("id") < 10, F.col("id") * 1e6).when(F.col("id") < 2000, 9e6 + F.col("id")).otherwise(9e6 + 5000).alias("at"))
    hot = _hot_keys(rows, ["k"], ["at", "id"], 100)
    sizes = _sliced(rows, ["k"], ["at", "id"], hot, 100).groupBy("_slice").agg(F.count("*").alias("n"), F.countDistinct("at").alias("places"))
    assert sizes.filter("n > 100 AND places > 1").count() == 0 and sizes.count() > 20
    made = {"p": ("count", None), "s": ("sum", F.col("id"))}
    a, b = (running(rows, ["k"], ["at", "id"], made, h).toPandas() for h in (100, 10**6))
    assert differences(a, b) == ""
    back = {"b": lambda w: F.lag("id", 7).over(w)}
    a, b = (lookback(rows, ["k"], ["at", "id"], 7, back, h).toPandas() for h in (100, 10**6))
    assert differences(a, b) == ""


def test_sessions_with_hot_keys(spark, sf):
    df = X.readings(spark, sf)
    a, b = (sessions.operating_sessions(df, 12 * 3600, hot_rows=h).withColumn("total", F.round("total", 6)) for h in (10**6, 20))
    assert differences(b.toPandas(), a.toPandas()) == ""


def test_sequences_and_maintenance_with_hot_keys(spark, sf):
    df, log = X.plant(spark, sf), X.maintenance(spark, sf)
    a = C.sequence_windows(df, X.PLANT_ORDER, length=20).withColumn("sequence", F.concat_ws(",", "sequence"))
    b = C.sequence_windows(df, X.PLANT_ORDER, length=20, hot_rows=90).withColumn("sequence", F.concat_ws(",", "sequence"))
    assert differences(b.toPandas(), a.toPandas()) == ""
    a = C.days_since_maintenance(df, log, X.PLANT_ORDER)
    b = C.days_since_maintenance(df, log, X.PLANT_ORDER, hot_rows=200)
    assert differences(b.toPandas(), a.toPandas()) == ""


def test_exact_quantiles(spark, sf):
    df = X.dirty_plant(spark, sf)
    asked = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["value", "rpm"], asked)
    pdf = df.select("value", "rpm").toPandas()
    for (c, p), q in got.items():
        assert q == pytest.approx(pdf[c].quantile(p), abs=1e-9)
    assert len(got) == 10


def test_no_hot_key_means_one_shuffle_of_the_rows(spark, sf):
    df = C.rolling_features(X.plant(spark, sf), X.PLANT_ORDER, ["value"], [5, 10])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    moved = [line for line in final.split("\n") if "Exchange hashpartitioning" in line and "l_orderkey" not in line]
    assert "Union" not in final, (len(moved), final)


def test_rolling_features_carry_rows_from_batch_to_batch(spark, sf):
    """Batches of a few rows, of keys that end inside them, against the plain window of the engine; no window is made."""
    spec = Window.partitionBy("equipment_id").orderBy(*X.PLANT_ORDER)
    df = X.dirty_plant(spark, sf).withColumns({
        "value": F.when(F.col("l_orderkey") % 31 == 0, float("nan")).otherwise(F.col("value")),
        "whole": F.when(F.col("l_orderkey") % 5 > 0, F.col("l_partkey")), "big": F.col("l_partkey") + (1 << 60)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rolled = C.rolling_features(df, X.PLANT_ORDER, ["value", "whole", "big"], [4, 12, 30])
        got = rolled.toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Window" not in rolled._jdf.queryExecution().executedPlan().toString()
    want = df.select("*", *[fn(c).over(spec.rowsBetween(1 - w, 0)).alias(f"{c}_{name}_{w}") for c in ("value", "whole", "big") for w in (4, 12, 30)
                            for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min))])
    assert rolled.schema["whole_max_4"].dataType == df.schema["whole"].dataType
    assert rolled.columns == want.columns
    by, noise = ["l_orderkey", "l_linenumber", "l_partkey"], [f"big_std_{w}" for w in (4, 12, 30)]  # of numbers of 60 bits only extremes are exact
    a, b = (t.drop(columns=noise).sort_values(by).reset_index(drop=True) for t in (got, want.toPandas()))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)
