"""Streams must give what the batch operators give."""

from __future__ import annotations

import base64
import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import differences
from pyspark.sql import functions as F

from millwatch import fixtures as X
from millwatch.operators import alerts as I, cleaning as B, sessions, stream_rules as D
from millwatch.sources import readings as A
from millwatch.streaming import jobs as T


@pytest.fixture()
def days(spark, sf, folder):
    """Readings of three weeks, one file per week, in order of arrival."""
    rows = X.readings(spark, sf)
    for week in range(3):
        low, high = 1 + 7 * week, 8 + 7 * week
        part = rows.filter(F.dayofmonth("timestamp").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return f"{folder}/in", spark.read.parquet(f"{folder}/in")


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, df, folder, name):
    T.await_done(T.to_parquet(df, f"{folder}/{name}", f"{folder}/{name}-checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names}).toPandas()


def test_zscore_across_batches_and_a_restart(spark, sf, folder, days):
    path, rows = days
    scored = T.stream_zscore(stream(spark, path, rows.schema))
    first = run(spark, scored, folder, "z").count()
    late = X.readings(spark, sf).filter(F.dayofmonth("timestamp").between(22, 25))
    late.coalesce(1).write.mode("append").parquet(path)
    out = run(spark, T.stream_zscore(stream(spark, path, rows.schema)), folder, "z")
    assert first == rows.count() and out.count() == first + late.count()
    batch = D.zscore_anomaly(spark.read.parquet(path))
    assert differences(rounded(out, "z_score", "anomaly_confidence"), rounded(batch, "z_score", "anomaly_confidence")) == ""


def test_zscore_of_a_key_in_many_parts(spark, sf, folder, days):
    path, rows = days
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        one = T.stream_zscore(spark.readStream.schema(rows.schema).parquet(path))
        out = run(spark, one, folder, "parts")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = D.zscore_anomaly(rows)
    assert differences(rounded(out, "z_score", "anomaly_confidence"), rounded(batch, "z_score", "anomaly_confidence")) == ""


class _State(dict):
    """What a processor asks of a state, kept in memory."""

    def get(self, *_):
        return iter(self["list"]) if "list" in self else self["one"]

    def put(self, rows):
        self["list"] = rows

    def update(self, one):
        self["one"] = one

    def exists(self):
        return "one" in self

    def updateValue(self, key, value):
        self["most"] = max(self["most"], len(value[0])) if "most" in self else len(value[0])
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class _Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def state(self, name, *_, **given):
        self.given = {**getattr(self, "given", {}), name: given}
        return self.states.setdefault(name, _State({"list": []} if name == "values" else {}))

    getListState = getMapState = getValueState = state

    def listTimers(self):
        return self.timers

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


class _Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_parts_are_put_aside_by_time_and_forgotten_when_idle():
    rng = np.random.default_rng(3)
    at = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(3000), unit="s")
    rows = pd.DataFrame({"timestamp": at, "reading_id": range(3000), "value": rng.normal(size=3000)})
    made = []
    for size in (3000, 100):
        job, handle = T.ZScores(["timestamp", "reading_id"], 20, 2.0, 10, "unit", 60_000, 0), _Handle()
        job.init(handle)
        parts = [rows.iloc[i:i + size] for i in range(0, 3000, size)]
        out = list(job.handleInputRows(("a",), iter(parts), _Times(0)))
        assert len(out) == (1 if size == 3000 else 50)  # one for each slice of a minute
        made.append(pd.concat(out).reset_index(drop=True))
        aside = handle.states["aside"]
        assert not [k for k in aside if isinstance(k, tuple)]  # nothing is left aside
        last = int(at.max().timestamp() * 1000)
        assert handle.timers == [last + 60_000] and len(handle.states["values"]["list"]) == 20
    pd.testing.assert_frame_equal(*made)
    assert list(job.handleExpiredTimer(("a",), None, _Times(last + 59_999))) == [] and "one" in handle.states["seen"]
    job.handleExpiredTimer(("a",), None, _Times(last + 60_000))
    assert "one" not in handle.states["seen"] and "list" not in handle.states["values"]
    with pytest.raises(ValueError):
        T.stream_zscore(None, idle="1 hour", ttl="1 hour")
    lasting = _Handle()
    T.ZScores(["timestamp"], 20, 2.0, 10, "unit", 0, 5000).init(lasting)
    assert lasting.given["values"] == {"ttlDurationMs": 5000} and lasting.given["aside"] == {}


def test_zscore_keeps_a_state_per_lot_and_not_per_key(spark, folder, days, monkeypatch):
    path, rows = days
    monkeypatch.setattr(T, "LOTS", 4)
    query = T.await_done(T.to_parquet(T.stream_zscore(stream(spark, path, rows.schema)), f"{folder}/lots", f"{folder}/c"), None)
    assert rows.select("equipment_id", "sensor_type").distinct().count() > 50
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    out, batch = spark.read.parquet(f"{folder}/lots"), D.zscore_anomaly(rows)
    assert differences(rounded(out, "z_score", "anomaly_confidence"), rounded(batch, "z_score", "anomaly_confidence")) == ""


@pytest.mark.parametrize("at_once", [10_000, 150])
def test_lots_score_each_key_by_itself(at_once):
    """Keys of a lot, in parts and over two micro-batches, against one processor a key; larger lots go by time slices."""
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(3000), unit="s"), "reading_id": range(3000),
                         "a": rng.choice(["x", "y", "z"], 3000, p=[.9, .09, .01]), "b": rng.integers(0, 2, 3000), "value": rng.normal(size=3000), "_lot": 7})
    rule, batches = (["timestamp", "reading_id"], 20, 2.0, 10, "unit"), [rows[rows["timestamp"] < "2024-01-01 00:20"], rows[rows["timestamp"] >= "2024-01-01 00:20"]]
    handle, made, expected = _Handle(), [], []
    for batch in batches:
        job = T.ZScoreLots(["a", "b"], *rule, at_once)
        job.init(handle)
        out = list(job.handleInputRows((7,), (batch.iloc[i:i + 100] for i in range(0, len(batch), 100)), _Times(0)))
        assert max(map(len, out)) <= max(at_once, 200) or at_once == 10_000
        made += out
    assert not [k for k in handle.states["aside"] if isinstance(k, tuple)]
    for _, own in rows.groupby(["a", "b"]):
        job = T.ZScores(*rule, 0, 0)
        job.init(_Handle())
        expected += list(job.handleInputRows(("a",), iter([own]), _Times(0)))
    by_id = lambda parts: pd.concat(parts).sort_values("reading_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(by_id(made), by_id(expected), check_exact=True)


def test_late_rows_of_more_micro_batches_than_a_query_remembers(spark, tmp_path):
    """Each file but the first brings one row in time and one far too late."""
    counter = T.count_late_rows(spark)
    (tmp_path / "in").mkdir()
    files = 104
    for i in range(files):
        times = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)] + ([dt.datetime(2023, 1, 1)] if i > 1 else [])
        path = tmp_path / "in" / f"{i:04}.parquet"
        pq.write_table(pa.table({"timestamp": pa.array(times, pa.timestamp("us", "UTC")), "equipment_id": ["a"] * len(times), "value": [1.0] * len(times)}), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    try:
        source = spark.readStream.schema("timestamp timestamp, equipment_id string, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        counts = source.withWatermark("timestamp", "1 hour").groupBy(F.window("timestamp", "1 hour")).count()
        query = T.await_done(T.to_parquet(counts, str(tmp_path / "out"), str(tmp_path / "c")))
        assert counter.total(query) == files - 2 and counter.batches[str(query.id)] >= files
        assert len(query.recentProgress) <= 100
    finally:
        spark.streams.removeListener(counter)


def test_alert_job_equals_batch(spark, folder, days):
    path, rows = days
    T.await_done(T.alert_job(stream(spark, path, rows.schema), f"{folder}/alerts", f"{folder}/c"))
    columns = ["timestamp", "equipment_id", "alert_type", "severity", "message"]
    out = spark.read.parquet(f"{folder}/alerts")
    assert out.select(F.countDistinct("batch")).first()[0] == 3
    assert differences(out.select(*columns).toPandas(), D.flagged_alerts(rows).select(*columns).toPandas()) == ""


def test_cooldown_equals_batch(spark, folder, days):
    path, rows = days
    made = lambda df: df.select(
        F.lit("r").alias("rule"), "timestamp", F.col("reading_id").cast("string").alias("alert_id"))
    out = run(spark, T.stream_cooldown(made(stream(spark, path, rows.schema)), seconds=3600), folder, "cool")
    assert differences(out.toPandas(), I.cooldown(made(rows), seconds=3600).toPandas()) == ""


def test_windows_with_late_rows(spark, sf, folder):
    rows = X.readings(spark, sf)
    for i, low in enumerate((1, 15, 3)):  # the third file comes far too late
        rows.filter(F.dayofmonth("timestamp").between(low, low + 1)).coalesce(1).write.mode("append").parquet(f"{folder}/in{i}")
    source, total = f"{folder}/all", 0
    counter = T.count_late_rows(spark)
    query_rows = None
    for i in range(3):
        spark.read.parquet(f"{folder}/in{i}").coalesce(1).write.mode("append").parquet(source)
        stats = D.window_stats(T.with_event_time(stream(spark, source, rows.schema), "1 day"), "6 hours")
        query = T.await_done(T.to_parquet(stats, f"{folder}/w", f"{folder}/wc"))
        total += counter.total(query) - total
        query_rows = stats.schema
    spark.streams.removeListener(counter)
    late = rows.filter(F.dayofmonth("timestamp").between(3, 4)).count()
    assert total >= 1 and late >= total
    out = spark.read.schema(query_rows).parquet(f"{folder}/w")
    expected = D.window_stats(rows.filter(F.dayofmonth("timestamp").between(1, 2)).withColumn("timestamp", F.col("timestamp").cast("timestamp")), "6 hours")
    first = out.filter(F.dayofmonth("window_start") <= 2)
    assert differences(rounded(first, "mean", "std"), rounded(expected, "mean", "std")) == ""


def test_sessions_equal_batch_once_final(spark, folder, days):
    path, rows = days
    closing = rows.limit(1).withColumns({"timestamp": F.lit("2025-01-01").cast("timestamp_ntz"), "equipment_id": F.lit("end")})
    closing.coalesce(1).write.mode("append").parquet(path)
    df = T.with_event_time(stream(spark, path, rows.schema), "30 days")
    out = run(spark, T.stream_sessions(df, "12 hours"), folder, "s").drop("s")
    batch = sessions.operating_sessions(rows, 12 * 3600).drop("session_number").withColumns({
        c: F.col(c).cast("timestamp") for c in ("session_start", "session_end")})
    assert differences(rounded(out.select(*batch.columns), "total"), rounded(batch, "total")) == ""


def test_duplicates_inside_the_watermark(spark, folder, days):
    path, rows = days
    rows.limit(40).coalesce(1).write.mode("append").parquet(path)
    clean = B.remove_duplicates(stream(spark, path, rows.schema).withColumn("timestamp", F.col("timestamp").cast("timestamp")),
                                watermark="60 days", keys=["reading_id"])
    assert run(spark, clean, folder, "d").count() == rows.count()


def test_envelopes_to_the_lake(spark, folder):
    good = {"timestamp": "2024-01-01T10:00:00Z", "equipment_id": "A", "sensor_type": "vibration", "value": 1.2, "unit": "g", "location": "hall"}
    text = [base64.b64encode(json.dumps(good).encode()).decode(), "***"]
    spark.createDataFrame([(t,) for t in text], "data string").coalesce(1).write.text(f"{folder}/in")
    source = spark.readStream.text(f"{folder}/in").withColumnRenamed("value", "data")
    T.await_done(T.threshold_job(source, f"{folder}/out", f"{folder}/c"))
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert [(r["is_anomaly"], r["health_score"], r["year"], r["day"]) for r in rows] == [(True, 0.0, 2024, 1)]


def test_json_stream_skips_bad_lines_and_calls_back(spark, tmp_path):
    good = {"timestamp": "2024-01-01T10:00:00Z", "equipment_id": "A", "sensor_type": "rpm", "value": 1.0, "unit": "u", "location": "l"}
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(good) + "\n{broken\n")
    seen = []
    source = A.stream_readings(spark, str(tmp_path / "in"), files_per_trigger=1)
    T.await_done(T.for_each_batch(source, lambda df, n: seen.append((n, df.count())), str(tmp_path / "c")))
    assert seen == [(0, 1), (1, 1), (2, 1)]
