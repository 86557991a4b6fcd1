"""Fitted ensembles, families on disk, forecasts, exact selection, running totals and cool-down against plain versions."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millwatch import fixtures as X
from millwatch.operators import alerts as I, anomaly as N, ensembles as Z, evaluation as V, families as W, forecast as Y, learners as Q
from millwatch.plans.prefix import running_sums
from millwatch.plans.quantiles import exact_quantiles
from millwatch.sources import versions as U

START = dt.datetime(2024, 1, 1)


# --- ensembles --------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *[float(v) for v in rng.random(3)], float(rng.random()), int(rng.random() > 0.5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, truth double, y int")
    return df.withColumns({"d": F.when(F.col("a") > 0.4, 1).otherwise(-1), "e": F.when(F.col("b") > 0.7, 1).otherwise(-1), "d_score": -F.col("a"), "e_score": F.col("b") - 2})


KINDS = [(Z.AnomalyEnsemble, {"members": ["d", "e"]}, "ensemble_score", "majority"), (Z.HealthEnsemble, {"members": ["a", "b", "c"], "label": "truth"}, "health_score", "average"),
         (Z.FailureEnsemble, {"members": ["a", "b"], "label": "y", "rowId": ["id"]}, "failure_probability", "soft")]


@pytest.mark.parametrize("kind, given, out, plain", KINDS)
def test_weights_belong_to_the_model(spark, scored, folder, kind, given, out, plain):
    df = scored
    model = kind(method="weighted", **given).fit(df.where("id < 200"))
    assert sum(model.weights.values()) == pytest.approx(1) and list(model.weights) == given["members"]
    among = {r["id"]: r[out] for r in model.transform(df).collect()}
    alone = model.transform(df.where("id = 250").drop("truth", "y")).first()[out]
    assert alone == among[250]
    PipelineModel([model]).write().save(f"{folder}/pipeline")
    model.write().save(f"{folder}/m")
    for back in (type(model).load(f"{folder}/m"), PipelineModel.load(f"{folder}/pipeline").stages[0]):
        assert back.weights == model.weights and back.uid == model.uid
        assert {r["id"]: r[out] for r in back.transform(df).collect()} == among
    equal = kind(method=plain, **given).fit(df)
    assert len(set(equal.weights.values())) == 1
    with pytest.raises(ValueError):
        kind(method="loud", **given).fit(df)


def test_weights_equal_plain_ones(scored):
    pdf = scored.toPandas()
    health = Z.HealthEnsemble(members=["a", "b", "c"], method="weighted", label="truth").fit(scored.withColumn("a", F.col("truth") * 0.9))
    assert health.weights["a"] == pytest.approx(1) and health.weights["b"] == health.weights["c"] == 0
    votes = Z.AnomalyEnsemble(members=["d", "e"], method="weighted").fit(scored)
    raw = np.array([1 / (pdf["d_score"].abs().mean() + 1e-8), 1 / (pdf["e_score"].abs().mean() + 1e-8)])
    assert list(votes.weights.values()) == pytest.approx(list(raw / raw.sum()))
    none = Z.HealthEnsemble(members=["b", "c"], method="weighted", label="truth").fit(scored)
    assert none.weights == {"b": 0.5, "c": 0.5}


def test_families_come_back_whole(spark, folder):
    rng = np.random.default_rng(1)
    rows = [(i, "AB"[i % 2], START + dt.timedelta(hours=i), *[float(v) for v in rng.normal(size=2)], int(rng.random() > 0.6), float(rng.random())) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, equipment_id string, timestamp timestamp, x double, z double, y int, health double")
    made = {
        "anomaly": N.train_anomaly_models(df, ["x", "z"], ["id"], ["timestamp"], "x", {"trees": 3, "sequence_length": 6, "voting_method": "weighted"}),
        "failure": Q.FailureModels({"failure_rf": Q.fit_failure_forest(df, ["x", "z"], "y", 3, 2), "failure_sequence": Q.fit_failure_sequence(df, "x", "y", ["timestamp"], 6, hidden=(3,), rounds=2)},
                                   Z.FailureEnsembleModel({"failure_rf": 3.0, "failure_sequence": 1.0})._set(members=["failure_rf", "failure_sequence"], method="weighted")),
        "health": Q.train_health_models(df, ["x", "z"], "health", {"models": ["health_rf", "health_cluster"], "clusters": 2, "trees": 2, "depth": 2, "voting_method": "weighted"}),
    }
    for kind, family in made.items():
        W.save_family(spark, family, folder, 1, {n: {"f1_score": 0.5} for n in family.models})
        back = W.load_family(spark, folder, kind, 1)
        a, b = (f.score(df).orderBy("id").toPandas() for f in (family, back))
        pd.testing.assert_frame_equal(a, b)
        told = W.members(spark, folder, kind, 1).collect()
        assert [r["name"] for r in told] == list(family.models) and sum(r["weight"] for r in told) == pytest.approx(1)
        with pytest.raises(FileExistsError):
            W.save_family(spark, family, folder, 1)


# --- forecast ---------------------------------------------------------------------


def plain_forecast(pdf, first, span, times):
    """Both least squares by stacked rows, penalties as further rows."""
    day = lambda t: t.astype("datetime64[us]").astype("int64") / Y.DAY_US
    bends = [0.8 * (j + 1) / 4 for j in range(3)]
    turns = [2 * np.pi * k / length for length, n in SEASONS.values() for k in range(1, n + 1)]
    line = lambda d: np.column_stack([np.ones(len(d)), (d - first) / span, *[np.maximum((d - first) / span - b, 0) for b in bends]])
    wave = lambda d: np.column_stack([f(w * d) for w in turns for f in (np.sin, np.cos)])
    ridge = lambda x, y, p: np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(p))]), np.r_[y, np.zeros(len(p))], rcond=None)[0]
    scale = pdf["v"].abs().max() or 1.0
    d, y = day(pdf["timestamp"].to_numpy()), pdf["v"].to_numpy() / scale
    a = ridge(line(d), y, [Y.LEAST] * 2 + [Y.STIFFNESS] * 3)
    level = line(d) @ a
    b = ridge(wave(d) * level[:, None], y - level, [Y.DAMPING] * 2 * len(turns))
    t = day(times)
    return scale * (line(t) @ a) * (1 + wave(t) @ b)


SEASONS = {"week": (7.0, 2), "day": (1.0, 1)}


def test_forecast_equals_a_plain_one(spark):
    rng = np.random.default_rng(2)
    rows = []
    for name, n in (("A", 300), ("B", 120), ("C", 1)):
        for i in range(n):
            at = START + dt.timedelta(hours=7 * i)
            season = 1 + 0.3 * np.sin(2 * np.pi * i * 7 / 168) + 0.2 * np.cos(2 * np.pi * 7 * i / 24)
            rows.append((name, at, float((5 + 0.02 * i + 0.05 * max(i - 150, 0)) * season + rng.normal() * 0.05)))
    rows += [("A", START, None), ("A", START, float("nan")), (None, START, 1.0), ("Z", START, 0.0)]
    df = spark.createDataFrame(rows, "equipment_id string, timestamp timestamp, v double").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    model = Y.fit_forecast(df, "v", seasons=SEASONS, bends=3)
    out = model.predict(10, "6 hours").toPandas()
    usable = pd.DataFrame([r for r in rows if r[0] and r[2] is not None and r[2] == r[2]], columns=["equipment_id", "timestamp", "v"])
    days = usable["timestamp"].to_numpy().astype("datetime64[us]").astype("int64") / Y.DAY_US
    for name, part in usable.groupby("equipment_id"):
        got = out[out["equipment_id"] == name].sort_values("timestamp")
        assert len(got) == len(part) + 10
        assert np.allclose(got["yhat"], plain_forecast(part, days.min(), days.max() - days.min(), got["timestamp"].to_numpy()), atol=1e-6)
    fit = usable.merge(out, on=["equipment_id", "timestamp"])
    assert np.abs(fit["yhat"] - fit["v"])[fit["equipment_id"] == "A"].mean() < 0.3
    assert model.predict(0).count() == len(usable)
    again = Y.fit_forecast(df.repartition(7), "v", seasons=SEASONS, bends=3).predict(0).toPandas()
    assert np.allclose(again.sort_values(["equipment_id", "timestamp"])["yhat"], out.merge(usable[["equipment_id", "timestamp"]]).sort_values(["equipment_id", "timestamp"])["yhat"])
    assert Y.fit_forecast(df.limit(0), "v", seasons=SEASONS, bends=3).predict(5).count() == 0


def test_old_forecast_without_steps(spark, sf):
    from millwatch.operators import failure as P

    assert P.forecast(X.plant(spark, sf), 0).count() == 0


# --- exact selection --------------------------------------------------------------


def test_quantiles_are_exact_on_hard_columns(spark):
    rng = np.random.default_rng(3)
    n = 500
    columns = {
        "normal": rng.normal(size=n), "copies": rng.integers(0, 3, n).astype(float), "wide": np.exp(rng.normal(size=n) * 200) * rng.choice([-1, 1], n),
        "near": 1.0 + rng.integers(0, 50, n) * 2.0 ** -52, "tiny": rng.integers(-5, 6, n) * 5e-324, "zero": np.zeros(n),
        "ends": rng.choice([-np.inf, np.inf, 1.5, -1.7e308, 1.7e308], n, p=[0.01, 0.01, 0.48, 0.25, 0.25]),
    }
    pdf = pd.DataFrame(columns)
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in pdf.to_numpy()]
    names = list(columns)
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} double" for c in [*names, "empty"]))
    ps = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, [*names, "empty"], ps)
    assert len(got) == len(names) * len(ps)
    for j, c in enumerate(names):
        known = np.sort(np.array([r[j] for r in rows if r[j] is not None]))
        for p in ps:
            at = p * (len(known) - 1)
            low, high = known[int(np.floor(at))], known[int(np.ceil(at))]
            want = low if low == high else low + (high - low) * (at - int(at))
            assert got[c, p] == want or np.isnan(want) and np.isnan(got[c, p]), (c, p)


def test_quantiles_leave_the_plan_without_buffers(spark, sf):
    from millwatch.operators import cleaning as B

    plan = B.impute_median(X.dirty_plant(spark, sf), ["value", "rpm"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan and "Exchange" not in plan


# --- running totals ---------------------------------------------------------------


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_running_sums_equal_plain_ones(spark, by):
    rng = np.random.default_rng(4)
    rows = [(None if g == 3 else int(g), "xy"[int(h)], i, None if i % 17 == 0 else int(n)) for i, (g, h, n) in enumerate(zip(rng.choice(5, 400, p=[0.8, 0.05, 0.05, 0.05, 0.05]), rng.integers(0, 2, 400), rng.integers(0, 9, 400)))]
    df = spark.createDataFrame(rows, "g int, h string, i int, n int").repartition(5)
    out = running_sums(df, by, ["i"], ["n"])
    got = {r["i"]: r["_upto_n"] for r in out.collect()}
    totals, want = {}, {}
    for g, h, i, n in sorted(rows, key=lambda r: r[2]):
        key = tuple({"g": g, "h": h}[c] for c in by)
        totals[key] = want[i] = totals.get(key, 0) + (n or 0)
    assert got == want
    assert running_sums(df.limit(0), by, ["i"], ["n"]).count() == 0


def test_auc_and_split_move_no_rows_to_one_place(spark, sf):
    df = X.plant(spark, sf).withColumn("y", (F.col("value") > 0.5).cast("int"))
    for out in (V.auc(df, "y", "rpm"), V.stratified_split(df, "y", X.PLANT_ORDER), V.with_class_weights(df, "y")):
        plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        # Only sums of partitions and totals of ranges meet in one place.
        below = [plan[m.end():].split("\n")[1] for m in re.finditer("SinglePartition", plan)]
        assert all("partial_" in line or "_part#" in line for line in below), below
    weights = V.with_class_weights(df, "y").groupBy("y").agg(F.avg("weight").alias("w"), F.count("*").alias("n")).collect()
    assert sum(r["w"] * r["n"] for r in weights) == pytest.approx(df.count())


# --- cool-down --------------------------------------------------------------------


def plain_cooldown(rows, gap):
    last, kept = {}, []
    for rule, at, alert in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if rule not in last or at - last[rule] >= gap:
            last[rule] = at
            kept.append(alert)
    return sorted(kept)


@pytest.mark.parametrize("seconds, fan", [(300, 64), (7, 2), (40_000, 3)])
def test_cooldown_equals_a_walk(spark, seconds, fan, monkeypatch):
    """Bursts of many alerts within one gap, long silences, single alerts, repeated instants."""
    monkeypatch.setattr(I, "FAN", fan)
    rng = np.random.default_rng(seconds)
    rows = []
    for rule, n, wide in (("dense", 900, 3_000), ("sparse", 40, 900_000), ("one", 1, 10), ("same", 30, 1)):
        rows += [(rule, START + dt.timedelta(seconds=int(rng.integers(0, wide)), microseconds=int(rng.integers(0, 3))), f"{rule}{i:04}") for i in range(n)]
    df = spark.createDataFrame(rows, "rule string, timestamp timestamp, alert_id string").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        got = sorted(r["alert_id"] for r in I.cooldown(df, seconds=seconds).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_cooldown(rows, dt.timedelta(seconds=seconds))


def test_maps_compose():
    rng = np.random.default_rng(6)
    for _ in range(200):
        gap = int(rng.integers(1, 30))
        at = np.unique(rng.integers(0, 200, rng.integers(1, 60)))
        cuts = np.sort(rng.integers(0, len(at) + 1, 3))
        parts = [p for p in np.split(at, cuts) if len(p)]
        maps = [I.EntryMap.of(p, gap) for p in parts]
        whole = maps[0]
        for m in maps[1:]:
            whole = whole.then(m, gap)
        for entry in [I._NEVER, *range(int(at[0]), int(at[0]) + gap)]:
            left = entry
            for t in at.tolist():
                left = t + gap if t >= left else left
            assert int(whole.leave(np.array([entry]), gap)[0]) == left


# --- forest -----------------------------------------------------------------------


def test_forest_is_whole_and_the_same_anywhere(spark):
    rng = np.random.default_rng(7)
    rows = [(i % 50, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(6000, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    forests = [N.fit_isolation_forest(d, ["a", "b"], ["id"], trees=40, sample=64) for d in (df.repartition(7), df.coalesce(1))]
    assert [len(f.trees) for f in forests] == [40, 40] and forests[0].cut == forests[1].cut
    for x, y in zip(*(f.trees for f in forests)):
        assert all((a == b).all() for a, b in zip(x, y))
    for copies in (spark.range(3000).select((F.col("id") % 3).alias("id"), F.lit(1.0).alias("a"), (F.col("id") % 3).cast("double").alias("b")),
                   spark.range(5).select("id", F.col("id").cast("double").alias("a"), F.lit(0.0).alias("b"))):
        model = N.fit_isolation_forest(copies, ["a", "b"], ["id"], trees=20, sample=64)
        assert len(model.trees) == 20 and model.score(copies).count() == copies.count()


def test_draws_have_the_chance_asked_for():
    hashes = np.random.default_rng(8).integers(0, 1 << 63, 20000).astype("uint64")
    row, tree, place = N._draws(hashes, 100, 0.03)
    assert abs(len(row) / (20000 * 100) - 0.03) < 0.0005 and (np.bincount(tree, minlength=100) > 450).all()
    assert len(set(zip(row.tolist(), tree.tolist()))) == len(row) and 0.49 < place.mean() < 0.51
    assert len(N._draws(hashes[:10], 7, 1.0)[0]) == 70


# --- versions ---------------------------------------------------------------------


def test_versions_share_what_did_not_change(spark, folder, monkeypatch):
    one = spark.range(2000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    two = one.withColumn("v", F.when(F.col("id") == 5, "changed").otherwise(F.col("v")))
    assert U.add_version(one, folder, 1, "first", buckets=16) == 16
    assert U.add_version(two.repartition(3), folder, 2, "second", buckets=16) <= 2
    assert U.add_version(one.orderBy(F.desc("id")), folder, 3, "back", buckets=16) == 0
    assert U.checkout(spark, folder, 3).exceptAll(one).count() == 0 and U.checkout(spark, folder, 2).exceptAll(two).count() == 0
    changes = U.version_difference(spark, folder, 1, 2).collect()
    assert sorted((r["id"], r["v"], r["change"]) for r in changes) == [(5, "5", "removed"), (5, "changed", "added")]
    read = []
    monkeypatch.setattr(U, "_read", lambda s, schema, paths, real=U._read: read.append(paths) or real(s, schema, paths))
    assert U.version_difference(spark, folder, 1, 3).count() == 0 and read == [[], []]
    with pytest.raises(FileExistsError):
        U.add_version(two, folder, 1, "again")


def test_a_failed_write_leaves_no_version(spark, folder):
    good = spark.range(100).select("id", F.lit("a").alias("v"))
    U.add_version(good, folder, 1, "first", buckets=4)
    broken = good.withColumn("v", F.when(F.col("id") == 50, F.raise_error(F.lit("lost"))).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        U.add_version(broken, folder, 2, "second", buckets=4)
    assert [r["version"] for r in U.history(spark, folder).collect()] == [1]
    with pytest.raises(FileNotFoundError):
        U.checkout(spark, folder, 2)
    assert U.add_version(good.limit(0), folder, 2, "empty", buckets=4) == 0 and U.checkout(spark, folder, 2).count() == 0
    assert U.version_difference(spark, folder, 1, 2).where("change = 'removed'").count() == 100


def test_a_key_makes_one_vector(spark):
    """Rows of all keys in all tasks: each key's are brought together before they are folded, those of a large key in lots."""
    from millwatch.operators import forecast as Y

    rows = [(f"e{i % 50}" if i < 2000 else "hot", i / 7.0, float(i % 11)) for i in range(2400)]
    df = spark.createDataFrame(rows, "equipment_id string, day double, y double").repartition(4)
    line = lambda numbers: (np.column_stack([np.ones(len(numbers)), numbers[:, 0].astype(float)]), numbers[:, 1].astype(float))
    whole, lots = (Y._parts(df, "equipment_id", 2, line, n) for n in (1000, 100))
    assert whole.count() == 51 and 51 <= lots.count() <= 54
    a, b = ({r["equipment_id"]: r["sums"] for r in Y._folded(p, "equipment_id").collect()} for p in (whole, lots))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a) and a["hot"][0] == 400 and a["e3"][0] == 40
