"""Models have no SQL twin: these are the properties they must have."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch import fixtures as X
from millwatch.operators import anomaly as N, evaluation as V, failure as P, features as C, knn as K, learners as Q
from millwatch.operators.cleaning import clean
from millwatch.operators.ensembles import FailureEnsembleModel
from millwatch.operators.families import load_family
from millwatch.sources.models import list_models, load_model

FEATURES = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def planted(spark):
    """A thousand normal rows and fifty shifted ones, five features."""
    rng = np.random.default_rng(42)
    x = np.vstack([rng.normal(0, 1, (1000, 5)), rng.normal(3, 0.5, (50, 5))])
    rows = [(i, int(i >= 1000), *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id int, label int, " + ", ".join(f"{f} double" for f in FEATURES)).persist()


@pytest.fixture(scope="module")
def failing(spark):
    """Ten features; the label follows the first two and some noise; a health score beside it."""
    rng = np.random.default_rng(7)
    x, noise = rng.normal(0, 1, (1500, 10)), rng.normal(0, 1, 1500)
    y = (x[:, 0] + x[:, 1] + 0.5 * noise > 1).astype(int)
    health = 1 / (1 + np.exp(-(x[:, 0] - x[:, 2])))
    rows = [(i, int(y[i]), float(health[i]), *map(float, x[i])) for i in range(1500)]
    return spark.createDataFrame(rows, "id int, y int, health double, " + ", ".join(f"x{j} double" for j in range(10))).persist()


WIDE = [f"x{j}" for j in range(10)]


def test_detectors_rank_planted_outliers_first(planted):
    family = N.train_anomaly_models(planted, FEATURES, ["id"], config={"trees": 50, "contamination": 0.05, "nu": 0.05})
    scored = family.score(planted).persist()
    for name in family.models:
        flagged = scored.filter(F.col(name) == -1)
        share = flagged.count() / 1050
        assert 0.03 < share < 0.07, name
        assert flagged.filter("label = 1").count() / flagged.count() > 0.6, name
    metrics = family.evaluate(scored, "label")
    assert {r["model"] for r in metrics.collect()} == {"isolation_forest", "one_class_kernel", "ensemble"}
    picked = family.detect(scored, metrics).agg(F.first("model_used"), F.count(F.when(F.col("prediction") == -1, 1))).first()
    assert picked[0] in {"isolation_forest", "one_class_kernel", "ensemble"} and picked[1] > 10


def test_isolation_forest_is_the_same_on_every_run(planted):
    a, b = (N.fit_isolation_forest(df, FEATURES, ["id"], trees=10) for df in (planted, planted.repartition(7)))
    assert a.cut == b.cut and all((x[1] == y[1]).all() for x, y in zip(a.trees, b.trees, strict=True))


@pytest.mark.parametrize("rows", [40, 200, 1050])
def test_isolation_forest_draws_by_one_rule(planted, rows):
    """Each tree has the rows of its smallest hashes among all, below and above twice the pool of 4 * 16 rows."""
    df = planted.filter(F.col("id") < rows)
    forest = N.fit_isolation_forest(df, FEATURES, ["id"], trees=4, sample=16)
    for t, tree in enumerate(forest.trees):
        pick = F.shiftrightunsigned(F.xxhash64(F.lit(t), F.xxhash64(F.lit(N.SEED), "id")), 1)
        points = df.orderBy(pick, *FEATURES).limit(16).select(*FEATURES).toPandas().to_numpy()
        nodes = N._grow(points, np.random.default_rng([N.SEED, t]), 4)
        want = N.pd.DataFrame(nodes, columns=N.NODE)
        assert all((want[c].to_numpy() == got).all() for c, got in zip(N.NODE, tree, strict=True))


def test_detectors_come_back_from_disk(spark, sf, planted, folder):
    p = X.plant(spark, sf)
    made = [(N.fit_isolation_forest(planted, FEATURES, ["id"], trees=8), planted), (N.fit_one_class(planted, FEATURES, size=32), planted),
            (N.fit_sequence_reconstruction(p, "temperature", X.PLANT_ORDER, length=10, components=2), p)]
    for model, df in made:
        N.save_detector(spark, model, f"{folder}/{model.name}")
        again = N.load_detector(spark, f"{folder}/{model.name}")
        count = lambda m: m.score(df).filter(F.col(m.name) == -1).count()  # noqa: B023, E731
        assert count(again) == count(model) > 0


def test_retrain_detectors_and_scorers(spark, planted, failing, folder):
    metrics = N.retrain_anomaly(planted, FEATURES, ["id"], "label", folder, 3, {"trees": 10, "contamination": 0.05, "nu": 0.05})
    assert metrics.count() == 3
    assert N.load_detector(spark, f"{folder}/detectors/isolation_forest/version=3").features == FEATURES
    fits = Q.retrain_health(failing, WIDE, "health", ["id"], folder, 1, config={"trees": 10, "depth": 5, "rounds": 5})
    assert fits.filter("model = 'health_rf'").first()["r2_score"] > 0.2
    decided = []
    moved = failing.select("x0", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 31)").alias("timestamp"))
    still = Q.retrain_if_drifted(moved.withColumn("x0", F.lit(1.0)), "2024-01-31", ["x0"], lambda: decided.append(1))
    assert still is None and decided == []
    shifted = moved.withColumn("x0", F.col("x0") + F.when(F.col("timestamp") > F.lit("2024-01-24").cast("timestamp_ntz"), 5.0).otherwise(0.0))
    Q.retrain_if_drifted(shifted, "2024-01-31", ["x0"], lambda: decided.append(1))
    assert decided == [1]


def test_sequence_errors_and_padding(spark, sf):
    p = X.plant(spark, sf)
    model = N.fit_sequence_reconstruction(p, "temperature", X.PLANT_ORDER, length=20, components=4)
    out = model.score(p).toPandas()
    short = out.sort_values(X.PLANT_ORDER).groupby("equipment_id").head(19)
    assert (short["sequence_reconstruction"] == 1).all() and (short["sequence_reconstruction_score"] == 0).all()
    assert 0.02 < (out["sequence_reconstruction"] == -1).mean() < 0.06


def test_sequences_with_gaps(spark):
    """One missing value costs no window: it keeps its place, and the models see the value before it."""
    value = lambda i: float(i * i % 23 + 80 * (i == 33))
    rows = [(f"e{k}", i, value(i + 3 * k), None if (k, i) in ((0, 0), (0, 9), (0, 10)) or k == 2 else value(i + 3 * k), i % 2) for k in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "equipment_id string, at int, plain double, gaps double, y int")
    windows = {(r["equipment_id"], r["at"]): r["sequence"] for r in C.sequence_windows(df, ["at"], "gaps", length=4).collect()}
    assert len(windows) == 3 * 37 and windows["e0", 11] == [value(8), None, None, value(11)] and windows["e2", 20] == [None] * 4
    filled = {(r["equipment_id"], r["at"]): r["f"] for r in C.sequence_windows(df, ["at"], "gaps", length=4).select("*", C.filled_sequence().alias("f")).collect()}
    assert filled["e0", 11] == [value(8)] * 3 + [value(11)] and filled["e0", 3] == [value(1)] + [value(i) for i in (1, 2, 3)]
    assert filled["e2", 20] is None and filled["e1", 20] == windows["e1", 20]
    errors = N.fit_sequence_reconstruction(df, "gaps", ["at"], length=4, components=2).score(df).toPandas()
    seen = errors[errors["sequence_reconstruction_score"] != 0]
    assert len(errors) == 120 and set(seen["equipment_id"]) == {"e0", "e1"} and {9, 10, 11, 12} <= set(seen[seen["equipment_id"] == "e0"]["at"])
    out = Q.fit_failure_sequence(df, "gaps", "y", ["at"], length=4, hidden=(3,), rounds=5).score(df).toPandas()
    full = (out["at"] >= 3) & (out["equipment_id"] != "e2")
    assert len(out) == 120 and (out[full]["failure_sequence"] > 0).all() and (out[~full]["failure_sequence"] == 0).all()


def test_unknown_kinds_raise(planted, failing):
    for call in (lambda: N.train_anomaly_models(planted, FEATURES, ["id"], config={"models": ["x"]}),
                 lambda: Q.train_failure_models(failing, WIDE, "y", F.col("id"), {"models": ["x"]}),
                 lambda: Q.train_health_models(failing, WIDE, "health", {"models": ["x"]})):
        with pytest.raises(ValueError):
            call()


def test_failure_family_retrain_and_store(spark, failing, folder):
    config = {"trees": 20, "depth": 6, "rounds": 8, "voting_method": "weighted"}
    metrics = Q.retrain_failure(failing, WIDE, "y", ["id"], folder, 1, config)
    rows = {r["model"]: r for r in metrics.collect()}
    assert set(rows) == {"failure_rf", "failure_gbt", "ensemble"}
    assert all(r["auc"] > 0.8 for r in rows.values())
    assert {r["model"] for r in list_models(spark, folder).collect()} == {"failure_rf", "failure_gbt"}
    scorer = Q.Scorer("failure_rf", "probability", WIDE, load_model(spark, folder, "failure_rf"))
    assert scorer.score(failing).agg(F.min("failure_rf") >= 0, F.max("failure_rf") <= 1).first() == (True, True)
    assert [r["feature"] for r in scorer.importances(spark).limit(2).collect()] in (["x0", "x1"], ["x1", "x0"])
    family = load_family(spark, folder, "failure", 1)
    assert set(family.models) == {"failure_rf", "failure_gbt"} and sum(family.ensemble.weights.values()) == pytest.approx(1)
    alone = Q.FailureModels({"failure_rf": scorer}, FailureEnsembleModel({"failure_rf": 1.0})._set(members=["failure_rf"], method="soft"))
    scored = alone.score(failing)
    one = V.binary_evaluation(scored, "y", "failure_probability").first()
    assert one["auc"] > 0.9 and set(P.maintenance_recommendations(scored).select("urgency").distinct().toPandas()["urgency"]) <= {"high", "medium"}


def test_best_failure_model_may_be_the_ensemble(failing):
    family = Q.train_failure_models(failing, WIDE, "y", F.col("id"), {"trees": 10, "depth": 4, "rounds": 4})
    scored = family.score(failing)
    metrics = family.evaluate(scored, "y")
    best = max(metrics.collect(), key=lambda r: r["auc"])["model"]
    assert family.predict(scored, metrics).first()["model_used"] == best


@pytest.mark.parametrize("method", ["average", "weighted", "median"])
def test_health_family(failing, method):
    config = {"models": ["health_rf", "health_gbt", "health_cluster"], "trees": 10, "depth": 5, "rounds": 5, "voting_method": method}
    family = Q.train_health_models(failing, WIDE, "health", config)
    scored = family.score(failing).persist()
    low, high = scored.agg(F.min("health_score"), F.max("health_score")).first()
    assert 0 <= low <= high <= 1
    fits = {r["model"]: r["r2_score"] for r in family.evaluate(scored, "health").collect()}
    assert fits["health_rf"] > 0.3 and len(fits) == 4
    if method == "weighted":
        assert fits["ensemble"] > 0.3


def test_health_network_and_sequence_classifier(spark, sf, failing):
    net = Q.fit_health_network(failing, WIDE, "health", hidden=(16, 8), rounds=40)
    fit = net.score(failing).agg(F.corr("health_mlp", "health"), F.min("health_mlp"), F.max("health_mlp")).first()
    assert fit[0] > 0.8 and fit[1] >= 0 and fit[2] <= 1
    p = X.plant(spark, sf).withColumns({"heat": (F.col("temperature") - 36) / 49, "y": (F.col("temperature") > 70).cast("int")})
    out = Q.fit_failure_sequence(p, "heat", "y", X.PLANT_ORDER, length=10, hidden=(8,), rounds=40).score(p)
    assert V.auc(out, "y", "failure_sequence").first()["auc"] > 0.8


def test_cluster_health_is_one_at_the_centre_and_zero_at_the_far_end(failing):
    out = Q.fit_health_clusters(failing, WIDE).score(failing).agg(F.min("health_cluster"), F.max("health_cluster"), F.countDistinct("cluster")).first()
    assert out[0] == 0 and 0 < out[1] <= 1 and out[2] == 5


def test_model_scores_a_stream(spark, failing, folder):
    from millwatch.streaming import jobs as T

    failing.write.parquet(f"{folder}/in")
    model = Q.fit_failure_forest(failing, WIDE, "y", trees=5, depth=3)
    rows = model.score(spark.readStream.schema(failing.schema).parquet(f"{folder}/in"))
    T.await_done(T.to_parquet(rows, f"{folder}/out", f"{folder}/c"))
    assert spark.read.parquet(f"{folder}/out").count() == 1500


# --- nearest neighbours -----------------------------------------------------------


def brute_force(pdf, columns, k=5):
    """All distances, row by row, with gaps in any column."""
    x = pdf[columns].to_numpy(dtype="float64")
    out = x.copy()
    ids = pdf["id"].to_numpy()
    folded = {}
    for i, row in enumerate(map(tuple, np.where(np.isnan(x), -1e18, x))):
        folded[row] = min(folded.get(row, ids[i]), ids[i])
    first = np.array([folded[tuple(r)] for r in np.where(np.isnan(x), -1e18, x)])
    for i, j in zip(*np.where(np.isnan(x)), strict=True):
        both = ~np.isnan(x) & ~np.isnan(x[i])
        shared = both.sum(axis=1)
        square = np.where(both, (x - x[i]) ** 2, 0.0).sum(axis=1)
        usable = (shared > 0) & ~np.isnan(x[:, j])
        if not usable.any():
            out[i, j] = np.nanmean(x[:, j])
            continue
        distance = square[usable] * len(columns) / shared[usable]
        order = np.lexsort((ids[usable], first[usable], np.round(distance, 12)))[:k]
        out[i, j] = x[usable][order, j].mean()
    return out


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_knn_equals_brute_force(spark, levels):
    rng = np.random.default_rng(levels)
    x = rng.normal(0, 1, (400, 3))
    x[:150] = x[0]  # a heap of copies
    x[rng.random((400, 3)) < 0.08] = np.nan
    x[7] = np.nan  # nothing known: the mean
    rows = [(i, "A", *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, equipment_id string, a double, b double, c double")
    got = K.impute_knn(df, ["a", "b", "c"], ["id"], levels=levels).orderBy("id").toPandas()
    expected = brute_force(df.orderBy("id").toPandas(), ["a", "b", "c"])
    assert np.allclose(got[["a", "b", "c"]].to_numpy(), expected, atol=1e-9)


def test_a_far_value_fills_no_cell(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 0, *map(float, rng.normal(size=2))) for i in range(4000)]
    largest = []
    for far in ([], [(9999, 0, 1e15, -1e15)]):
        df = spark.createDataFrame(rows + far, "_id int, _block int, x0 double, x1 double")
        largest.append(K._placed(df, ["x0", "x1"], 16).groupBy("ix0", "ix1").count().agg(F.max("count")).first()[0])
    assert largest[0] < 60 and largest[1] <= 1.2 * largest[0]


def test_knn_stays_inside_its_block_or_not(spark):
    rows = [(i, "A", 1.0, float(i)) for i in range(6)] + [(i + 10, "B", 1.0, 100.0 + i) for i in range(6)] + [(99, "B", 1.0, None)]
    df = spark.createDataFrame(rows, "id int, equipment_id string, a double, b double")
    inside = K.impute_knn(df, ["a", "b"], ["id"]).filter("id = 99").first()["b"]
    across = K.impute_knn(df, ["a", "b"], ["id"], block=None).filter("id = 99").first()["b"]
    assert inside == 102.0 and across == 2.0


def test_cleaning_chain(spark, sf):
    p = X.dirty_plant(spark, sf)
    out = clean(p.unionByName(p.limit(20)), row_id=["l_orderkey", "l_linenumber", "l_partkey"], measures=["value", "temperature", "rpm", "load"])
    assert 0 < out.count() <= p.distinct().count()
    assert out.filter("value IS NULL OR value > 2").count() == 0


@pytest.mark.parametrize("kind", ["classes", "numbers"])
def test_boosting_on_cells_is_boosting_on_rows(spark, kind):
    """Rows of equal bins and label are one weighted row to the trainer, and the trees are those of all rows."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    rows = [(float(i % 7), float(i % 5), float(i % 7 + i % 5 > 6), ((i % 7) ** 2 * (i % 5) + (i % 5 - 1) ** 2 + i % 3) / 200) for i in range(2100)]
    df = spark.createDataFrame(rows, "a double, b double, y double, health double")
    label, classes = ("y", True) if kind == "classes" else ("health", False)
    (cuts, ordered, vectors), cells = Q._binned(df, ["a", "b"], label, classes)
    assert cells.count() == 35 and cells.agg(F.sum("weight")).first()[0] == 2100
    assert Q._lots(cells).count() == 35 * Q.LOTS and Q._lots(cells).agg(F.sum("weight")).first()[0] == pytest.approx(2100)
    rows = vectors.transform(ordered.transform(cuts.transform(Q._inputs(df, ["a", "b"]))))
    fit = Q.fit_failure_boosting if classes else Q.fit_health_boosting
    learner = GBTClassifier if classes else GBTRegressor
    plain = learner(labelCol=label, featuresCol="_x", maxIter=4, stepSize=Q.RATE, maxDepth=3, seed=Q.SEED).fit(rows)
    found = fit(df, ["a", "b"], label, rounds=4, depth=3).pipeline.stages[-1]
    points = rows.select("_x").distinct()
    assert all("in {" not in t.toDebugString for t in found.trees)  # thresholds, not sets of categories
    ours, theirs = ([round(r["prediction"], 9) for r in m.transform(points.orderBy(F.col("_x").cast("string"))).collect()]
                    for m in (found.copy({found.predictionCol: "prediction"}), plain))
    assert ours == theirs and len(ours) == 35


# --- networks and series on all rows ----------------------------------------------


def test_network_is_that_of_spark(spark):
    """The same first weights, as good a fit after as many rounds (line searches differ), and one score by NumPy and by Spark."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from millwatch.operators import networks as W

    rng = np.random.default_rng(1)
    x = rng.normal(3, 2, (1200, 5))
    x[:, 4] = 7
    y = (x[:, 0] + x[:, 1] * x[:, 2] / 3 > 5).astype(int) + (x[:, 3] > 4)
    names = [f"x{j}" for j in range(5)]
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], ", ".join(f"{n} double" for n in names) + ", y double").repartition(5)
    vectors = VectorAssembler(inputCols=names, outputCol="_x")
    given = lambda model, rows: np.array([r[0] for r in model.transform(rows).orderBy("x0").select(vector_to_array("probability")).collect()])
    losses, by_x = {}, y[x[:, 0].argsort()]
    for rounds in (0, 20):
        theirs = Pipeline(stages=[vectors, StandardScaler(withMean=True, inputCol="_x", outputCol="_s"), MultilayerPerceptronClassifier(
            layers=[5, 6, 4, 3], maxIter=rounds, seed=42, featuresCol="_s", labelCol="y")]).fit(df)
        mine = W.fit_network(W.packed_rows(df, names, "y"), W.read_rows(5), [5, 6, 4, 3], rounds, 42)
        a, b = given(theirs, df), given(mine, vectors.transform(df))
        losses[rounds] = [-np.log(p[np.arange(1200), by_x]).mean() for p in (a, b)]
        assert rounds or abs(a - b).max() < 1e-9
    assert losses[20][1] < 1.1 * losses[20][0] < 0.6 * losses[0][0]
    own = W.probabilities(x[x[:, 0].argsort()], W.matrices(mine.weights.toArray(), [5, 6, 4, 3]))
    assert abs(own - b).max() < 1e-9


@pytest.mark.parametrize("hot_rows", [10 ** 6, 40])
def test_series_gives_the_windows_of_each_row(spark, hot_rows):
    """Figures of the streamed windows against those of lists, with gaps and hot keys; what is packed holds no window."""
    from millwatch.plans.series import packed_series, unpacked, window_figure

    rows = [(f"e{k}" if k else None, i, None if (i * 7 + k) % 13 == 0 or k == 2 else float(i * i % 31 + k), i % 2) for k in range(4) for i in range(300 if k == 1 else 25)]
    df = spark.createDataFrame(rows, "equipment_id string, at int, v double, y int").repartition(3)
    weight = np.arange(1.0, 6.0)
    got = {(r["equipment_id"], r["at"]): r["f"] for r in window_figure(df, ["at"], "v", 5, lambda w: w @ weight, "f", hot_rows=hot_rows).collect()}
    lists = C.sequence_windows(df, ["at"], "v", 5, keep_short=True).withColumn("sequence", C.filled_sequence()).collect()
    want = {(r["equipment_id"], r["at"]): float(np.array(r["sequence"]) @ weight) if r["sequence"] and len(r["sequence"]) == 5 else None for r in lists}
    assert len(got) == len(rows) and got == want
    packed = packed_series(df, ["at"], "v", 5, "y", hot_rows=hot_rows)
    whole = [(x @ weight, y) for x, y in unpacked(packed.toArrow().to_batches(), 5)]
    assert sorted(np.concatenate([x for x, _ in whole]).tolist()) == sorted(v for v in want.values() if v is not None)
    assert sum(y.sum() for _, y in whole) == sum(i % 2 for (_, i), v in want.items() if v is not None)
    assert packed.agg(F.sum(F.length("series"))).first()[0] < 8 * 3 * len(rows)


def test_sequence_reconstruction_is_that_of_components(spark):
    """Errors and cut against Spark's own components on lists of values."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    value = lambda k, i: float((i * i * 7 + k * i) % 41 + 1000)
    df = spark.createDataFrame([(f"e{k}", i, value(k, i)) for k in range(5) for i in range(90)], "equipment_id string, at int, v double").repartition(3)
    rows = C.sequence_windows(df, ["at"], "v", 6).withColumn("raw", array_to_vector("sequence"))
    out = Pipeline(stages=[StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="c"), PCA(k=2, inputCol="c", outputCol="p")]).fit(rows).transform(rows)
    c, p = (np.array([r[0] for r in out.orderBy("equipment_id", "at").select(vector_to_array(n)).collect()]) for n in "cp")
    want = ((c * c).sum(axis=1) - (p * p).sum(axis=1)) / 6
    model = N.fit_sequence_reconstruction(df, "v", ["at"], length=6, components=2)
    got = model.score(df).where("at >= 5").orderBy("equipment_id", "at").select("sequence_reconstruction_score", "sequence_reconstruction").collect()
    assert abs(np.array([-r[0] for r in got]) - want).max() < 1e-8 and model.cut == pytest.approx(np.quantile(want, 0.95))
    assert [r[1] for r in got] == [-1 if -r[0] > model.cut else 1 for r in got]


def test_forest_scores_go_down_all_trees_at_once():
    """Scores of trees of unlike depth against a walk node by node, missing and endless numbers too."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (700, 3))
    x[0], x[1, 1], x[2] = np.nan, np.inf, -np.inf
    trees = []
    for t, points in enumerate((256, 40, 1, 2)):
        nodes = N.pd.DataFrame(N._grow(x[3:3 + points], np.random.default_rng(t), 8), columns=N.NODE)
        trees.append(tuple(nodes[c].to_numpy() for c in N.NODE))

    def walk(row):
        total = 0.0
        for feature, threshold, left, right, value in trees:
            at = 0
            while feature[at] >= 0:
                at = left[at] if row[feature[at]] < threshold[at] else right[at]
            total += value[at]
        return -2.0 ** (-total / 4 / float(N.average_path(256)))

    got = N._forest_score(trees, 256)(x)
    assert abs(got - [walk(row) for row in x]).max() < 1e-15
    assert len(N._forest_score(trees, 256)(x[:0])) == 0 and N._forest_score(trees[2:3], 256)(x[:2]).tolist() == [-1.0, -1.0]
    features, _, values = N._complete(trees)
    assert values.shape == (4, features.shape[1] + 1)


def test_kernel_scores_come_some_rows_at_a_time():
    """The mean similarity of each row as by its formula, and no more features at once than a block of rows has."""
    rng = np.random.default_rng(5)
    x, size = rng.normal(2, 3, (1300, 4)), 64
    model = N.KernelOneClass(FEATURES[:4], x.mean(axis=0), x.std(axis=0), rng.normal(0, 1, (4, size)), rng.uniform(0, 6, size), rng.normal(0, 1, size))
    want = np.sqrt(2 / size) * np.cos((x - model.mean) / model.spread @ model.weights + model.shift) @ model.centre
    assert abs(model.similarity(x) - want).max() < 1e-12 and len(model.similarity(x[:0])) == 0
    assert [len(m) for m in model.maps(x)] == [512, 512, 276]


def test_clusters_are_fitted_on_tasks_of_bounded_size(failing, monkeypatch):
    """However few partitions the input has, no task of the fit has many more rows than it may; copies of one row do not pile up either."""
    sizes = []

    class Recorder(Q.KMeans):
        def _fit(self, dataset):
            sizes.extend(dataset.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
            return super()._fit(dataset)

    monkeypatch.setattr(Q, "KMeans", Recorder)
    monkeypatch.setattr(Q, "ROWS_PER_CLUSTER_TASK", 100)
    one = failing.coalesce(1)
    Q.fit_health_clusters(one.unionByName(one.limit(1).withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(500))))).coalesce(1), WIDE)
    assert sum(sizes) == 2000 and max(sizes) <= 110


def test_neighbours_are_limited_before_they_are_moved(spark, sf):
    """Of the measured candidates a task sends on no more than may count, and a row's id goes without the name of its block."""
    p = X.dirty_plant(spark, sf)
    plan = K.impute_knn(p, ["value", "temperature"], ["l_orderkey", "l_linenumber", "l_partkey", "equipment_id", "timestamp"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text.split("WindowGroupLimit", 1)[1]
    assert "struct(l_orderkey" in text and ", equipment_id, equipment_id" not in text


def test_network_passes_over_small_scaled_blocks(spark):
    """Rows are held in four bytes an input and one a class; the gradient of a block, whole or the last one, is that in double precision."""
    from millwatch.operators import networks as W

    rng = np.random.default_rng(4)
    layers, x, y = [3, 8, 6, 4], rng.normal(5, 3, (2 * W.BLOCK_ROWS + 100, 3)), rng.integers(0, 4, 2 * W.BLOCK_ROWS + 100)
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], "a double, b double, c double, y double").coalesce(1)
    mean, scale = x.mean(axis=0), 1 / x.std(axis=0)
    blocks = W._scaled(W.packed_rows(df, ["a", "b", "c"], "y"), W.read_rows(3), mean, scale, 4).collect()
    assert [len(b["x"]) for b in blocks] == [12 * len(b["y"]) for b in blocks] and sum(len(b["y"]) for b in blocks) == len(y)
    weights = rng.normal(0, 1, sum((i + 1) * o for i, o in zip(layers, layers[1:])))
    passes = W._Passes(weights, layers)
    got = [passes.slope(np.frombuffer(b["x"], "float32").reshape(-1, 3), np.frombuffer(b["y"], "uint8")) for b in blocks]
    loss, change = W._slope((x - mean) * scale, y, W.matrices(weights, layers))
    assert abs(sum(g[0] for g in got) / loss - 1) < 1e-5
    assert np.allclose(sum(g[1] for g in got), change, rtol=1e-4, atol=1e-5 * abs(change).max())


def test_bands_are_scored_by_blocks(failing):
    """The score of blocks of rows is that of Spark's model; a feature that is no number is refused by both."""
    from pyspark.ml.functions import vector_to_array

    net = Q.fit_health_network(failing, WIDE, "health", hidden=(6,), rounds=3)
    gaps = failing.withColumn("x3", F.when(F.col("id") % 7 != 0, F.col("x3")))
    out = net.score(gaps)
    assert out.columns == [*gaps.columns, "health_mlp"] and "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    theirs = net.pipeline.transform(Q._inputs(gaps, WIDE)).select("id", vector_to_array("_p").alias("p")).orderBy("id").toPandas()
    mine = out.orderBy("id").toPandas()["health_mlp"].to_numpy()
    assert abs(np.array(theirs["p"].tolist()) @ np.array(Q.BAND_MIDDLES) - mine).max() < 1e-12
    with pytest.raises(Exception, match="NaN"):
        net.score(failing.withColumn("x3", F.lit(float("nan")))).collect()


@pytest.mark.parametrize("most", [2000, 150, 40])
def test_small_blocks_are_compared_whole(spark, monkeypatch, most):
    """All blocks whole, some of them, or none: the same neighbours; a whole block has no cells, and its rows move to it once."""
    monkeypatch.setattr(K, "ROWS_COMPARED", most)
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (500, 3))
    x[:60] = x[0]
    x[rng.random((500, 3)) < 0.1] = np.nan
    x[7] = np.nan
    block = ["A" if i < 300 else "B" if i < 400 else "C" if i < 490 else None for i in range(500)]
    rows = [(i, block[i], *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, equipment_id string, a double, b double, c double").repartition(3)
    out = K.impute_knn(df, ["a", "b", "c"], ["id"])
    got = out.orderBy("id").toPandas()
    mean = np.nanmean(x, axis=0)
    for name, at in (("A", slice(0, 300)), ("B", slice(300, 400)), ("C", slice(400, 490))):
        want = brute_force(df.filter(F.col("equipment_id") == name).orderBy("id").toPandas(), ["a", "b", "c"])
        want[np.isnan(x[at]).all(axis=1)] = mean
        assert np.allclose(got[["a", "b", "c"]].to_numpy()[at], want, atol=1e-9)
    assert np.allclose(got[["a", "b", "c"]].to_numpy()[490:], np.where(np.isnan(x[490:]), mean, x[490:]), atol=1e-9)
    base = df.selectExpr("struct(id) AS _id", "equipment_id AS _block", "a AS x0", "b AS x1", "c AS x2")
    plan = K._filled(base, ["x0", "x1", "x2"], 5, 0, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "percentile_approx" not in plan
