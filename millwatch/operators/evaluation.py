"""Scores of predictions: binary, weighted multi-class, regression, exact AUC, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.plans.prefix import running_sums

EPS = 1e-8


def long_form(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per input row and named column; a narrow map-side explode."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in columns.items()])
    return df.select(*keep, F.inline(pairs))


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, guarded against 0/0."""
    truth, guess = F.col(label) == positive, F.col(prediction) == positive

    def hits(c: Column) -> Column:
        return F.sum(c.cast("long"))

    counts = df.groupBy(*by).agg(
        hits(truth & guess).alias("_tp"), hits(~truth & guess).alias("_fp"),
        hits(truth & ~guess).alias("_fn"), F.count(F.lit(1)).alias("_n"))
    p, q = F.col("precision"), F.col("recall")
    return counts.select(
        *by,
        ((F.col("_n") - F.col("_fp") - F.col("_fn")) / F.col("_n")).alias("accuracy"),
        (F.col("_tp") / (F.col("_tp") + F.col("_fp") + EPS)).alias("precision"),
        (F.col("_tp") / (F.col("_tp") + F.col("_fn") + EPS)).alias("recall"),
    ).withColumn("f1_score", 2 * p * q / (p + q + EPS))


def best_model(metrics: DataFrame, metric: str = "f1_score", name: str = "model") -> DataFrame:
    """The one model with the highest metric; ties go to the first name."""
    return metrics.agg(
        F.min_by(name, F.struct(-F.col(metric), F.col(name))).alias(name), F.max(metric).alias(metric))


def predictions_of_best(df: DataFrame, predictions: Mapping[str, Column], metrics: DataFrame,
                        metric: str = "f1_score", out: str = "prediction") -> DataFrame:
    """Add the winner's prediction and name; the winner is a scalar, so rows stay in place."""
    winner = best_model(metrics, metric).select("model").scalar()
    table = F.create_map(*[x for n, c in predictions.items() for x in (F.lit(n), c)])
    return df.withColumn("model_used", winner).withColumn(out, F.element_at(table, F.col("model_used")))


def weighted_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over classes by their support."""
    cells = df.groupBy(F.col(label).alias("_y"), F.col(prediction).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # Each confusion cell feeds the class it belongs to and the class it was taken for.
    sides = cells.select("_n", (F.col("_y") == F.col("_p")).alias("_hit"), F.inline(F.array(
        F.struct(F.col("_y").alias("class"), F.lit(True).alias("_own")),
        F.struct(F.col("_p").alias("class"), F.lit(False).alias("_own")))))
    n = F.col("_n")
    per_class = sides.groupBy("class").agg(
        F.sum(F.when(F.col("_own"), n).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("_own"), n).otherwise(0)).alias("taken"),
        F.sum(F.when(F.col("_own") & F.col("_hit"), n).otherwise(0)).alias("tp"),
    )
    p = F.when(F.col("taken") > 0, F.col("tp") / F.col("taken")).otherwise(0.0)
    q = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    scored = per_class.withColumns({"p": p, "q": q})
    f1 = F.when(F.col("p") + F.col("q") > 0, 2 * F.col("p") * F.col("q") / (F.col("p") + F.col("q"))).otherwise(0.0)
    total = F.sum("support")
    return scored.withColumn("f", f1).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("p") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("q") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f") * F.col("support")) / total).alias("f1_score"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    y, e = F.col(label), F.col(label) - F.col(prediction)
    return df.groupBy(*by).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("_v"),
    ).select(*by, "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.col("mse") / F.col("_v")).alias("r2_score"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half.

    Rows are folded to distinct scores first; the negatives up to each score are a running
    total over ranges of the scores.
    """
    by = list(by)
    folded = df.filter(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("_pos"), F.sum((F.col(label) != 1).cast("long")).alias("_neg"))
    ordered = running_sums(folded, by, [score], ["_neg"])
    wins = F.col("_pos").cast("double") * (2 * F.col("_upto__neg") - F.col("_neg"))
    return ordered.groupBy(*by).agg(
        (F.sum(wins) / 2 / F.sum("_pos") / F.sum("_neg")).alias("auc"))


def binary_evaluation(df: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Accuracy, AUC, precision, recall and F1 of a probability, as one row."""
    judged = df.withColumn("_guess", (F.col(score) > cut).cast("int"))
    area = auc(df, label, score).scalar()
    return binary_metrics(judged, label, "_guess").withColumn("auc", area)


def hash_bucket(id_column: Column, buckets: int) -> Column:
    """A stable bucket from the md5 of an id: the same on every run and engine."""
    return (F.conv(F.substring(F.md5(id_column.cast("string")), 1, 7), 16, 10).cast("long") % buckets).cast("int")


def stratified_split(df: DataFrame, label: str, row_id: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """Mark each row ``train`` or ``test``: the exact share of each class, by md5 order.

    The rank of a row in its class is a running total over ranges of the md5, which is even, so a class
    of any size is spread evenly. The rank where the test share ends is looked up in a map of the classes.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in row_id])
    placed = df.withColumns({"_hash": F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long"), "_one": F.lit(1)})
    ranked = running_sums(placed, [label], ["_hash", *row_id], ["_one"])
    tests = F.ceil(F.col("n") * test_share)
    out = _of_class(ranked, df, label, tests, "_tests")
    return out.select(*df.columns, F.when(F.col("_upto__one") <= F.col("_tests"), "test").otherwise("train").alias("split"))


def _of_class(rows: DataFrame, counted: DataFrame, label: str, figure: Column, name: str) -> DataFrame:
    """Add a figure of the row's class, made of its count ``n``, from one map of all classes: rows stay where they are.

    A label has few values by its nature; that of a regression is none.
    """
    counts = counted.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("n"))
    key = F.coalesce(F.col("_class").cast("string"), F.lit("\u0000"))
    table = counts.select(F.struct(key.alias("key"), figure.alias("value")).alias("e"))
    table = table.agg(F.map_from_entries(F.collect_list("e")).alias("m")).scalar()
    return rows.withColumn(name, F.element_at(table, F.coalesce(F.col(label).cast("string"), F.lit("\u0000"))))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows over (classes times rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("q")).scalar()
    q = F.col("_q")
    return counts.withColumn("_q", whole).select(label, "n", (q["rows"] / (q["classes"] * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Add the weight of each row's class; rows without a label have none and go."""
    whole = df.where(F.col(label).isNotNull())
    q = whole.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct(label).alias("classes")).alias("q")).scalar()
    out = _of_class(whole.withColumn("_q", q), whole, label, F.col("n"), "_n")
    return out.withColumn("weight", F.col("_q")["rows"] / (F.col("_q")["classes"] * F.col("_n"))).drop("_q", "_n")
