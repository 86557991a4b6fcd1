"""Cleaning: duplicates, sparse columns, imputation, outliers, types, fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwatch.plans.quantiles import exact_quantiles, quantile_struct
from millwatch.schemas import MEASURES

MISSING_THRESHOLD = 0.5
OUTLIER_FACTOR = 1.5


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def remove_duplicates(df: DataFrame, watermark: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicates; on a stream, duplicates inside the watermark delay."""
    if df.isStreaming:
        source = df.withWatermark("timestamp", watermark) if watermark else df
        return source.dropDuplicatesWithinWatermark(list(keys or [c for c in df.columns if c != "metadata"]))
    return df.dropDuplicates(list(keys) if keys else None)


def null_profile(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """Share of missing cells of every column and whether it exceeds the threshold."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], df.columns, "column", "null_ratio").withColumn(
        "dropped", F.col("null_ratio") > threshold)


def drop_sparse(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """Drop columns with too many missing cells. Reads one small row of names first."""
    sparse = [row["column"] for row in null_profile(df, threshold).filter("dropped").collect()]
    return df.drop(*sparse)


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct ``q``: the most frequent value of each column, ties to the smallest."""
    counts = (
        df.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    return counts.agg(F.struct(*[
        F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in columns]).alias("q"))


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or text_columns(df))
    if not columns:
        return df
    out = df.withColumn("_q", column_modes(df, columns).scalar())
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_q")[c]) for c in columns}).drop("_q")


def impute_median(df: DataFrame, features: Sequence[str], targets: Sequence[str] = ()) -> DataFrame:
    """Missing features get the column's median, missing targets get 0."""
    out = df.withColumn("_q", quantile_struct(df, features, [0.5]))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("_q")[f"{c}_0"]) for c in features}
    return out.withColumns(filled).drop("_q").na.fill(0, list(targets))


def iqr_bounds(df: DataFrame, column: str, factor: float = OUTLIER_FACTOR) -> tuple[float, float] | None:
    """Lower and upper fence of one column, None without values."""
    found = exact_quantiles(df, [column], [0.25, 0.75])
    if not found:
        return None
    low, high = found[column, 0.25], found[column, 0.75]
    return low - factor * (high - low), high + factor * (high - low)


def remove_outliers(df: DataFrame, columns: Sequence[str] | None = None, factor: float = OUTLIER_FACTOR) -> DataFrame:
    """Keep rows inside the fences of each column in turn; a missing cell is no outlier.

    The fences of a column are those of the rows its predecessors left, so the columns
    are settled one after the other. Only the fences are brought back, and the result is
    a plain chain of filters on the input.
    """
    for c in columns or numeric_columns(df):
        fences = iqr_bounds(df, c, factor)
        if fences:
            df = df.filter(F.col(c).isNull() | F.col(c).between(*fences))
    return df


def coerce_types(df: DataFrame, columns: Sequence[str] = MEASURES, time: str = "timestamp") -> DataFrame:
    """Parse the time (bad text raises) and turn measures into numbers (bad text is NULL)."""
    changes: dict[str, Column] = {}
    if time in df.columns and isinstance(df.schema[time].dataType, T.StringType):
        changes[time] = F.to_timestamp(time)
    for c in columns:
        if c in df.columns:
            changes[c] = F.col(c).try_cast("double")
    return df.withColumns(changes) if changes else df


def keep_recent(df: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days before a given instant."""
    return df.filter(F.col("timestamp") >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS"))


def clean(df: DataFrame, missing_threshold: float = MISSING_THRESHOLD, outlier_factor: float = OUTLIER_FACTOR,
          block: str | None = "equipment_id", row_id: Sequence[str] = (), measures: Sequence[str] | None = None) -> DataFrame:
    """The whole cleaning chain: duplicates, sparse columns, imputation, outliers, types."""
    from millwatch.operators.knn import impute_knn

    df = drop_sparse(remove_duplicates(df), missing_threshold)
    numbers = [c for c in (measures or numeric_columns(df, row_id)) if c in df.columns]
    df = impute_knn(df, numbers, row_id, block)
    df = impute_mode(df, text_columns(df))
    return coerce_types(remove_outliers(df, numbers, outlier_factor))
