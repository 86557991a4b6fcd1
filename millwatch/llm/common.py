"""What the training-data operators share: tables, words, and running sums that no hot group can crowd."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Leading hex digits of the shuffle key that cut a source into slices: 4096 of them.
SLICE_DIGITS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(seed: int, doc_id: Column) -> Column:
    """A seeded pseudo-random order over ids, the same in any engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_columns(source: Column) -> dict[str, Column]:
    """Source as two columns without null, which join and sort (by code point, null last) alike."""
    return {"no_source": source.isNull(), "src": F.coalesce(source.cast("string"), F.lit(""))}


def before(df: DataFrame, group: list[str], slice_: Column, order: list[str], amount: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the earlier rows of each group.

    ``slice_`` must not fall along ``order``. Each slice of a group is totalled first, the
    totals are run along the group, and rows are only sorted inside their slice, so a group
    that holds a third of all rows is still spread over many tasks.
    """
    df = df.withColumn("_slice", slice_).withColumn("_amount", amount)
    keys = [*group, "_slice"]
    ahead = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    totals = (df.groupBy(*keys).agg(F.sum("_amount").alias("_total"))
              .select(*keys, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead")))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.join(totals, keys)
            .withColumn(out, F.col("_ahead") + F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .drop("_slice", "_amount", "_ahead"))
