"""Running totals along a whole order, without a task that sees all rows.

Rows are dealt by ranges of the order, written once with a running total inside each range, and the
totals of the ranges before are added: one shuffle, the same plan for one class or many, for small
tables and large ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from millwatch.plans.storage import written
from millwatch.session import ship


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Add ``_upto_<amount>``: the sum of a column of whole numbers from 0 on, up to and including the row, in each group of ``by``.

    Rows alike in ``by`` and ``order`` follow each other in no set way. The table is written to the shared folder.
    """
    by, order, amounts = list(by), list(order), list(amounts)
    names = [f"_upto_{a}" for a in amounts]
    ship(df.sparkSession)
    rows = df.withColumns({a: F.coalesce(F.col(a).cast("long"), F.lit(0)) for a in amounts})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shape = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in names]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(amounts, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = []
            for a in amounts:
                sums.append(pc.add(pc.cumulative_sum(batch.column(a)), carried[a]))
                carried[a] = sums[-1][-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], names=[*batch.schema.names, *names])

    # The number of the range is a column before the totals are made, so that both are of one run.
    dealt = rows.repartitionByRange(parts, *by, *order) if by or order else rows
    dealt = dealt.sortWithinPartitions(*by, *order).withColumn("_part", F.spark_partition_id())
    kept = written(dealt.mapInArrow(add, shape), "prefix")
    # Of each range and group: what the range summed before the group began, and at the group's end.
    told = {n: F.min(F.col(n) - F.col(a)).alias(f"_base{n}") for n, a in zip(names, amounts)}
    totals = kept.groupBy("_part", *by).agg(*told.values(), *[F.max(n).alias(f"_top{n}") for n in names])
    ahead = W.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(F.col("_part").alias("_of"), *[F.col(c).alias(f"_by_{c}") for c in by], *[
        (F.coalesce(F.sum(F.col(f"_top{n}") - F.col(f"_base{n}")).over(ahead), F.lit(0)) - F.col(f"_base{n}")).alias(f"_ahead{n}") for n in names])
    # The range is part of the key, so a group of any size is spread as its ranges are.
    same = [F.col("_part") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    return kept.join(carry, same).select(*df.columns, *[(F.col(n) + F.col(f"_ahead{n}")).alias(n) for n in names])
