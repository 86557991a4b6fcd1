"""Dataset versions by content: write one, list the history, read one back, compare two.

A version is a list of buckets with the digests of their rows. Rows fall into buckets by their own hash, so a
bucket that did not change has the digest it had, and its files are shared, not written again. The list of a
version is written last and in one go: a version whose write failed is not there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millwatch.plans.storage import exists

#: Parts of a version that may be shared or written anew each by itself.
BUCKETS = 256
#: Tasks that write one bucket.
SALTS = 4


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of a whole row, NULLs by their place."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return F.xxhash64(F.lit(seed), text)


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    hashed = df.withColumns({"_one": _row_hash(df, 1), "_two": _row_hash(df, 2)})
    return hashed.withColumn("_bucket", F.pmod(F.col("_one"), F.lit(buckets)).cast("int"))


def _digests(rows: DataFrame, schema: str) -> dict[int, tuple[str, int]]:
    """Digest and rows of each bucket: sums of two hashes of 64 bits, whatever the order of the rows."""
    whole = "decimal(38,0)"
    sums = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_one").cast(whole)).alias("a"), F.sum(F.col("_two").cast(whole)).alias("b"))
    digest = F.sha2(F.concat_ws(":", F.lit(schema), "n", "a", "b"), 256)
    return {r["_bucket"]: (r["digest"], r["n"]) for r in sums.select("_bucket", "n", digest.alias("digest")).collect()}


def _manifests(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/manifest")


def add_version(df: DataFrame, base: str, version: int, message: str, at: str | None = None, buckets: int = BUCKETS) -> int:
    """Write a version, which must be new; returns how many buckets had to be written.

    Buckets with the digest of one in an earlier version of any number of buckets point to its files.
    """
    spark = df.sparkSession
    own = f"{base}/manifest/version={int(version)}"
    if exists(spark, f"{own}/_SUCCESS"):
        raise FileExistsError(f"version {version} is there already")
    schema = json.dumps(json.loads(df.schema.json()), sort_keys=True)
    rows = _bucketed(df, buckets)
    found = _digests(rows, schema)
    known = {}
    if exists(spark, f"{base}/manifest"):
        known = {r["digest"]: r["path"] for r in _manifests(spark, base).where(F.col("digest").isin([d for d, _ in found.values()])).select("digest", "path").distinct().collect()}
    fresh = {b: d for b, (d, _) in found.items() if d not in known}
    if fresh:
        # A folder of its own for each attempt: what a failed one left behind is never read.
        attempt = f"{base}/objects/{uuid.uuid4().hex}"
        names = F.create_map(*[F.lit(x) for pair in fresh.items() for x in pair])
        held = rows.withColumn("_digest", F.element_at(names, F.col("_bucket"))).where(F.col("_digest").isNotNull())
        dealt = held.repartition("_bucket", F.pmod(F.col("_two"), F.lit(SALTS)))
        dealt.drop("_one", "_two", "_bucket").write.partitionBy("_digest").parquet(attempt)
        known |= {d: f"{attempt}/_digest={d}" for d in fresh.values()}
    time = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    told = [(b, d, n, known[d]) for b, (d, n) in sorted(found.items())] or [(None, None, 0, None)]
    note = spark.createDataFrame(told, "bucket int, digest string, records long, path string").select(
        "*", F.lit(buckets).alias("buckets"), F.lit(schema).alias("schema"), F.lit(message).alias("message"), time.alias("created_at"))
    note.coalesce(1).write.mode("overwrite").parquet(own)
    return len(fresh)


def history(spark: SparkSession, base: str) -> DataFrame:
    """Versions with message, time and records, the latest first."""
    return (_manifests(spark, base).groupBy("version").agg(F.first("message").alias("message"), F.first("created_at").alias("created_at"), F.sum("records").alias("records"))
            .orderBy(F.desc("version")))


def _manifest(spark: SparkSession, base: str, version: int) -> tuple[T.StructType, int, dict[int, tuple[str, str]]]:
    if not exists(spark, f"{base}/manifest/version={int(version)}/_SUCCESS"):
        raise FileNotFoundError(f"no version {version}")
    rows = spark.read.parquet(f"{base}/manifest/version={int(version)}").collect()
    return T.StructType.fromJson(json.loads(rows[0]["schema"])), rows[0]["buckets"], {r["bucket"]: (r["digest"], r["path"]) for r in rows if r["path"]}


def _read(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def checkout(spark: SparkSession, base: str, version: int) -> DataFrame:
    schema, _, buckets = _manifest(spark, base, version)
    return _read(spark, schema, [path for _, path in buckets.values()])


def version_difference(spark: SparkSession, base: str, old: int, new: int) -> DataFrame:
    """Rows added and removed between two stored versions. Buckets of equal digests are not read: where all are equal, nothing is."""
    (schema, n, a), (other, m, b) = (_manifest(spark, base, v) for v in (old, new))
    if schema != other:
        raise ValueError("the versions have different columns")
    changed = [k for k in a.keys() | b.keys() if n != m or a.get(k, ("",))[0] != b.get(k, ("",))[0]]
    return difference(*(_read(spark, schema, [side[k][1] for k in sorted(changed) if k in side]) for side in (a, b)))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added and removed between two versions, repeated rows counted.

    Both sides are folded to distinct rows with a signed count in one aggregation.
    """
    columns = old.columns
    both = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    net = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    return net.select(*columns, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"),
                      F.abs("_n").alias("copies"))
