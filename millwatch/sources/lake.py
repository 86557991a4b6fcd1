"""The data lake: partitioned parquet, object listings, pruned reads, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RAW_PARTS = ["year", "month", "day", "hour"]
PROCESSED_PARTS = ["type", "year", "month", "day"]
ROWS_PER_FILE = 5_000_000
PROCESS_LABELS = ["is_anomaly", "will_fail", "health_score"]


def date_parts(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time), "hour": F.hour(time)})


def _store(df: DataFrame, path: str, parts: Sequence[str], mode: str) -> None:
    # Rows of one directory come together so that files stay large; adaptive execution
    # splits a directory that is too much for one task.
    gathered = df.hint("rebalance", *parts)
    gathered.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*parts).parquet(path)


def store_raw(df: DataFrame, base: str, mode: str = "append") -> str:
    """Readings by year, month, day and hour of their time. Returns the dataset path."""
    path = f"{base}/raw-data"
    _store(date_parts(df), path, RAW_PARTS, mode)
    return path


def store_processed(df: DataFrame, base: str, process_type: str, mode: str = "append") -> str:
    """Results by type of processing and date."""
    path = f"{base}/processed-data"
    dated = date_parts(df).drop("hour").withColumn("type", F.lit(process_type))
    _store(dated, path, PROCESSED_PARTS, mode)
    return path


def in_dates(start: str, end: str) -> Column:
    """Rows of whole days start to end, told from the partition columns alone."""
    return F.make_date("year", "month", "day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def read_range(spark: SparkSession, path: str, start: str, end: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows between two times; only the directories of those days are listed for reading."""
    rows = spark.read.parquet(path).filter(in_dates(start[:10], end[:10]))
    kind = rows.schema["timestamp"].dataType
    rows = rows.filter(F.col("timestamp").between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    return rows.select(*columns) if columns else rows


def training_data(df: DataFrame, start: str, end: str, features: Sequence[str],
                  labels: Sequence[str] = PROCESS_LABELS) -> DataFrame:
    """Feature and label columns of rows in a time range; labels that do not exist are left out."""
    kind = df.schema["timestamp"].dataType
    inside = df.filter((F.col("timestamp") >= F.lit(start).cast(kind)) & (F.col("timestamp") <= F.lit(end).cast(kind)))
    return inside.select(*features, *[c for c in labels if c in df.columns])


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Key, size and time of change of every file under a path; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def object_summary(spark: SparkSession, path: str) -> DataFrame:
    """Objects, bytes, last change, and the date range and equipment told by the keys.

    A key tells an equipment as ``equipment_<id>_`` or ``equipment_id=<id>/``; ids are sorted, one for each machine.
    """
    def part(name: str) -> Column:
        return F.expr("try_cast(regexp_extract(key, '%s=([0-9]+)', 1) AS INT)" % name)

    date = F.make_date("y", "m", "d")
    told = F.regexp_extract("key", "equipment_(?:id=([^/]+)|([^_/.]+))", 0)
    equipment = F.nullif(F.regexp_replace(told, "^equipment_(id=)?", ""), F.lit(""))
    dated = list_objects(spark, path).withColumns({"y": part("year"), "m": part("month"), "d": part("day")})
    return dated.agg(
        F.count(F.lit(1)).alias("total_objects"), F.sum("size").alias("total_size_bytes"),
        (F.sum("size") / (1024 * 1024)).alias("total_size_mb"), F.max("last_modified").alias("last_modified"),
        F.min(date).alias("start_date"), F.max(date).alias("end_date"), F.array_sort(F.collect_set(equipment)).alias("equipment_ids"))


def data_summary(df: DataFrame, payload: Column) -> DataFrame:
    """The same over the rows: count, bytes, equipment and date range."""
    size = F.octet_length(payload)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.sum(size).alias("total_size_bytes"),
        (F.sum(size) / (1024 * 1024)).alias("total_size_mb"), F.countDistinct("equipment_id").alias("equipment_count"),
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"))


def save(df: DataFrame, path: str, format: str = "parquet", compress: bool = False, mode: str = "overwrite") -> None:
    """Write parquet, json or csv; text formats may be gzipped."""
    if format not in ("parquet", "json", "csv"):
        raise ValueError(f"Unsupported format: {format}")
    writer = df.write.mode(mode).format(format)
    if compress and format != "parquet":
        writer = writer.option("compression", "gzip")
    if format == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def load(spark: SparkSession, path: str, format: str = "parquet", schema=None) -> DataFrame:
    if format not in ("parquet", "json", "csv"):
        raise ValueError(f"Unsupported format: {format}")
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)
