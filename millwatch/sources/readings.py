"""Readings in and out: JSON lines, CSV, encoded envelopes, streams, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millwatch.schemas import READING, READING_JSON, REQUIRED_FIELDS

# Metadata has no schema: it is read as its JSON text and its numbers are picked out.
_RAW = T.StructType([
    f if f.name != "metadata" else T.StructField("metadata", T.StringType()) for f in READING_JSON.fields])
_CORRUPT = "_corrupt_record"


def metadata_map(text: Column) -> Column:
    """Numbers of a JSON object by name; missing or unreadable text gives an empty map."""
    found = F.transform_values(F.from_json(text, "map<string,string>"), lambda _, v: v.try_cast("double"))
    numbers = F.map_filter(found, lambda _, v: v.isNotNull())
    return F.coalesce(numbers, F.create_map().cast("map<string,double>"))


def _typed(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give parsed text fields their types; ``metadata_json`` keeps the text."""
    return df.select(
        *keep, F.expr("try_cast(timestamp AS TIMESTAMP)").alias("timestamp"), "equipment_id", "sensor_type",
        F.col("value").cast("double").alias("value"), "unit", "location",
        metadata_map(F.col("metadata")).alias("metadata"), F.col("metadata").alias("metadata_json"))


def missing_fields() -> Column:
    """Names of the required fields a parsed record lacks."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_FIELDS]), lambda c: c.isNotNull())


def parse_readings(df: DataFrame, column: str = "value", keep: tuple[str, ...] = (), drop_bad: bool = True) -> DataFrame:
    """Typed readings from a column of JSON text; works on a stream.

    Records that do not parse or lack a required field are dropped, or kept with the
    names of the fields in ``errors``. Times may end in ``Z`` or an offset.
    """
    named = [F.col(c).alias(f"_keep_{c}") for c in keep]
    # Unfolding the record as a one-row array keeps the checks below from parsing it again.
    parsed = df.select(*named, F.inline(F.array(F.from_json(F.col(column), _RAW))))
    typed = _typed(parsed, tuple(f"_keep_{c}" for c in keep))
    typed = typed.withColumnsRenamed({f"_keep_{c}": c for c in keep}).withColumn("errors", missing_fields())
    return typed.filter(F.size("errors") == 0).drop("errors") if drop_bad else typed


def decode_envelopes(df: DataFrame, column: str = "data", keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings from base64-encoded JSON; what cannot be decoded is dropped."""
    text = F.expr(f"try_to_binary({column}, 'base64')").cast("string")
    return parse_readings(df.withColumn("_text", text), "_text", keep)


def ingest_report(parsed: DataFrame) -> DataFrame:
    """Counts of accepted and refused records, and of every missing field."""
    row = parsed.agg(
        F.sum((F.size("errors") == 0).cast("long")).alias("processed_count"),
        F.sum((F.size("errors") > 0).cast("long")).alias("failed_count"),
        *[F.sum(F.array_contains("errors", c).cast("long")).alias(c) for c in REQUIRED_FIELDS])
    names = ["processed_count", "failed_count", *REQUIRED_FIELDS]
    return row.unpivot([], names, "measure", "records")


def to_json(columns: tuple[str, ...] = tuple(READING.fieldNames())) -> Column:
    """A reading as JSON text with ISO time."""
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.to_json(F.struct(*[time.alias("timestamp") if c == "timestamp" else F.col(c) for c in columns]))


def publish_envelope(df: DataFrame, columns: tuple[str, ...] = tuple(READING.fieldNames())) -> DataFrame:
    """Key and JSON payload per reading, as a message sink expects them.

    A reading without equipment goes to ``default``; a missing time is stamped now.
    """
    stamped = df.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp().cast(df.schema["timestamp"].dataType)))
    return stamped.select(F.coalesce("equipment_id", F.lit("default")).alias("key"), to_json(columns).alias("value"))


def publish(df: DataFrame, format: str, **options: str) -> None:
    """Send envelopes to a sink (``kafka`` in deployment, ``json`` files elsewhere)."""
    publish_envelope(df).write.format(format).options(**options).mode("append").save()


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines under a prefix. Blank lines are skipped; only a bad line itself is lost."""
    schema = T.StructType([*_RAW.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
    typed = _typed(lines.filter(F.col(_CORRUPT).isNull()))
    return typed.filter(F.size(missing_fields()) == 0)


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """One batch file, ``.json`` lines or ``.csv``; any bad record raises."""
    if path.endswith(".json"):
        rows = spark.read.schema(_RAW).option("mode", "FAILFAST").json(path)
    elif path.endswith(".csv"):
        # Standard CSV doubles a quote inside quotes, as in the JSON of the metadata column.
        rows = spark.read.schema(_RAW).option("mode", "FAILFAST").option("header", "true").option("escape", '"').csv(path)
    else:
        raise ValueError(f"Unknown file type: {path}")
    typed = _typed(rows).withColumn("timestamp", F.coalesce("timestamp", F.raise_error(F.lit("timestamp missing or unreadable"))))
    # A filter stays whatever columns are selected later.
    lacking = missing_fields()
    return typed.filter(F.when(F.size(lacking) == 0, F.col("timestamp").isNotNull()).otherwise(
        F.raise_error(F.concat(F.lit("missing fields: "), F.array_join(lacking, ", "))).cast("boolean")))


def stream_readings(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Readings from JSON lines arriving in a folder; bad records are skipped."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_readings(reader.load(path))


def stream_messages(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1_000_000) -> DataFrame:
    """Readings from a message topic, newest first seen; needs the Kafka connector on the class path."""
    source = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "latest").option("maxOffsetsPerTrigger", per_trigger).load()
    )
    return parse_readings(source.select(F.col("value").cast("string").alias("value")))


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    df.select(*READING.fieldNames()).withColumn("timestamp", time).write.mode(mode).json(path)


def latest(df: DataFrame, limit: int = 100, time: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """The newest records, at most ``limit``: each task keeps its own top, then they merge."""
    return df.orderBy(F.desc(time), F.desc(tie)).limit(limit)
