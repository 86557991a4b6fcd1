"""Views over the star-schema test tables in the shape of the sensor data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwatch.session import prepare

# How event types stand in for sensor types; anything else becomes "other".
SENSOR_OF_EVENT = {"click": "vibration", "view": "temperature", "purchase": "pressure", "signup": "rpm"}

READING_KEY = ["equipment_id", "sensor_type"]
READING_ORDER = ["timestamp", "reading_id"]
PLANT_ORDER = ["timestamp", "l_orderkey", "l_linenumber", "l_partkey"]
EVENTS_AS_OF = "2024-01-31 00:00:00"
PLANT_AS_OF = "2001-12-01 00:00:00"
DRIFT_SPLIT = "1999-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def equipment_name(key: str):
    return F.concat(F.lit("EQ_"), F.col(key).cast("string"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def as_readings(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    sensor = F.lit("other")
    for event, name in SENSOR_OF_EVENT.items():
        sensor = F.when(kind == event, name).otherwise(sensor)
    value = (
        F.when(kind == "click", F.col("value") / 100)
        .when(kind == "signup", F.col("value") + 1500)
        .otherwise(F.col("value"))
    )
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("timestamp"),
        equipment_name("user_id").alias("equipment_id"),
        sensor.alias("sensor_type"),
        value.alias("value"),
        F.col("props").alias("metadata"),
    )


def plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        equipment_name("l_suppkey").alias("equipment_id"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_discount") * 10).alias("value"),
        (F.col("l_quantity") + 35).alias("temperature"),
        (F.col("l_extendedprice") / 200 + 1500).alias("rpm"),
        (F.col("l_tax") * 1000).alias("load"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            equipment_name("user_id").alias("equipment_id"),
            F.col("ts").alias("timestamp"),
            F.col("event_id").alias("reading_id"),
        )
    )


def _dimension(spark, sf_dir, name, prefix, kind) -> DataFrame:
    base = table(spark, sf_dir, name)
    # nation and region are the fixed 25- and 5-row tables of the star schema.
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return base.join(places, F.col(f"{prefix}_nationkey") == F.col("n_nationkey")).select(
        equipment_name(f"{prefix}_{'custkey' if prefix == 'c' else 'suppkey'}").alias("equipment_id"),
        F.col(f"{prefix}_name").alias("name"),
        kind.alias("type"),
        F.col("r_name").alias("location"),
        F.col("n_name").alias("site"),
        F.when(F.col(f"{prefix}_acctbal") < 0, "offline").otherwise("operational").alias("status"),
    )


def equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "customer", "c", F.col("c_mktsegment"))


def plant_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "supplier", "s", F.lit("machine"))


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    machines = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("EQ_"), (F.col("o_custkey") % machines).cast("string")).alias("equipment_id"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_orderkey").alias("order_key"),
    )


def plant_id():
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def dirty_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``plant`` with values missing and values ten times too high, by row id."""
    v = F.when(plant_id() % 97 != 0, F.col("value"))
    return plant(spark, sf_dir).withColumn("value", F.when(plant_id() % 211 == 0, v * 10).otherwise(v))


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` with missing values and sensor types, and one row in fifty twice."""
    rid = F.col("reading_id")
    base = (
        readings(spark, sf_dir)
        .withColumn("value", F.when(rid % 97 != 0, F.col("value")))
        .withColumn("sensor_type", F.when(rid % 101 != 0, F.col("sensor_type")))
    )
    return base.unionByName(base.filter(rid % 50 == 0))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A component metric log: one timing and one counter tick per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("metric_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("component"),
        F.col("value").alias("processing_time"),
    )


def model_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry event log from ``orders``: model, version, stage and its metrics."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("run_id"),
        F.element_at(F.array(*map(F.lit, ["anomaly", "failure", "health"])),
                     (F.col("o_custkey") % 3 + 1).cast("int")).alias("model"),
        (key % 40 + 1).alias("version"),
        F.when(F.col("o_orderstatus") == "F", "Production")
        .when(F.col("o_orderstatus") == "O", "Staging")
        .otherwise("Archived").alias("stage"),
        F.col("o_orderdate").alias("timestamp"),
        (F.floor(F.col("o_totalprice")) % 1000 / 1000.0).alias("accuracy"),
        (F.floor(F.col("o_totalprice") / 7) % 1000 / 1000.0).alias("f1_score"),
    )
