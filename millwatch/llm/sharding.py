"""Sharding by proportional stratified interleaving. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millwatch.llm.common import SLICE_DIGITS, before, shuffle_key, source_columns, table

#: Slices of the interval 0 to 1 for the fractional ranks; bounds the broadcast table of slice counts.
FRACTION_SLICES = 4096


def assign_shards(docs: DataFrame, n_shards: int = 24, seed: int = 7) -> DataFrame:
    """Deal documents into shards that all have the mixture of the whole.

    Rows are ranked in seeded-shuffled order within their source; row ``r`` of ``n`` gets the
    fraction ``(r + 0.5) / n``; all rows are sorted by fraction and cut into runs whose counts
    differ by one at most. In every run each source has its share, to within a row or two.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, shard and slot (place in the shard).
    Nulls: a null source is a source of its own, sorted last; a null text has size 8 and CRC 0;
    null ids share one shuffle key. Equal keys are ordered by id, size and CRC, so rows that
    still tie are alike and any order of them gives the same result. Each repeated row is dealt
    on its own. Other columns of the input are neither read nor moved. No rows, no output.
    """
    rows = docs.select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        *(c.alias(k) for k, c in source_columns(F.col("source")).items()),
        shuffle_key(seed, F.col("doc_id")).alias("key"))
    tie = ["key", "doc_id", "size", "text_crc32"]
    ranked = before(rows, ["no_source", "src"], F.substring("key", 1, SLICE_DIGITS), tie, F.lit(1), "rank")
    counts = rows.groupBy("no_source", "src").agg(F.count("*").alias("n"))
    placed = (ranked.join(_spread(counts), (ranked.no_source == F.col("c_no_source")) & (ranked.src == F.col("c_src"))
                          & (F.pmod("rank", F.lit(64)) == F.col("c_salt")))
              .withColumn("fraction", (F.col("rank") + 0.5) / F.col("n"))
              .withColumn("cut", F.floor(F.col("fraction") * FRACTION_SLICES).cast("int"))
              .drop("c_no_source", "c_src", "c_salt", "n", "rank"))
    # FRACTION_SLICES rows at most, whatever the input: small enough for one task and a broadcast.
    cuts = placed.groupBy("cut").agg(F.count("*").alias("in_cut")).select(
        "cut", F.coalesce(F.sum("in_cut").over(W.orderBy("cut").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
        F.sum("in_cut").over(W.partitionBy()).alias("total"))
    inside = W.partitionBy("cut").orderBy("fraction", "no_source", "src", *tie)
    place = F.col("ahead") + F.row_number().over(inside) - 1
    return (placed.join(F.broadcast(cuts), "cut").withColumn("place", place)
            .withColumn("shard", F.expr(f"place * {n_shards} div total").cast("int"))
            .withColumn("slot", F.expr(f"place - (shard * total + {n_shards - 1}) div {n_shards}").cast("long"))
            .select("doc_id", "size", "text_crc32", "shard", "slot"))


def _spread(counts: DataFrame, salts: int = 64) -> DataFrame:
    """One copy of each source's count for each salt, so that a hot source meets it in many tasks."""
    return counts.select(F.col("no_source").alias("c_no_source"), F.col("src").alias("c_src"), "n",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("c_salt"))


def op9_sharding(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The reflected polynomial of CRC-32, a fixed value of the format.
CRC_POLYNOMIAL = 3988292384

OP9_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, {CRC_POLYNOMIAL}) ELSE v // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8),
rows AS (
  SELECT doc_id, source, coalesce(text, '') AS txt, hex(encode(coalesce(text, ''))) AS hx,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
sized AS (
  SELECT doc_id, source, key, (length(hx) // 2 + 8)::BIGINT AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(hx) // 2),
             lambda i: ('0x' || substr(hx, (2 * i + 1)::BIGINT, 2))::BIGINT)),
             lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM rows, crc),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id, size, text_crc32) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS fraction
  FROM sized),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source IS NULL, source, key, doc_id, size, text_crc32) - 1 AS place,
         count(*) OVER () AS total
  FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 24 // total)::INTEGER AS shard,
       (place - ((place * 24 // total) * total + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
