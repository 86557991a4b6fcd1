"""Mixing sources to target weights by a low-discrepancy schedule. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwatch.llm.common import SLICE_DIGITS, before, n_words, shuffle_key, source_columns, table
from millwatch.plans.storage import written

#: Words in a block, the unit that the schedule deals out.
BLOCK = 256
#: No source, and no document, is taken more often than this.
REPEATS = 3
#: The golden ratio's fraction, and the fraction of 2**20 times it: fixed values.
PHI = 0.6180339887498949
PHI_20 = (2 ** 20 * PHI) % 1.0
#: Cells of the interval 0 to 1 in which a point looks for its source.
CELLS = 1024
#: Slots ranked together; one source's slots are spread over so many tasks that none gets more.
SLOT_SLICE = 65536


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """Narrow rows: id, size in words, source, shuffle key. Written once, as several steps read them."""
    return written(docs.select(
        "doc_id", n_words(F.col("text")).alias("size"), *(c.alias(k) for k, c in source_columns(F.col("source")).items()),
        shuffle_key(seed, F.col("doc_id")).alias("key")), "mix-rows")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: place ``ord`` (by code point, null last), size, weight and target.

    Targets share the sum of all sizes by weight; what is above ``REPEATS`` times a source's size
    is reshared among the others until none is above. The level that settles this is found in
    closed form: with sources in order of cap over weight, the first ``k`` at which giving all
    earlier ones their cap leaves the rest below theirs. The table has one row per source.
    """
    everything = W.partitionBy()
    by_name, by_ratio = W.orderBy("no_source", "src"), W.orderBy("ratio", "ord")
    sources = rows.groupBy("no_source", "src").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("ord", F.row_number().over(by_name) - 1)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("ord") % len(weights) + 1).cast("int")).cast("long"))
    sources = sources.withColumn("cap", F.col("source_size") * REPEATS).withColumn("ratio", F.col("cap") / F.col("weight"))
    sources = (sources.withColumn("total", F.sum("source_size").over(everything))
               .withColumn("capped", F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("cap"))
               .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)))
               .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open")))
    settled = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "ord", "level"))).over(everything)
    sources = sources.withColumn("settled", settled)
    is_capped = F.struct("ratio", "ord") < F.struct("settled.ratio", "settled.ord")
    target = F.when(is_capped, F.col("cap").cast("double")).otherwise(F.least(F.col("settled.level") * F.col("weight"), F.col("cap").cast("double")))
    quota = F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("cap"))
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    return (sources.withColumn("target", target).withColumn("quota", quota).withColumn("blocks", blocks)
            .withColumn("slots", F.when(F.col("quota") > 0, F.expr("quota div source_size") * F.col("blocks")
                                        + F.ceil(F.expr("quota % source_size") / BLOCK)).otherwise(0).cast("long"))
            .select("no_source", "src", "ord", "source_size", "weight", "target", "quota", "blocks", "slots"))


def golden_point(slot: Column) -> Column:
    """The fraction of ``slot`` times the golden ratio, exact enough for 10**12 slots."""
    product = F.floor(slot / 2 ** 20) * PHI_20 + (slot % 2 ** 20) * PHI
    return product - F.floor(product)


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of the mix in order: slot, source place, epoch, block of the source, words taken.

    Point ``i`` of the golden-ratio sequence is mapped through the cumulative slot counts of the
    sources; any stretch of the schedule thereby holds the target mixture to within a few slots.
    The ``r``-th slot of a source takes block ``r`` modulo its blocks, so passes follow each other.
    Slots past a source's quota are void, and the few that it still lacks follow at the end. The
    last one is cut so that the words taken equal the target, rounded.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    run = W.orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = (sources.where("slots > 0").withColumn("upto", F.sum("slots").over(run)).withColumn("since", F.col("upto") - F.col("slots"))
             .select("ord", "since", "upto"))
    width = max(total, 1) / CELLS
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("since") / width).cast("int"), F.least(F.floor(F.col("upto") / width), F.lit(CELLS)).cast("int"))))
    point = F.least(golden_point(F.col("slot") + 1) * total, F.lit(total - 0.5))
    points = spark.range(total).withColumnRenamed("id", "slot").withColumn("point", point).withColumn("cell", F.floor(F.col("point") / width).cast("int"))
    drawn = points.join(cells, "cell").where("point >= since and point < upto").select("slot", "ord")
    ranked = before(drawn, ["ord"], F.floor(F.col("slot") / SLOT_SLICE), ["slot"], F.lit(1), "rank")
    need = sources.select("ord", "slots")
    got = drawn.groupBy("ord").agg(F.count("*").alias("got"))
    lacking = (need.join(got, "ord", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
               .withColumn("rank", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)))
               .select((F.lit(total) + F.col("rank") - F.col("got")).alias("slot"), "ord", "rank"))
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    taken = F.least(F.lit(BLOCK).cast("long"), F.col("source_size") - F.col("block") * BLOCK,
                    F.col("quota") - F.col("epoch") * F.col("source_size") - F.col("block") * BLOCK)
    return (ranked.select("slot", "ord", "rank").unionByName(lacking).withColumn("salt", F.pmod("slot", F.lit(64)).cast("int"))
            .join(salted, ["ord", "salt"]).where("rank < slots")
            .withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
            .select("slot", "ord", "epoch", "block", taken.alias("words")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 11) -> DataFrame:
    """How many words of each document the mix takes, over all epochs.

    Each source's documents are put on a line in seeded-shuffled order and cut into blocks of
    ``BLOCK`` words, across document ends; ``schedule`` deals the blocks. Returns doc_id, size,
    source_size, target, taken, ``ord``, ``start`` (the document's place: its source's number and
    the words ahead of it) and ``first_slot``, ``slot_offset``: the first slot of the schedule that takes words of
    it and the word of the slot's block at which it begins there, -1 where none does. Sorted by these two, documents
    come in the order of the mix.

    Nulls: a null source is a source of its own, last; a null text has no words. Documents
    without words are never taken. Ids that tie are ordered by id and size, and rows that still tie
    are alike. Repeated rows are rows of their own. Other columns are not read. No rows, no output.
    """
    rows = measured(docs, seed)
    sources = written(source_targets(rows, weights), "mix-sources")
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    placed = before(rows, ["no_source", "src"], F.substring("key", 1, SLICE_DIGITS), ["key", "doc_id", "size"], F.col("size"), "start")
    placed = written(placed.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(64)).cast("int")).join(salted, ["no_source", "src", "salt"])
                     .select("doc_id", "size", "ord", "start", "source_size", "target"), "mix-placed")
    # Folded before it meets the documents: for each block, how often it is taken whole, and the cut piece.
    whole = F.least(F.lit(BLOCK).cast("long"), F.col("source_size") - F.col("block") * BLOCK)
    blocks = (schedule(sources).join(sources.select("ord", "source_size"), "ord").groupBy("ord", "block")
              .agg(F.count(F.when(F.col("words") == whole, 1)).alias("times"),
                   F.min(F.when(F.col("words") == whole, F.col("slot"))).alias("whole_slot"),
                   F.coalesce(F.max(F.when(F.col("words") < whole, F.col("words"))), F.lit(0)).alias("cut"),
                   F.min(F.when(F.col("words") < whole, F.col("slot"))).alias("cut_slot")))
    pieces = (placed.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))))
              .withColumn("since", F.greatest(F.col("start") - F.col("block") * BLOCK, F.lit(0)))
              .withColumn("upto", F.least(F.col("start") + F.col("size") - F.col("block") * BLOCK, F.lit(BLOCK))))
    took = F.col("times") * (F.col("upto") - F.col("since")) + F.greatest(F.least("upto", "cut") - F.col("since"), F.lit(0))
    slot = F.least("whole_slot", F.when(F.col("since") < F.col("cut"), F.col("cut_slot")))
    taken = pieces.join(blocks, ["ord", "block"]).groupBy("ord", "start").agg(F.sum(took).alias("taken"), F.min(slot * BLOCK + F.col("since")).alias("first"))
    # Words ahead of it name a document with words: no other in its source has the same.
    found = placed.where("size > 0").join(taken, ["ord", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    none = placed.where("size = 0").withColumn("taken", F.lit(0)).withColumn("first", F.lit(None).cast("long"))
    return found.unionByName(none).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "ord", "start",
        F.coalesce(F.expr(f"first div {BLOCK}"), F.lit(-1)).cast("long").alias("first_slot"), F.coalesce(F.expr(f"first % {BLOCK}"), F.lit(-1)).cast("long").alias("slot_offset"))


def op7_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "first_slot", "slot_offset")


# The same rules for SQL. What a document gets is counted from its source's line directly: each full pass takes it once, the last
# one up to its cut. Its first slot comes from the schedule, point by point.
OP7_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('11:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS ord FROM s0),
s2 AS (SELECT *, 1 + ord % 3 AS weight, 3 * source_size AS cap FROM s1),
s3 AS (SELECT *, cap::DOUBLE / weight AS ratio, (sum(source_size) OVER ())::BIGINT AS total FROM s2),
s4 AS (SELECT *, ((total - (sum(cap) OVER (ORDER BY ratio, ord ROWS UNBOUNDED PRECEDING) - cap))::BIGINT)::DOUBLE
                 / (sum(weight) OVER (ORDER BY ratio, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM s3),
k AS (SELECT ratio AS at_ratio, ord AS at_ord, level AS at_level FROM s4 WHERE level <= ratio ORDER BY ratio, ord LIMIT 1),
s5 AS (SELECT *, CASE WHEN ratio < at_ratio OR (ratio = at_ratio AND ord < at_ord) THEN cap::DOUBLE
                      ELSE least(at_level * weight, cap::DOUBLE) END AS target FROM s4, k),
s6 AS (SELECT source, ord, source_size, target, least(floor(target + 0.5)::BIGINT, cap) AS quota, (source_size + {BLOCK - 1}) // {BLOCK} AS blocks FROM s5),
s7 AS (SELECT *, CASE WHEN quota > 0 THEN (quota // source_size) * blocks + (quota % source_size + {BLOCK - 1}) // {BLOCK} ELSE 0 END::BIGINT AS slots FROM s6),
spans AS (SELECT ord, (sum(slots) OVER (ORDER BY ord))::BIGINT - slots AS since, (sum(slots) OVER (ORDER BY ord))::BIGINT AS upto, (sum(slots) OVER ())::BIGINT AS n FROM s7),
points AS (SELECT i AS slot, n, ((i + 1) // {2 ** 20})::DOUBLE * {PHI_20!r}::DOUBLE + ((i + 1) % {2 ** 20})::DOUBLE * {PHI!r}::DOUBLE AS x
           FROM (SELECT max(n) AS n FROM spans) t, LATERAL (SELECT unnest(range(n)) AS i)),
drawn AS (SELECT slot, ord, row_number() OVER (PARTITION BY ord ORDER BY slot) - 1 AS rank
          FROM points p JOIN spans s ON least((x - floor(x)) * p.n, p.n - 0.5::DOUBLE) >= since AND least((x - floor(x)) * p.n, p.n - 0.5::DOUBLE) < upto),
got AS (SELECT ord, slots, n, count(slot) AS got FROM s7 JOIN spans USING (ord) LEFT JOIN drawn USING (ord) GROUP BY ord, slots, n),
slotted AS (
  SELECT slot, ord, rank FROM drawn
  UNION ALL SELECT n + k, ord, got + k FROM got, LATERAL (SELECT unnest(range(slots - got)) AS k) WHERE got < slots),
dealt AS (
  SELECT slot, ord, rank % blocks AS block, source_size,
         least({BLOCK}, source_size - (rank % blocks) * {BLOCK}, quota - (rank // blocks) * source_size - (rank % blocks) * {BLOCK}) AS words
  FROM slotted JOIN s7 USING (ord) WHERE rank < slots),
placed AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start FROM rows),
pieces AS (
  SELECT ord, start, b AS block, greatest(start - b * {BLOCK}, 0) AS since
  FROM placed p JOIN s7 ON p.source IS NOT DISTINCT FROM s7.source, LATERAL (SELECT unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS b) WHERE size > 0),
firsts AS (SELECT ord, start, min(slot * {BLOCK} + since) AS first FROM pieces JOIN dealt USING (ord, block) WHERE since < words GROUP BY ord, start)
SELECT p.doc_id, p.size, s.source_size, round(s.target, 6) AS target,
       (CASE WHEN s.source_size = 0 THEN 0 ELSE (s.quota // s.source_size) * p.size
        + greatest(least(p.start + p.size, s.quota % s.source_size) - p.start, 0) END)::BIGINT AS taken,
       coalesce(CASE WHEN p.size > 0 THEN first // {BLOCK} END, -1)::BIGINT AS first_slot, coalesce(CASE WHEN p.size > 0 THEN first % {BLOCK} END, -1)::BIGINT AS slot_offset
FROM placed p JOIN s7 s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN firsts f ON f.ord = s.ord AND f.start = p.start
"""
