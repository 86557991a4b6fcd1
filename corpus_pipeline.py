"""Documents to training tokens in five stages, each on all that the one before kept.

Null or empty texts, repeated rows and extra columns pass as each operator in ``millwatch.llm``
states; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwatch.llm import jaccard_join, line_dedup, mixing, pieces, toxicity
from millwatch.llm.common import WORD, n_words, table
from millwatch.plans.storage import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labels outside the held-out fold, does not call toxic."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.learn(table(spark, sf_dir, "documents"), labels)
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks and runs of lines that an earlier document has; a document with nothing left goes."""
    clean = line_dedup.dedup_passages(docs).where((F.col("lines_removed") == 0) | (n_words(F.col("text")) > 0))
    return clean.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is linked on five-word shingles at 0.8: that of the smallest id (null last), then digest of the text.

    A document is its id and text: rows alike in both are one group, rows that share only the id are documents of their own. Rows
    without words are linked with nothing and all stay.
    """
    name = F.xxhash64(F.coalesce("text", F.lit("")), "doc_id", F.col("doc_id").isNull())
    words = n_words(F.col("text")) > 0
    told = written(docs.where(words).select("doc_id", F.md5("text").alias("digest"), name.alias("name")).distinct(), "pipeline-names")
    groups = jaccard_join.near_duplicates(docs.where(words).select(name.alias("doc_id"), "text"), 5, 80).distinct()
    stay = (told.join(groups.select(F.col("doc_id").alias("name"), "component_id"), "name").groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("one")).select(F.col("one.doc_id").alias("stay_id"), F.col("one.digest").alias("stay_digest")))
    # Of rows alike in id and text any one stays: the first of its kind that a task meets.
    met = docs.where(words).withColumn("_digest", F.md5("text")).join(stay, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("_digest") == F.col("stay_digest")))
    kept = met.dropDuplicates(["stay_id", "stay_digest"]).select(*docs.columns)
    return kept.unionByName(docs.where(~words))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, the last time cut where its source's quota ends.

    Documents without words, and those that the mix does not reach, are not taken. Rows that repeat
    id and size are taken alike.
    """
    taken = mixing.mix(docs).where("taken > 0").groupBy("doc_id", "size").agg(F.min("taken").alias("taken"))
    sized = docs.withColumn("size", n_words(F.col("text")))
    met = sized.join(taken.withColumnRenamed("doc_id", "mix_id").withColumnRenamed("size", "mix_size"),
                     F.col("doc_id").eqNullSafe(F.col("mix_id")) & (F.col("size") == F.col("mix_size")))
    turns = met.withColumn("turn", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    rest = F.col("taken") - (F.col("turn") - 1) * F.col("size")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), 1, rest.cast("int")), " ")
    cut = turns.withColumn("cut", rest < F.col("size")).withColumn("text", F.when(F.col("cut"), part).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(F.col("cut"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document, as count and digests."""
    return pieces.encode_decode(docs.select("doc_id", "text"), pieces.piece_model(), digests=True).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("jaccard_join", drop_near_duplicates), ("mixing", mix_sources), ("pieces", tokens)]

#: SQL has no kernel machine and no merge rounds; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
