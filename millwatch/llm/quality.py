"""Quality rules per document and per host. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.llm.common import WORD, source_columns, table
from millwatch.plans.storage import written

#: Documents below so many words, or with more than half of the words in repeated windows, fail outright.
MIN_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"

#: Rules whose failures are gathered by host.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repetition": f"100 * n_repeat_words > {REPEATED_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
}
#: A host goes when its shrunk rate of failures of any rule is above this.
HOST_LIMIT = 0.5


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once even where ``body`` uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text, the first find included.

    Windows are hashed with their places and sorted, so that equal ones are neighbours; the places
    of those are sorted, and each adds as many words as it does not share with the next.
    """
    def covered(places: Column) -> Column:
        step = lambda p, i: F.when(i < F.size(places) - 1, F.least(F.lit(WINDOW), F.get(places, i + 1) - p)).otherwise(WINDOW)
        return F.aggregate(F.transform(places, step), F.lit(0), lambda a, x: a + x)

    def places_of(found: Column) -> Column:
        same = lambda x, i, j: F.coalesce(F.get(found, j)["h"] == x["h"], F.lit(False))
        twice = F.filter(found, lambda x, i: same(x, i, i + 1) | ((i > 0) & same(x, i, F.greatest(i - 1, F.lit(0)))))
        return F.array_sort(F.transform(twice, lambda x: x["p"]))

    def windows(w: Column) -> Column:
        hashed = lambda p: F.struct(F.xxhash64(F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("h"), p.alias("p"))
        found = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), hashed))
        return let(let(found, places_of), covered)

    return F.when(F.size(words) >= WINDOW, windows(words)).otherwise(0)


def base_counts(docs: DataFrame) -> DataFrame:
    """The counts of each document, from its whole text. Null texts count as empty."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    counted = docs.select(
        "doc_id", *(c.alias(k) for k, c in source_columns(F.col("source")).items()),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"))
    return counted.select("doc_id", "no_source", "src", "w.*", "word_chars", "n_symbols", "l.*")


def host_verdicts(counts: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Failures of each rule by host, shrunk towards all hosts, and whether the host is refused.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' rates
    (method of moments, hosts alike); a host of ``n`` documents with ``f`` failures gets the rate
    ``(f + a) / (n + a + b)``. A few failures do not sink a small host, nor many documents a large
    one by themselves. Hosts whose rates do not differ give a prior as heavy as 10**6 documents.
    """
    hosts = counts.groupBy("no_source", "src").agg(
        F.count("*").alias("n"), *(F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()))
    hosts = written(hosts, "quality-hosts")
    prior = hosts.agg(*(f(F.col(name) / F.col("n")).alias(f"{name}_{f.__name__}") for name in RULES for f in (F.avg, F.var_pop))).first()
    shrunk = {}
    for name in RULES:
        mean, spread = prior[f"{name}_avg"] or 0.0, prior[f"{name}_var_pop"] or 0.0
        weight = min(max(mean * (1 - mean) / spread - 1, 1e-3), 1e6) if spread > 0 else 1e6
        shrunk[f"rate_{name}"] = (F.col(name) + mean * weight) / (F.col("n") + weight)
    return hosts.withColumns(shrunk).withColumn("refused", F.greatest(*shrunk) > limit)


def quality(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, the base rules and the verdict of the document's host.

    The host of a document is its ``source``; a page's domain may be put there instead. ``kept`` is
    false where the base rules fail or the host is refused. A null or empty text has no words and
    fails; null sources form one host; repeated rows count as often as they occur and get the same
    result; nothing but doc_id, source and text is read. No rows, no output.
    """
    counts = written(base_counts(docs), "quality-counts")
    hosts = host_verdicts(counts, limit).select("no_source", "src", "refused", *(f"rate_{name}" for name in RULES))
    # Each host in 32 copies: the documents of a hot one meet it in many tasks.
    hosts = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    failed = F.expr(" or ".join(f"({RULES[name]})" for name in ("few_words", "repetition")))
    return (counts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(32)).cast("int"))
            .join(hosts, ["no_source", "src", "salt"])
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.col("refused"))
            .drop("salt", "no_source", "src"))


def op5_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP5_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, p, w FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM rows) t,
  LATERAL (SELECT unnest(ws) AS w, unnest(range(len(ws))) AS p)),
wins AS (
  SELECT rid, p, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM words WINDOW o AS (PARTITION BY rid ORDER BY p)),
hits AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, w, w1, w2) AS c FROM wins WHERE w2 IS NOT NULL) t WHERE c > 1),
cover AS (
  SELECT rid, count(DISTINCT q)::BIGINT AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM hits) t GROUP BY rid),
lines AS (
  SELECT rid, count(*)::BIGINT AS n_lines, (count(*) - count(DISTINCT l))::BIGINT AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM rows) t WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
counts AS (
  SELECT r.rid, doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM rows r LEFT JOIN cover c ON c.rid = r.rid LEFT JOIN lines l ON l.rid = r.rid),
failed AS (
  SELECT *, (n_words < 50)::INT AS f1, (100 * n_repeat_words > 50 * n_words)::INT AS f2, (10 * n_symbols > n_words)::INT AS f3,
         (2 * n_dup_lines > n_lines)::INT AS f4
  FROM counts),
rates AS (
  SELECT source, rule, count(*) AS n, sum(f) AS f
  FROM (SELECT source, unnest(['a', 'b', 'c', 'd']) AS rule, unnest([f1, f2, f3, f4]) AS f FROM failed) t GROUP BY source, rule),
prior AS (SELECT rule, avg(f / n) AS m, var_pop(f / n) AS v FROM rates GROUP BY rule),
heavy AS (SELECT rule, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1e-3), 1e6) ELSE 1e6 END AS w FROM prior),
hosts AS (
  SELECT source, bool_or((f + m * w) / (n + w) > 0.5) AS refused FROM rates JOIN heavy USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 = 1 OR f2 = 1) AS base_failed,
       NOT (f1 = 1 OR f2 = 1) AND NOT refused AS kept
FROM failed f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
"""
