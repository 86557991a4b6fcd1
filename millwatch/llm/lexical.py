"""Ranked lexical search as blocked products of dense tiles: item weights times document impacts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from millwatch.llm.common import table
from millwatch.plans.storage import written
from millwatch.session import ship

#: Items, and (item, term) pairs, of one go over the documents: the bound on what the driver gathers and tasks are sent.
ITEM_BLOCK, PAIR_BLOCK = 512, 1 << 17
#: Documents and terms of a tile.
DOC_TILE, TERM_TILE = 512, 2048
#: An impact stays below this, so a tile's sums are whole numbers below 2**53 for weights up to ``2**53 / (IMPACT * TERM_TILE)``.
IMPACT = 1_000_000
#: First step of the last ranking: an item's candidates are ranked in so many parts before they meet.
SALTS = 64
#: Bytes that end a term: all of ASCII but letters and digits.
_BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_BREAKS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_BREAKS) + b"abcdefghijklmnopqrstuvwxyz")


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of ASCII letters, digits and any characters beyond ASCII, A-Z lowered."""
    return (text or b"").translate(_FOLD).split()


def _binary(text: str) -> Column:
    return F.col(text).cast("binary").alias("text")


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            own = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(own)), pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"])

    ship(items.sparkSession)
    return items.select(F.col(item_id).cast("long").alias("item_id"), _binary(text)).mapInArrow(run, "item_id long, term binary").distinct()


def _tokens(batch: pa.RecordBatch, numbers: dict[bytes, int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each document: its row, number of terms, and the numbers of those in the vocabulary, repeats included."""
    for row, text in enumerate(batch.column("text").to_pylist()):
        found = terms(text)
        known = np.array([numbers.get(t, -1) for t in found], "int64")
        yield row, len(found), known[known >= 0]


def corpus_figures(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of the vocabulary: sums of one row a task and term."""
    numbers = {t: i for i, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, total = np.zeros(len(numbers), "int64"), 0, 0
        for batch in batches:
            for _, n, known in _tokens(batch, numbers):
                holding[np.unique(known)] += 1
                documents, total = documents + (n > 0), total + n
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[held, -1, -2]), pa.array(np.r_[holding[held], documents, total])], names=["number", "n"])

    sums = docs.mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toPandas()
    known = dict(zip(sums.number.tolist(), sums.n.tolist()))
    return known.get(-1, 0), known.get(-2, 0), np.array([known.get(i, 0) for i in range(len(vocabulary))], "int64")


class Best:
    """The best ``k`` documents of each item so far: higher scores first, ties by smaller doc_id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, "int64"), np.zeros(0, bool), np.zeros(0, "int64"))] * n_items
        self.floor = np.ones(n_items, "int64")

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of all items (rows) and some documents; all that reach an item's k-th score are held against it, as ties go by id."""
        reach = scores >= self.floor[:, None]
        for item in np.flatnonzero(reach.any(axis=1)):
            new = np.flatnonzero(reach[item])
            score, none, doc = (np.concatenate(c) for c in zip(self.rows[item], (scores[item, new], missing[new], ids[new])))
            order = np.lexsort((doc, none, -score))[:self.k]
            self.rows[item] = score[order], none[order], doc[order]
            if len(order) == self.k:
                self.floor[item] = score[order[-1]]


def product(impacts: tuple[np.ndarray, np.ndarray, np.ndarray], weights: tuple[np.ndarray, np.ndarray, np.ndarray], n_docs: int, n_items: int) -> np.ndarray:
    """Scores (items by documents) from two sparse tables (row, term, value), exact in 64-bit integers.

    The terms that both have make a compact vocabulary, cut into tiles; each is one product of dense
    matrices in doubles, whose sums are whole numbers below 2**53, and the tiles add up as integers.
    """
    (doc, doc_term, impact), (item, item_term, weight) = impacts, weights
    out = np.zeros((n_items, n_docs), "int64")
    shared = np.intersect1d(doc_term, item_term)
    for at in range(0, len(shared), TERM_TILE):
        tile = shared[at:at + TERM_TILE]
        left, right = np.zeros((n_items, len(tile))), np.zeros((len(tile), n_docs))
        for rows, terms_, values, dense, turn in ((item, item_term, weight, left, False), (doc, doc_term, impact, right, True)):
            place = np.minimum(np.searchsorted(tile, terms_), len(tile) - 1)
            own = np.flatnonzero(tile[place] == terms_)
            dense[(place[own], rows[own]) if turn else (rows[own], place[own])] = values[own]
        out += (left @ right).astype("int64")
    return out


def _scores(docs: DataFrame, pairs: list[Row], k: int) -> DataFrame:
    """The best k documents of each of a block of items, of each task."""
    ids = sorted({p["item_id"] for p in pairs}, key=lambda i: (i is None, i or 0))
    vocabulary = sorted({bytes(p["term"]) for p in pairs})
    at_item, at_term = {i: n for n, i in enumerate(ids)}, {t: n for n, t in enumerate(vocabulary)}
    n_docs, n_terms, holding = corpus_figures(docs, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * h + 1))) for h in holding.tolist()], "int64")
    if len(weight) and weight.max() * IMPACT * TERM_TILE >= 1 << 53:
        raise ArithmeticError("weights too large for exact sums in doubles")
    item = np.array([at_item[p["item_id"]] for p in pairs], "int64")
    term = np.array([at_term[bytes(p["term"])] for p in pairs], "int64")
    worth = np.flatnonzero((weight[term] > 0) & (holding[term] > 0))
    weights = item[worth], term[worth], weight[term[worth]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        for whole in batches:
            for at in range(0, whole.num_rows, DOC_TILE):
                batch = whole.slice(at, DOC_TILE)
                keys, mean = [np.zeros(0, "int64")], np.ones(batch.num_rows, "int64")
                for row, n, known in _tokens(batch, at_term):
                    keys.append(row * len(at_term) + known)
                    mean[row] = 100 - 50 + 50 * n * n_docs // n_terms if n else 1
                key, times = np.unique(np.concatenate(keys), return_counts=True)
                doc, own = key // len(at_term), key % len(at_term)
                impact = 1_000_000_000 * times // (1000 * times + 20 * mean[doc])
                doc_ids = batch.column("doc_id")
                best.add(product((doc, own, impact), weights, batch.num_rows, len(ids)), doc_ids.is_null().to_numpy(zero_copy_only=False), doc_ids.fill_null(0).to_numpy())
        rows = [(ids[i], None if none else doc, score) for i, found in enumerate(best.rows) for score, none, doc in zip(*(c.tolist() for c in found))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item, ties by ascending doc_id.

    A term's weight falls with the documents that hold it, its impact in a document rises with its
    occurrences and falls with the document's length; a score is the sum of weight times impact over the
    item's distinct terms, in integers. Items go in blocks of bounded size, each in two goes over all
    documents: one counts, one multiplies. A task keeps the best k of each item, ties included; these few
    are ranked in parts, then together.

    Null and empty texts have no terms; an item or a document without any is in no row. Rows that
    repeat an item_id are one item with the terms of all; rows that repeat a doc_id are documents of their own, of which
    equal ones take ranks next to each other. A null doc_id comes after all others of its score, a null
    item_id is an item. Other columns are not read. No documents or no items, no output.
    """
    spark = ship(docs.sparkSession)
    pairs = written(item_terms(items), "search-items")
    size = pairs.agg(F.count("*"), F.count_distinct(F.coalesce("item_id", F.lit(0)), F.col("item_id").isNull())).first()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _binary("text"))
    schema = "item_id long, rank int, doc_id long, score long"
    if not size[0]:
        return spark.createDataFrame([], schema)
    blocks = max(math.ceil(size[0] / PAIR_BLOCK), math.ceil(size[1] / ITEM_BLOCK))
    found = None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        part = _scores(docs, own, k) if own else None
        found = part if found is None else found if part is None else found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("place", F.row_number().over(W.partitionBy("item_id", "salt").orderBy(*order))).where(f"place <= {k}")
    return few.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order)).cast("int")).where(f"rank <= {k}").select("item_id", "rank", "doc_id", "score")


def op11_lexical(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


OP11_SQL = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
counts AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, corpus GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), corpus GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
