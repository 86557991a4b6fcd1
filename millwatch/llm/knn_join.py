"""Exact top-k by inner product: a Voronoi join of queries and data. Numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from millwatch.llm.common import table
from millwatch.llm.hashes import mix
from millwatch.plans.storage import written
from millwatch.session import ship

#: Pivots at most: bounds what the driver gathers (pivots, and a few figures for each).
MAX_PIVOTS = 512
#: Rows of data and of queries that one task holds against each other at once.
DATA_CHUNK, QUERY_CHUNK = 16384, 2048
#: Scale that turns a component into an integer.
SCALE = 256


def scaled(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Distinct (id, integer vector) of the rows that can take part."""
    usable = F.col(vector).isNotNull() & F.col(id_column).isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.where(usable).select(F.col(id_column).cast("long").alias("vec_id"),
                                    F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))
            .distinct())


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros, which add nothing to a product."""
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _dealt(ids: pd.Series, n: int) -> np.ndarray:
    """A chunk for each id, by its hash: ids of queries may have any pattern."""
    return (mix(ids.to_numpy().astype("int64").view("uint64")) % np.uint64(n)).astype("int64")


def _cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its nearest pivot and the distance to it."""
    width = pivots.shape[1]

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = _matrix(part.v, width)
            gap = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
            cell = gap.argmin(1)
            yield part.assign(cell=cell.astype("int32"), dist=np.linalg.norm(x - pivots[cell], axis=1), norm=np.linalg.norm(x, axis=1))

    return vectors.mapInPandas(assign, "vec_id long, v array<long>, is_query boolean, cell int, dist double, norm double")


def _plan(pivots: np.ndarray, cells: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each query cell, and the distance from its pivot at which data of a cell matters to a group.

    For a query ``q`` of a group with centre ``c`` and radius ``r`` and a vector ``x`` of the cell of
    pivot ``p``: <c,p> - r|p| - |q||x-p| <= <q,x> <= <c,p> + r|p| + |q||x-p|. The k nearest
    distances of every cell give k-th best scores that the group is sure to reach; data whose upper
    bound stays below is not sent. Coarser groups send data fewer times but prune less, so the
    grouping that sends the fewest rows is taken.
    """
    n = len(pivots)
    size, reach = np.zeros(n), np.zeros(n)
    near = np.full((n, k), np.inf)
    q_count, q_reach, q_norm = np.zeros(n), np.zeros(n), np.zeros(n)
    for row in cells.itertuples():
        size[row.cell], reach[row.cell] = row.n, row.reach
        near[row.cell, :len(row.near)] = row.near
        q_count[row.cell], q_reach[row.cell], q_norm[row.cell] = row.q_n, row.q_reach, row.q_norm
    length = np.linalg.norm(pivots, axis=1)
    best = None
    groups = 1
    while True:
        centre = pivots[:groups]
        group = ((pivots[:, None, :] - centre[None]) ** 2).sum(-1).argmin(1) if n * groups * pivots.shape[1] < 3e7 else \
            ((pivots ** 2).sum(1)[:, None] - 2 * pivots @ centre.T + (centre ** 2).sum(1)).argmin(1)
        shift = np.linalg.norm(pivots - centre[group], axis=1) + q_reach
        radius, norm, count = np.zeros(groups), np.zeros(groups), np.zeros(groups)
        asked = q_count > 0
        np.maximum.at(radius, group[asked], shift[asked])
        np.maximum.at(norm, group[asked], q_norm[asked])
        np.add.at(count, group, q_count)
        middle, slack = centre @ pivots.T, radius[:, None] * length
        low = (middle - slack)[:, :, None] - norm[:, None, None] * np.where(np.isfinite(near), near, 0)[None]
        low = np.where(np.isfinite(near)[None], low, -np.inf).reshape(groups, -1)
        kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(groups, -np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            need = (kth[:, None] - middle - slack) / norm[:, None]
            # A hair below the bound, against rounding; a group of zero vectors ties with everything.
            need = np.where(norm[:, None] > 0, need - 1e-6 * (1 + np.abs(need)), -np.inf)
        need[count == 0] = np.inf
        cost = ((need <= reach) * size).sum(1) @ np.maximum(1, np.ceil(count / QUERY_CHUNK))
        if best is None or cost < best[0]:
            best = cost, group, need
        if groups == n:
            return best[1], best[2], size
        groups = min(groups * 2, n)


def top_k(df: DataFrame, is_query: str, k: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows with the greatest integer inner product with each query row, ties to the smaller id.

    ``is_query`` is an expression over ``vec_id``. Queries and data are grouped by pivots; summaries
    of each cell settle, on the driver and within a bound set by ``MAX_PIVOTS``, which data each
    group of queries needs; that data is sent in chunks, each held against at most
    ``QUERY_CHUNK`` queries; the chunks' best are merged. Returns query_id, rank, vec_id, score.

    Vectors null, with null or non-finite components or without an id take no part. Shorter
    vectors count as padded with zeros. Equal rows count once; a query never meets rows of its own
    id. Products must fit into 2**53 to be exact. Other columns are not read. No rows, no output.
    """
    spark = ship(df.sparkSession)
    vectors = written(scaled(df, id_column, vector).withColumn("is_query", F.expr(is_query)), "knn-vectors")
    shape = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not shape[0]:
        return spark.createDataFrame([], schema)
    width = max(shape[1], 1)
    n_pivots = min(MAX_PIVOTS, max(1, int(shape[0] ** 0.5)))
    picked = vectors.select("v").distinct().orderBy(F.xxhash64(F.col("v").cast("string")), F.col("v")).limit(n_pivots).toPandas()
    pivots = _matrix(picked.v, width)
    placed = written(_cells(vectors, pivots), "knn-cells")
    # The query's own row may be among the nearest of a cell: one more than k is needed to be sure of k.
    nearest = placed.withColumn("_near", F.row_number().over(W.partitionBy("cell", F.pmod(F.xxhash64("vec_id"), F.lit(32))).orderBy("dist"))).where(f"_near <= {k + 1}")
    nearest = nearest.groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("dist")), 1, k + 1).alias("near"))
    asked = F.when(F.col("is_query"), F.lit(1))
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("reach"), F.count(asked).alias("q_n"),
                                       F.coalesce(F.max(asked * F.col("dist")), F.lit(0.0)).alias("q_reach"),
                                       F.coalesce(F.max(asked * F.col("norm")), F.lit(0.0)).alias("q_norm")).join(nearest, "cell").toPandas()
    group, need, size = _plan(pivots, cells, k + 1)
    n_groups = len(need)
    load = ((need <= cells.set_index("cell").reach.reindex(range(len(pivots))).fillna(-1).to_numpy()) * size).sum(1)
    chunks = np.maximum(1, np.ceil(load / DATA_CHUNK)).astype(int)
    q_load = np.bincount(group, cells.set_index("cell").q_n.reindex(range(len(pivots))).fillna(0).to_numpy(), n_groups)
    q_chunks = np.maximum(1, np.ceil(q_load / QUERY_CHUNK)).astype(int)

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Data to each group that needs it, into one chunk of data and all chunks of queries."""
        for part in parts:
            for g in range(n_groups):
                near = part[part.dist.to_numpy() >= need[g, part.cell.to_numpy()]]
                for q in range(q_chunks[g]) if len(near) else ():
                    yield pd.DataFrame({"grp": g, "chunk": _dealt(near.vec_id, chunks[g]), "q_chunk": q, "vec_id": near.vec_id, "v": near.v})

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries to all chunks of their group."""
        for part in parts:
            home = group[part.cell.to_numpy()]
            for g in np.unique(home):
                mine = part[home == g]
                for c in range(chunks[g]):
                    yield pd.DataFrame({"grp": g, "chunk": c, "q_chunk": _dealt(mine.vec_id, q_chunks[g]), "vec_id": mine.vec_id, "v": mine.v})

    sent = "grp int, chunk long, q_chunk long, vec_id long, v array<long>"
    data = placed.select("vec_id", "v", "cell", "dist").mapInPandas(send, sent)
    queries = placed.where("is_query").select("vec_id", "v", "cell").mapInPandas(ask, sent)

    def solve(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            rows = rows.sort_values("vec_id", kind="stable")
            ids, x, own = rows.vec_id.to_numpy(), _matrix(rows.v, width), asked.vec_id.to_numpy()
            q = _matrix(asked.v, width)
            for at in range(0, len(own), 256):
                scores = q[at:at + 256] @ x.T
                scores[own[at:at + 256, None] == ids] = -np.inf
                for i, row in enumerate(scores):
                    # All at least as good as the k-th, as ties are settled by id; a stable sort keeps ids in order.
                    floor = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                    top = np.flatnonzero((row >= floor) & (row > -np.inf))
                    top = top[np.argsort(-row[top], kind="stable")][:k]
                    found.append(pd.DataFrame({"query_id": own[at + i], "vec_id": ids[top], "score": row[top].astype("int64")}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    keys = ["grp", "chunk", "q_chunk"]
    best = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.distinct().withColumn("rank", F.row_number().over(order).cast("int")).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def op3_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


OP3_SQL = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i, len(embedding) AS n
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
usable AS (SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))),
ints AS (SELECT vec_id, i, floor(256 * x)::BIGINT AS x FROM parts WHERE vec_id IN (SELECT vec_id FROM usable)),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, sum(q.x * d.x)::BIGINT AS score
  FROM ints q JOIN ints d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, d.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
