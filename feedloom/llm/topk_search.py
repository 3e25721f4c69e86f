"""Exact top-k inner product search by Fagin's threshold algorithm."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import session, table, written

#: Vectors in a block (each block has its own sorted lists) and queries in a group.
BLOCK_ROWS = 8192
GROUP_QUERIES = 1024
FIRST_DEPTH = 8

_OUT = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("v", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Block:
    """Vectors with, for every dimension, the list of rows sorted by that component."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        # Rows stand in order of id, so that of equal scores the first wins.
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.x = rows[order], ids[order], vectors[order]
        self.lists = np.argsort(self.x, axis=0, kind="stable")  # ascending, one column a dimension
        self.sorted = np.take_along_axis(self.x, self.lists, axis=0)

    def top(self, q: np.ndarray, k: int, own: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best rows but row ``own``, best first; rows below a ``floor`` that k others reach may be left out.

        Reads all lists from their better end to the same depth, scores every
        row that is met, and stops when the sum of the last components read (the
        most that an unmet row can score) is below the kth score, or the floor.
        """
        n = len(self.ids)
        dims = np.flatnonzero(q)
        down = q[dims] > 0
        weights = q[dims]
        seen = np.zeros(n, dtype=bool)
        seen[self.rows == own] = True
        best = np.empty(0, dtype=np.int64)
        scores = np.empty(0, dtype=np.int64)
        depth, step = 0, FIRST_DEPTH
        while True:
            until = min(n, depth + step)
            if len(dims):
                met = np.concatenate([self.lists[n - until : n - depth, dims[down]].ravel(), self.lists[depth:until, dims[~down]].ravel()])
            else:
                met, until = np.arange(n), n
            fresh = np.unique(met[~seen[met]])
            seen[fresh] = True
            best = np.concatenate([best, fresh])
            scores = np.concatenate([scores, self.x[fresh] @ q])
            order = np.lexsort((best, -scores))[:k]
            best, scores = best[order], scores[order]
            bar = scores[-1] if len(best) == k else floor
            bar = bar if floor is None else max(bar, floor)
            if until < n and bar is not None:
                last = np.where(down, self.sorted[n - until, dims], self.sorted[until - 1, dims])
            if until == n or (bar is not None and int(weights @ last) < bar):
                fits = slice(None) if floor is None else scores >= floor
                return best[fits], scores[fits]
            depth, step = until, step * 2


def _vectors(t: pa.Table, column: str) -> np.ndarray:
    flat = t[column].combine_chunks()
    flat = flat.values if isinstance(flat, pa.ListArray) else flat.flatten()
    return flat.to_numpy().reshape(t.num_rows, -1).astype(np.int64)


def _search(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _OUT.empty_table()
        block = Block(vectors["v"].to_numpy(), vectors["vec_id"].to_numpy(), _vectors(vectors, "x"))
        qs, found = _vectors(queries, "x"), []
        for q, own, floor in zip(qs, queries["v"].to_numpy(), queries["floor"].to_pylist()):
            found.append(block.top(q, k, own, floor))
        n = [len(b) for b, _ in found]
        at = np.concatenate([b for b, _ in found])
        return pa.Table.from_arrays(
            [
                pa.array(np.repeat(queries["v"].to_numpy(), n)),
                pa.array(np.repeat(queries["vec_id"].to_numpy(), n)),
                pa.array(block.rows[at]),
                pa.array(block.ids[at]),
                pa.array(np.concatenate([s for _, s in found]).astype(np.int64)),
            ],
            schema=_OUT,
        )

    return run


def top_k(df: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best other rows by inner product.

    Components become floor(scale * x); queries are the rows whose key is
    divisible by ``every``. Vectors are dealt into blocks of about BLOCK_ROWS,
    queries into groups of about GROUP_QUERIES; each pair of block and group is
    one task's work and gives at most k rows a query, of which the best k stay.
    The first block is searched before the others: its kth score is a floor that
    lets them stop earlier, and leave out what can't be among the best.
    Components travel in as few bytes as the largest of them needs.

    Ties go to the smaller key, then to the earlier row. Vectors that are null,
    empty, or hold a null or a value that isn't finite take no part, nor do
    rows with a null key; only vectors of a query's own length are compared
    with it. Repeated rows are rows of their own: a query leaves out only the
    very row it is. Fewer than k candidates give fewer ranks; an empty table
    gives no rows. Components must keep scores inside 64 bits.
    """
    spark = session(df)
    x = F.col(f"`{vector}`")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = df.where(F.col(f"`{key}`").isNotNull() & (F.size(x) > 0) & fine).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("x")
    )
    held = written(rows.withColumn("v", F.monotonically_increasing_id()), "vectors").withColumn("d", F.size("x"))
    is_query = F.col("vec_id") % every == 0
    least, largest = F.min(F.array_min("x")), F.max(F.array_max("x"))
    n, n_queries, least, largest = held.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), least, largest).first()
    widest = max(-(least or 0), largest or 0)
    held = held.withColumn("x", F.col("x").cast(f"array<{next(t for t, bits in (('smallint', 15), ('int', 31), ('bigint', 64)) if widest < 1 << bits)}>"))
    blocks, groups = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_queries // GROUP_QUERIES))

    spread = lambda n, seed: F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    vectors = held.select("v", "vec_id", "x", "d", spread(blocks, 1).alias("b"), each(groups).alias("g"))
    queries = held.where(is_query).select("v", "vec_id", "x", "d", spread(groups, 2).alias("g"), each(blocks).alias("b"))
    # Queries are vectors too: as columns of other names first, they can't be mistaken for them.
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns]).select(*[F.col(f"q_{c}").alias(c) for c in queries.columns])
    search = lambda v, q: v.groupBy("b", "g", "d").cogroup(q.groupBy("b", "g", "d")).applyInArrow(_search(k), "q long, query_id long, v long, vec_id long, score long")
    found = search(vectors.where("b = 0"), queries.where("b = 0").withColumn("floor", F.lit(None).cast("long")))
    if blocks > 1:
        found = written(found, "first-block")
        floors = found.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor")).withColumnRenamed("q", "v")
        found = found.unionByName(search(vectors.where("b > 0"), queries.where("b > 0").join(floors, "v", "left")))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "v")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x::DOUBLE[], v.x::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.x) = len(v.x)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

QUERIES = {"op3_topk_search": op3_topk_search}
ORACLES = {"op3_topk_search": ORACLE}
