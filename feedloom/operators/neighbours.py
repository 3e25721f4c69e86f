"""Cosine neighbours of embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize

#: Rows of about so many vectors are compared with as many queries at a time.
BLOCK = 2048
#: Cosines that differ less than this many decimals are equal.
DECIMALS = 9


def _in_blocks(vectors: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(block, ids, vectors) of about BLOCK rows each, dealt by a hash of the id; and the number of blocks."""
    n = max(1, -(-vectors.count() // BLOCK))
    dealt = vectors.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(name)).agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("rows"))
    return dealt.select(name, F.col("rows.id").alias(f"{name}_ids"), F.flatten("rows.v").alias(f"{name}_vectors")), n


def _best(k: int):
    """(query ids, query vectors, ids, vectors) to each query's ``k`` nearest among the ids, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                q_ids, q, ids, v = (b.column(c)[row].values.to_numpy() for c in range(4))
                cosines = q.reshape(len(q_ids), -1) @ v.reshape(len(ids), -1).T
                ranked = np.where(q_ids[:, None] == ids, -np.inf, np.round(cosines, DECIMALS))
                # Ids are in order, and the sort is stable: ties go to the smaller one.
                at = np.argsort(-ranked, axis=1, kind="stable")[:, :k]
                fits = np.take_along_axis(ranked, at, 1) > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, at.shape[1])[fits.ravel()]), pa.array(ids[at][fits]), pa.array(np.take_along_axis(cosines, at, 1)[fits])], names=["query_id", "neighbour_id", "cosine"])

    return run


def k_nearest(df: DataFrame, queries: DataFrame, k: int = 5, item: str = "id", vector: str = "vec") -> DataFrame:
    """(query_id, rank, neighbour_id, cosine): the ``k`` nearest rows of ``df`` to each of the ``queries``, but itself.

    Both are of the same columns, the ids integers, all vectors of one length;
    rows without a vector take no part. Blocks of vectors meet blocks of queries,
    each pair of blocks keeps ``k`` a query, and these are ranked. Of equal
    cosines the smaller id comes first.
    """
    normal = lambda d: d.where(F.size(vector) > 0).select(F.col(item).cast("long").alias("id"), l2_normalize(F.col(vector)).cast("array<double>").alias("v"))
    vectors, _ = _in_blocks(normal(df), "b")
    asked, n_queries = _in_blocks(normal(queries), "q")
    met = vectors.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))).join(asked, "q").select("q_ids", "q_vectors", "b_ids", "b_vectors")
    found = met.mapInArrow(_best(k), "query_id long, neighbour_id long, cosine double")
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("cosine", DECIMALS)), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(df: DataFrame, sample: int = 300, item: str = "id", vector: str = "vec") -> DataFrame:
    """A report on a sample: the nearest row to each of the first ``sample`` rows by id."""
    return k_nearest(df, df.orderBy(item).limit(sample), 1, item, vector).drop("rank")
