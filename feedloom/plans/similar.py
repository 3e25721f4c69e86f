"""Queries that search the published int8 vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import payload
from ..sources.tables import table
from .queries import query

NEAREST = 5


def _published(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, folder, "embeddings")
    return payload.published(items, "vec_id", "embedding"), items


_SQL_ALL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE len(embedding) > 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(c, 9) DESC, neighbour_id)::INT AS rank FROM p)"""


@query(_SQL_ALL + f" SELECT query_id, rank, neighbour_id, round(c, 6) AS cosine FROM r WHERE rank <= {NEAREST}")
def knn_published(spark: SparkSession, folder: str) -> DataFrame:
    """More like each item, among all items, found on their int8 vectors."""
    rows, items = _published(spark, folder)
    return payload.k_nearest_published(rows, items, None, NEAREST, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 6))


@query(
    f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE len(embedding) > 0),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS v FROM v),
q AS (SELECT vec_id, v, list_transform(v, lambda x: greatest(-127, least(127, round_even((x::FLOAT * 127::FLOAT)::DOUBLE, 0)))) AS q FROM u),
d AS (SELECT vec_id, q, sqrt(list_sum(list_transform(list_zip(v, q), lambda z: pow(z[1] - z[2] / 127, 2)))) AS rest, sqrt(list_sum(list_transform(q, lambda x: x * x))) / 127 AS length FROM q),
p AS (
  SELECT a.vec_id AS query_id, list_inner_product(a.q, b.q) / (127 * 127) AS c, a.rest * b.length + a.length * b.rest + a.rest * b.rest AS err
  FROM d a JOIN d b ON a.vec_id <> b.vec_id
), f AS (SELECT query_id, min(low) AS floor FROM (SELECT query_id, c - err AS low, row_number() OVER (PARTITION BY query_id ORDER BY c - err DESC) AS rn FROM p) WHERE rn <= {NEAREST} GROUP BY query_id)
SELECT query_id, count(*) FILTER (c + err >= floor - 2e-9) AS n_left, count(*) AS n_others FROM p JOIN f USING (query_id) GROUP BY query_id"""
)
def knn_published_left(spark: SparkSession, folder: str) -> DataFrame:
    """How many other items the bound leaves for an exact look, of how many."""
    rows, items = _published(spark, folder)
    left = payload.n_candidates(rows, rows, NEAREST)
    return left.withColumn("n_others", F.lit(items.where(F.size("embedding") > 0).count() - 1).cast("long"))
