"""Queries over landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landed
from ..sources.tables import table
from .queries import query

#: Twelve crawled pages on end are a store's; a page is asked for four products, a walk for eight pages.
PAGES, LIMIT, MOST = 12, 4, 8


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """Crawled pages as a store's pages, with short, empty and idless ones, copies, and lost links among them."""
    page = F.col("page_id")

    def ids(p: Column) -> Column:
        none = F.lit(None).cast("long")
        full = [p * 10 + k for k in (3, 9, 1, 2)]
        return F.when(p % 11 == 0, F.array().cast("array<bigint>")).when(p % 7 == 0, F.array(*full[:2])).when(p % 17 == 0, F.array(*[none] * 4)).otherwise(F.array(*full))

    place = page % PAGES
    since = F.when(place == 0, None).when(page % 13 == 0, -1).when((page % 9 == 0) & (place > 1), landed.last_id(ids(page - 2))).otherwise(landed.last_id(ids(page - 1)))
    product = F.transform(ids(page), lambda i, k: F.struct(i.alias("id"), F.concat("url", F.lit("#"), k.cast("string")).alias("handle")))
    return table(spark, folder, "pages").select(F.concat(F.lit("store"), F.floor(page / PAGES).cast("string")).alias("domain"), since.cast("long").alias("since_id"), page.alias("landed"), ids(page).alias("ids"), product.alias("products"))


_SQL_LAST = "CASE WHEN {p} % 11 = 0 THEN NULL WHEN {p} % 7 = 0 THEN {p} * 10 + 9 WHEN {p} % 17 = 0 THEN NULL ELSE {p} * 10 + 2 END"
_SQL_WALK = f"""
WITH RECURSIVE p AS (
  SELECT 'store' || page_id // {PAGES} AS domain, page_id AS landed, url, CASE WHEN page_id % 11 = 0 THEN 0 WHEN page_id % 7 = 0 THEN 2 ELSE 4 END AS n, {_SQL_LAST.format(p="page_id")} AS next_id,
    CASE WHEN page_id % {PAGES} = 0 THEN NULL WHEN page_id % 13 = 0 THEN -1 WHEN page_id % 9 = 0 AND page_id % {PAGES} > 1 THEN {_SQL_LAST.format(p="(page_id - 2)")} ELSE {_SQL_LAST.format(p="(page_id - 1)")} END AS since_id
  FROM pages
), h AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY domain, since_id ORDER BY landed DESC) = 1),
w AS (
  SELECT 0 AS step, * FROM h WHERE since_id IS NULL
  UNION ALL SELECT step + 1, h.* FROM w JOIN h ON h.domain = w.domain AND h.since_id = w.next_id WHERE w.n = {LIMIT} AND step + 1 < {MOST}
), walk AS (
  SELECT w.*, CASE WHEN n = 0 THEN 'empty' WHEN n < {LIMIT} THEN 'short' WHEN next_id IS NULL THEN 'no id' WHEN step + 1 >= {MOST} THEN 'bound'
    WHEN EXISTS (SELECT 1 FROM h WHERE h.domain = w.domain AND h.since_id = w.next_id) THEN 'more' ELSE 'unlanded' END AS state FROM w
)"""


@query(_SQL_WALK + " SELECT domain, step::INT AS step, since_id, landed, n::INT AS n, next_id, state FROM walk")
def page_chains(spark: SparkSession, folder: str) -> DataFrame:
    """S3: the walk through each store's pages, and why it ends."""
    return landed.page_chains(_landed(spark, folder), LIMIT, MOST)


@query(
    _SQL_WALK
    + f""" SELECT domain, (step * {LIMIT} + k)::BIGINT AS pos, CASE WHEN landed % 7 = 0 OR landed % 17 <> 0 THEN landed * 10 + [3, 9, 1, 2][k + 1] END AS id, url || '#' || k AS handle
FROM (SELECT *, unnest(range(n)) AS k FROM walk)"""
)
def chained_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products of every page that a walk takes, in its order."""
    rows = _landed(spark, folder)
    return landed.chained_products(rows, landed.page_chains(rows, LIMIT, MOST), limit=LIMIT)
