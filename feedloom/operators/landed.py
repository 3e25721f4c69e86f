"""Walks through a store's pages, rebuilt from what landed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

#: Products that a page is asked for, and pages of a walk, at most.
PAGE_LIMIT, MOST_PAGES = 250, 20


def last_id(ids: Column) -> Column:
    """The last integer id on a page, in the page's order; null if it has none."""
    return F.try_element_at(F.filter(ids, lambda i: i.isNotNull()), F.lit(-1))


def page_chains(pages: DataFrame, limit: int = PAGE_LIMIT, most: int = MOST_PAGES) -> DataFrame:
    """(domain, step, since_id, landed, n, next_id, state) of each page that a domain's walk takes.

    ``pages``: domain, since_id (null for a first page), landed (what tells the
    page's copies apart and orders them), ids (of its products, in order; those
    that are no integers null). Of pages with one cursor the one that landed last
    counts. A walk goes from the page without a cursor to the one whose cursor
    is the last integer id before, not the largest. ``state`` says why it ends:
    ``empty`` (such a page has no products), ``short`` (fewer than ``limit``),
    ``no id`` to go on from, ``bound`` (``most`` pages), or ``unlanded`` (the next
    page isn't there: the walk stopped, or broke); until then it is ``more``. A
    page may come again in a walk whose cursor returns to it.

    Rows with a null domain take no part; a domain without a first page has no
    walk; no pages give no rows.
    """
    n = F.coalesce(F.size("ids"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    seen = pages.where("domain IS NOT NULL").select("domain", F.col("since_id").cast("long"), F.struct("landed", n.alias("n"), last_id(F.col("ids")).cast("long").alias("next_id")).alias("p"))
    # Only this travels: of copies, however many, the last, by Spark's partial aggregate.
    heads = materialize(seen.groupBy("domain", "since_id").agg(F.max("p").alias("p")).select("domain", "since_id", "p.*"))
    at = heads.where("since_id IS NULL")
    later = heads.where("since_id IS NOT NULL")
    walked = []
    for step in range(most):
        ends = (
            F.when(F.col("n") == 0, "empty").when(F.col("n") < limit, "short").when(F.col("next_id").isNull(), "no id")
            .when(F.lit(step + 1 >= most), "bound").otherwise("more")
        )
        at = at.select("domain", F.lit(step).alias("step"), "since_id", "landed", "n", "next_id", ends.alias("state"))
        ahead = at.where("state = 'more'").select("domain", F.col("next_id").alias("since_id"))
        found = materialize(ahead.join(later, ["domain", "since_id"]))
        there = found.select("domain", F.lit(True).alias("x_there"))
        walked.append(materialize(at.join(there, "domain", "left").withColumn("state", F.when((F.col("state") == "more") & F.col("x_there").isNull(), "unlanded").otherwise(F.col("state"))).drop("x_there")))
        # Each round has the walks that go on, and their next page only.
        if found.isEmpty():
            break
        at = found
    return reduce(DataFrame.unionByName, walked)


def chained_products(pages: DataFrame, chains: DataFrame, products: str = "products", limit: int = PAGE_LIMIT) -> DataFrame:
    """(domain, pos, and the fields of a product) in the order of each walk; ``pages`` as for ``page_chains``, with ``products``."""
    steps = chains.where("n > 0").select("step", F.col("domain").alias("x_domain"), F.col("since_id").alias("x_since"), F.col("landed").alias("x_landed"))
    same = (F.col("domain") == F.col("x_domain")) & F.col("since_id").cast("long").eqNullSafe(F.col("x_since")) & (F.col("landed") == F.col("x_landed"))
    each = pages.join(steps, same).select("domain", "step", F.posexplode(products).alias("i", "p"))
    return each.select("domain", (F.col("step").cast("long") * limit + F.col("i")).alias("pos"), "p.*")
