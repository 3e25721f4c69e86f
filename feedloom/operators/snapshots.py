"""What one day's catalog takes over from the day before, and what it says about itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, times
from ..functions.products import is_junk
from ..functions.text import blank, strip


def carried_forward(current: DataFrame, previous: DataFrame, as_of: Column) -> DataFrame:
    """Rows of ``previous`` (id, brand, name, price, last_seen_at, added_at, ...) that stay for a while.

    Of brands with no row today, the rows whose id isn't there today, that
    aren't junk by today's rules, and that were seen within the days of grace.
    Today's brands are compared without white space at the ends, earlier ones as they are.
    An id that ``previous`` has more than once is carried once, with the smallest of its brands, names and prices.
    """
    from .selection import keep_first

    present = current.select(strip(blank(F.col("brand"))).alias("brand")).distinct()
    seen = current.select("id").distinct()
    fine = ~is_junk(F.col("name"), F.col("price"), F.lit("")) & times.seen_within(F.col("last_seen_at"), F.col("added_at"), as_of)
    # A brand with a row today is left out by the same hash join whatever its size.
    left = previous.where((blank(F.col("brand")) != "") & F.col("id").isNotNull() & fine).join(present, "brand", "left_anti").join(seen, "id", "left_anti")
    return keep_first(left, ["id"], ["brand", "name", "price"])


def added_at(products: DataFrame, previous: DataFrame, as_of: Column) -> DataFrame:
    """``products`` with the day each was first seen.

    A known day stays; a product known without one is dated back; a new one is of now.
    """
    known = previous.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("added_at").alias("x_added"), F.lit(True).alias("x_known"))
    joined = products.drop("added_at").join(known, "id", "left")
    stamp = F.coalesce("x_added", F.when(F.col("x_known"), as_of - F.expr(f"INTERVAL {rules.BACKDATE_DAYS} DAY")).otherwise(as_of))
    return joined.withColumn("added_at", stamp).drop("x_added", "x_known")


def image_loads(url: Column, status: Column, content_type: Column) -> Column:
    """Whether a checked image can be shown; only web addresses can."""
    kind = F.lower(blank(content_type))
    return blank(url).startswith("http") & F.coalesce(status.isin(200, 206), F.lit(False)) & kind.startswith("image/") & ~kind.rlike("^image/hei[cf]")


def repaired_images(hero: Column, images: Column, good: Column) -> Column:
    """(hero, images): the first image that loads before the others, five at most; null if none does.

    ``good`` is the array of the row's URLs that load.
    """
    every = F.array_distinct(F.filter(F.concat(F.array(hero), F.coalesce(images, F.array().cast("array<string>"))), lambda u: blank(u) != ""))
    first = F.get(F.filter(every, lambda u: F.array_contains(good, u)), F.lit(0))
    rest = F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda u: u != first)
    return F.when(first.isNotNull(), F.struct(first.alias("hero"), F.slice(F.concat(F.array(first), rest), 1, 5).alias("images")))


def guarded_drop(df: DataFrame, dropped: Column, brand: str = "brand", limit: float = rules.DROP_GUARD) -> DataFrame:
    """Rows without the ``dropped`` ones, with ``validated`` (whether the drop was believed).

    Where more than ``limit`` of all rows, or of a brand's, would go, the check
    is taken to have failed: the rows stay, as they were. Brand counts are
    joined, not windowed, so that one large brand isn't sorted in one task.
    """
    marked = df.withColumn("x_drop", F.coalesce(dropped, F.lit(False)))
    of_brand = marked.groupBy(F.col(brand).alias("x_brand")).agg(F.count(F.lit(1)).alias("x_n"), F.count_if("x_drop").alias("x_gone"))
    of_all = of_brand.agg(F.sum("x_n").alias("x_all"), F.sum("x_gone").alias("x_all_gone"))
    ratios = of_brand.join(F.broadcast(of_all)).select("x_brand", ((F.col("x_gone") / F.col("x_n") > limit) | (F.col("x_all_gone") / F.greatest("x_all", F.lit(1)) > limit)).alias("x_doubt"))
    joined = marked.join(ratios, F.col(brand).eqNullSafe(F.col("x_brand")), "left").drop("x_brand")
    return joined.where(F.col("x_doubt") | ~F.col("x_drop")).withColumn("validated", ~F.col("x_doubt")).drop("x_drop", "x_doubt")


def validated_images(df: DataFrame, checks: DataFrame, item: str = "id", hero: str = "image_url", images: str = "images") -> DataFrame:
    """Rows (unique by ``item``) with images that load: repaired, or dropped where none does, within ``guarded_drop``.

    ``checks``: url, status, content_type; an image without a check doesn't load.
    """
    loads = checks.where(image_loads(F.col("url"), F.col("status"), F.col("content_type"))).select("url").distinct()
    urls = df.select(item, F.explode(F.array_distinct(F.concat(F.array(hero), F.coalesce(images, F.array().cast("array<string>"))))).alias("url")).where("url IS NOT NULL")
    good = urls.join(loads, "url").groupBy(item).agg(F.collect_set("url").alias("x_good"))
    checked = df.join(good, item, "left").withColumn("x_made", repaired_images(F.col(hero), F.col(images), F.coalesce("x_good", F.array().cast("array<string>"))))
    kept = guarded_drop(checked, F.col("x_made").isNull())
    use = F.col("validated") & F.col("x_made").isNotNull()
    return kept.withColumns({hero: F.when(use, F.col("x_made.hero")).otherwise(F.col(hero)), images: F.when(use, F.col("x_made.images")).otherwise(F.col(images))}).drop("x_good", "x_made", "validated")


def category_mix(df: DataFrame) -> DataFrame:
    """Rows of each category; sort by ``n`` to show."""
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def content_stats(df: DataFrame) -> DataFrame:
    """(n, n_neutral, part): rows, and those with nothing but the default colour."""
    neutral = F.count_if(F.col("color_tags") == F.array(*map(F.lit, rules.DEFAULT_COLORS)))
    return df.agg(F.count(F.lit(1)).alias("n"), neutral.alias("n_neutral")).withColumn("part", F.col("n_neutral") / F.greatest("n", F.lit(1)))


def may_publish(df: DataFrame, least: int = rules.MIN_PUBLISHED) -> bool:
    """Whether there are enough rows. Ask before the catalog is written."""
    return df.limit(least).count() >= least


def carried_counts(carried: DataFrame) -> DataFrame:
    return carried.agg(F.countDistinct("brand").alias("labels"), F.count(F.lit(1)).alias("items"))


def latest_by_id(df: DataFrame, order: str = "pos") -> DataFrame:
    """Of rows with one id, the last."""
    last = F.row_number().over(Window.partitionBy("id").orderBy(F.desc(order)))
    return df.where(blank(F.col("id").cast("string")) != "").withColumn("x_last", last).where("x_last = 1").drop("x_last")
