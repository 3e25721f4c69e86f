"""From raw product rows to the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links, products, rules, text
from ..sources.tables import materialize
from .selection import effective_cap, interleave, is_excluded, name_repeats_removed, select_products
from .snapshots import added_at, carried_forward, validated_images


def with_store(raw: DataFrame, stores: DataFrame, fx: DataFrame) -> DataFrame:
    """Raw rows joined with their store (brand, domain, currency, multi_brand) and its rate; an unknown currency is worth 1."""
    rated = stores.join(fx, "currency", "left").withColumn("fx", F.coalesce("fx", F.lit(1.0)))
    return raw.join(rated, "store_order")


def with_template(df: DataFrame, templates: DataFrame, brand: str = "brand") -> DataFrame:
    """Rows with the affiliate ``template`` of their brand; ``templates`` has (brand_key, template)."""
    return df.withColumn("x_key", F.when(text.blank(F.col(brand)) != "", text.brand_key(F.col(brand)))).join(templates.withColumnRenamed("brand_key", "x_key"), "x_key", "left").drop("x_key")


def shown_brand(brand: Column, vendor: Column, multi_brand: Column) -> Column:
    """A shop of many brands shows the maker's name, if it has one."""
    maker = text.strip(text.blank(vendor))
    return F.when(F.coalesce(multi_brand, F.lit(False)) & ~F.lower(maker).isin("", "frontpage"), maker).otherwise(brand)


def normalized(rows: DataFrame) -> DataFrame:
    """Catalog rows of raw ones, which have their store's columns (see ``with_store``).

    What can't be shown or isn't worn is filtered before anything dearer is computed.
    """
    rows = rows.withColumns({"name": text.strip(text.blank(F.col("title"))), "image_url": products.first_image(F.col("images")), "x_price": products.first_price(F.col("variants"))})
    rows = rows.where((F.col("name") != "") & (text.blank(F.col("handle")) != "") & F.col("image_url").isNotNull() & (F.col("x_price") != 0))
    rows = rows.withColumn("price", products.usd(F.col("x_price"), F.col("fx"))).where("price > 0")
    rows = rows.where(~products.is_junk(F.col("name"), F.col("price"), F.col("product_type")))
    rows = rows.withColumn("store_brand", F.col("brand")).withColumn("brand", shown_brand(F.col("brand"), F.col("vendor"), F.col("multi_brand"))).where(~is_excluded(F.col("brand")))
    return rows.select(
        "store_order", "pos", "store_brand", "domain", "handle",
        F.concat(text.slugify(F.col("brand")), F.lit("-"), F.col("handle")).alias("id"),
        "brand", "name", "price",
        text.infer_category(F.col("product_type"), F.col("name")).alias("category"),
        text.infer_colors(F.col("name"), F.col("product_type"), F.col("tags"), F.col("options")).alias("color_tags"),
        "image_url",
        products.available_sizes(F.col("options"), F.col("variants")).alias("sizes"),
        products.gallery(F.col("images")).alias("images"),
    )


def selected(rows: DataFrame, per_brand: int) -> DataFrame:
    """Each store's rows within its cap, and within the cap of variants of one thing."""
    rows = rows.withColumns({"base": text.base_name(F.col("name")), "cap": effective_cap(F.col("store_brand"), per_brand)})
    return select_products(rows, most=max(per_brand, rules.MAINSTREAM_CAP)).drop("base", "cap")


def build(raw: DataFrame, stores: DataFrame, fx: DataFrame, templates: DataFrame, curated: DataFrame, previous: DataFrame, as_of: Column, seed: str, per_brand: int = 60, key: str = "", campaign: str = "", checks: DataFrame | None = None) -> DataFrame:
    """The catalog: scraped, curated and carried rows, in the order of (part, round, turn, pos).

    ``curated`` and ``previous`` have the catalog's columns. Curated links are
    wrapped; carried rows stay as they were, with their own stamp. If the
    results of image ``checks`` are given (url, status, content_type), rows are
    repaired or dropped by them, within the guard of ``validated_images``.
    """
    wrapped = lambda df: with_template(df, templates).withColumn("affiliate_url", links.wrap(F.col("affiliate_url"), F.col("template"), F.lit(key), F.lit(campaign))).drop("template")
    # What costs much or is read again is written: rows that the rules are asked about, and the few that are selected.
    scraped = materialize(selected(materialize(normalized(with_store(raw, stores, fx))), per_brand))
    scraped = scraped.withColumn("affiliate_url", F.concat(F.lit("https://"), "domain", F.lit("/products/"), "handle"))
    scraped = interleave(wrapped(scraped), "store_order", "id", seed).withColumn("part", F.lit(1))
    by_hand = curated.where(text.blank(F.col("id")) != "").join(scraped.select("id"), "id", "left_anti")
    by_hand = wrapped(by_hand).withColumn("part", F.lit(2))
    live = scraped.unionByName(by_hand, allowMissingColumns=True).withColumn("last_seen_at", as_of)
    kept = carried_forward(live, previous, as_of).withColumn("part", F.lit(3))
    every = live.drop("store_order", "store_brand", "domain", "handle").unionByName(kept, allowMissingColumns=True)
    if checks is not None:
        every = validated_images(materialize(every), checks)
    order = ["part", "round", "turn", "pos", "id"]
    every = name_repeats_removed(every, order).where(~is_excluded(F.col("brand")))
    return added_at(every, previous, as_of)
