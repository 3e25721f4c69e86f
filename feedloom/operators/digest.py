"""Price drops and size changes among what a user saved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, products, rules, times
from ..functions.text import blank, strip
from .selection import keep_first


def alerts(saved: DataFrame, live: DataFrame) -> DataFrame:
    """One row an alert, ranked in each user's list: sales by percent, then restocks by how many sizes came back.

    ``saved``: user_id, pos, product_id, price_at_save, saved_id, saved_sizes.
    ``live``: id, price, sizes, brand, name. An item counts once a user, as first saved.
    """
    pid = F.coalesce(F.nullif(F.col("product_id").cast("string"), F.lit("")), F.nullif(F.col("saved_id").cast("string"), F.lit("")))
    # What depends on the catalog alone is made once a product, before the join.
    live = live.select(F.col("id").cast("string").alias("pid"), "price", strip(blank(F.col("brand"))).alias("brand"), strip(blank(F.col("name"))).alias("name"), products.distinct_sizes(F.col("sizes")).alias("new"))
    live = live.withColumn("new_canon", products.canon_sizes(F.col("new")))
    # A live product is there for all of a user's savings of it or for none: rows
    # go to their product once, where a user's first is found and joined, in one
    # sort by product and user.
    dealt = saved.withColumn("pid", pid).where("pid IS NOT NULL").repartition("pid")
    once = keep_first(dealt, ["pid", "user_id"], ["pos"]).select("user_id", "pid", "pos", "price_at_save", "saved_sizes").join(live, "pid")
    drop = money.meaningful_drop(F.col("price"), F.col("price_at_save"))
    once = once.withColumn("old", products.distinct_sizes(F.col("saved_sizes"))).withColumn("old_canon", products.canon_sizes(F.col("old")))
    both = (F.size("old") > 0) & (F.size("new") > 0)
    none = F.array().cast("array<string>")
    missing = lambda of, there: products.sizes_missing(F.col(of), F.col(f"{of}_canon"), F.col(f"{there}_canon"))
    made = once.select(
        "user_id", "pid", "pos", "brand", "name",
        F.when(drop, F.col("price_at_save").cast("double")).alias("was"),
        F.when(drop, F.col("price").cast("double")).alias("now"),
        F.when(drop, money.sale_percent(F.col("price"), F.col("price_at_save"))).alias("pct"),
        F.when(both, missing("new", "old")).otherwise(none).alias("new_sizes"),
        F.when(both, missing("old", "new")).otherwise(none).alias("gone_sizes"),
    )
    made = made.where(F.col("pct").isNotNull() | (F.size("new_sizes") > 0) | (F.size("gone_sizes") > 0))
    order = Window.partitionBy("user_id").orderBy(F.coalesce(-F.col("pct"), F.lit(1)), -F.size("new_sizes"), "pos")
    return made.withColumn("rank", F.row_number().over(order))


def signature_part() -> Column:
    """An alert as text, alike for the same state."""
    sizes = lambda sign, c: F.when(F.size(c) > 0, F.concat(F.lit(sign), F.array_join(F.array_sort(c), "|"))).otherwise("")
    sale = F.when(F.col("pct").isNotNull(), F.concat(F.lit("s"), money.price_text(F.col("now")))).otherwise("")
    return F.concat(F.col("pid"), F.lit(":"), sale, sizes("+", "new_sizes"), sizes("-", "gone_sizes"))


def summaries(found: DataFrame) -> DataFrame:
    """(user_id, signature, n_sales, n_restocks, title, body); no title where nothing is worth a message."""
    sale, restock = F.col("pct").isNotNull(), F.col("pct").isNull() & (F.size("new_sizes") > 0)
    label = strip(F.concat(F.when(F.col("brand") != "", F.concat("brand", F.lit(" "))).otherwise(""), F.col("name")))
    lead = lambda when: F.min_by(F.struct(label.alias("label"), "pct", "now", F.get("new_sizes", F.lit(0)).alias("size")), F.when(when, F.col("rank")))
    out = found.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_list(signature_part())), ";").alias("signature"),
        F.count_if(sale).alias("n_sales"), F.count_if(restock).alias("n_restocks"),
        lead(sale).alias("sale"), lead(restock).alias("restock"),
    )
    named = lambda c: F.when(F.col(c) != "", F.col(c)).otherwise(rules.SAY_NAMELESS)
    more = lambda n, words: F.concat(F.lit(" +"), n.cast("string"), F.lit(words))
    sale_tail = F.when(F.col("n_sales") > 1, more(F.col("n_sales") - 1, rules.SAY_MORE_SALES)).when(F.col("n_restocks") > 0, more(F.col("n_restocks"), rules.SAY_ALSO_BACK)).otherwise("")
    sale_body = F.concat(named("sale.label"), F.lit(rules.SAY_SALE[0]), F.col("sale.pct").cast("string"), F.lit(rules.SAY_SALE[1]), money.price_text(F.col("sale.now")), F.lit(rules.SAY_SALE[2]), sale_tail)
    back_tail = F.when(F.col("n_restocks") > 1, more(F.col("n_restocks") - 1, rules.SAY_MORE_BACK)).otherwise("")
    back_body = F.concat(named("restock.label"), F.lit(rules.SAY_BACK[0]), F.col("restock.size"), F.lit(rules.SAY_BACK[1]), back_tail)
    return out.select(
        "user_id", "signature", "n_sales", "n_restocks",
        F.when(F.col("n_sales") > 0, rules.SAY_SALE_TITLE).when(F.col("n_restocks") > 0, rules.SAY_BACK_TITLE).alias("title"),
        F.when(F.col("n_sales") > 0, sale_body).when(F.col("n_restocks") > 0, back_body).alias("body"),
    )


def due(users: DataFrame, as_of: Column) -> DataFrame:
    """Users (id, token, last_sig, last_push_at, active_at) that may get a message: none yet today, and not active lately."""
    return users.where((blank(F.col("token")) != "") & ~times.pushed_today(F.col("last_push_at"), as_of) & ~times.recently_active(F.col("active_at"), as_of))


def digests(users: DataFrame, found: DataFrame, as_of: Column) -> DataFrame:
    """The messages to send, and the stamps to keep: only to users whose alerts changed since the last one."""
    joined = due(users, as_of).join(summaries(found).where("title IS NOT NULL"), F.col("id") == F.col("user_id"))
    fresh = joined.where(~F.col("signature").eqNullSafe(F.col("last_sig")))
    return fresh.select(F.col("user_id"), F.col("token").alias("to"), "title", "body", "signature", as_of.alias("last_push_at"))
