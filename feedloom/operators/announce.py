"""Who hears of a new brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import blank, strip
from .selection import keep_first


def recipients(new_brands: DataFrame, follows: DataFrame) -> DataFrame:
    """(brand, user_id, is_requester): who asked for the brand, and who follows it by exactly this name; each once."""
    named = new_brands.where(blank(F.col("brand")) != "")
    asked = named.where(blank(F.col("user_id").cast("string")) != "").select("brand", "user_id", F.lit(True).alias("is_requester"))
    following = named.select("brand").distinct().join(follows.where(F.col("user_id").isNotNull()).select("brand", "user_id"), "brand").withColumn("is_requester", F.lit(False))
    return keep_first(asked.unionByName(following), ["brand", "user_id"], [F.desc("is_requester")])


def messages(people: DataFrame, profiles: DataFrame, place: str = "the feed") -> DataFrame:
    """(brand, user_id, to, body) for recipients with a valid push token; ``profiles``: id, push_token."""
    token = strip(blank(F.col("push_token")))
    valid = token.startswith(rules.PUSH_PREFIXES[0]) | token.startswith(rules.PUSH_PREFIXES[1])
    joined = people.join(profiles.select(F.col("id").alias("user_id"), token.alias("to"), valid.alias("x_valid")).where("x_valid"), "user_id")
    asked, followed = (F.concat(F.lit(a.format(place=place)), "brand", F.lit(b.format(place=place))) for a, b in (rules.SAY_ASKED, rules.SAY_FOLLOWED))
    return joined.select("brand", "user_id", "to", F.when(F.col("is_requester"), asked).otherwise(followed).alias("body"))


def notified_updates(new_brands: DataFrame, as_of) -> DataFrame:
    """Every announced request is stamped, whether or not anyone could be reached."""
    done = new_brands.where((blank(F.col("brand")) != "") & F.col("request_id").isNotNull())
    return done.select(F.col("request_id").alias("id")).distinct().withColumn("notified_at", as_of)
