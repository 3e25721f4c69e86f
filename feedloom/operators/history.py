"""Many days at once: how long things stayed in the catalog, and what users were sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.times import utc_day


def _runs(runs: DataFrame, days: int) -> DataFrame:
    """(at, before, grace): of each run the one before, and the last one within ``days`` after it. A row a run: few, however much each one saw."""
    seconds = F.col("at").cast("timestamp").cast("double")
    order = Window.orderBy("x_s")
    one = runs.select("at").where("at IS NOT NULL").distinct().withColumn("x_s", seconds)
    return one.select("at", F.lag("at").over(order).alias("before"), F.max("at").over(order.rangeBetween(0, days * 86_400)).alias("grace"))


def presence(sightings: DataFrame, runs: DataFrame | None = None, days: int = rules.GRACE_DAYS) -> DataFrame:
    """(id, brand, added_at, last_seen_at, until, n_seen): the spans of runs in which each thing was in the catalog.

    ``sightings``: id, brand, at, one for each thing that a run saw; ``runs``: at, of
    all runs, also of those that saw nothing (else those of the sightings). A
    thing that a run doesn't see stays while its brand has none seen either, to
    the last run ``days`` after it was seen at most; then it is gone, and new when
    it comes again. These are the rows of ``carried_forward`` and the dates of
    ``added_at``, for all runs together instead of one after the other: a thing
    stays from one sighting to the next if the run before the next isn't later
    than it may stay.

    ``until`` is the last run of the span, ``brand`` that of its last sighting. Of
    a run's rows with one id the smallest brand counts. Rows with a null id,
    brand or run take no part; no sightings give no rows.
    """
    seen = sightings.where("id IS NOT NULL AND brand IS NOT NULL AND at IS NOT NULL").groupBy("id", "at").agg(F.min("brand").alias("brand"))
    every = _runs(sightings if runs is None else runs.select("at").unionByName(sightings.select("at")), days)
    # What a thing may stay for depends on its brand and the run alone: a row for each.
    later = F.lead("at").over(Window.partitionBy("brand").orderBy("at"))
    of_brand = seen.select("brand", "at").distinct().withColumn("x_later", later)
    ends = every.select(F.col("at").alias("x_later"), F.col("before").alias("x_end"))
    stays = of_brand.join(every, "at").join(ends, "x_later", "left").select("brand", "at", "before", F.least("grace", "x_end").alias("until"))
    order = Window.partitionBy("id").orderBy("at")
    rows = seen.join(stays, ["brand", "at"])
    begins = F.coalesce(F.lag("until").over(order) < F.col("before"), F.lag("at").over(order).isNull())
    spans = rows.withColumn("x_begins", begins).withColumn("x_span", F.count_if("x_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max(F.struct("at", "brand", "until"))
    out = spans.groupBy("id", "x_span").agg(F.min("at").alias("added_at"), last.alias("x_last"), F.count(F.lit(1)).alias("n_seen"))
    return out.select("id", F.col("x_last.brand").alias("brand"), "added_at", F.col("x_last.at").alias("last_seen_at"), F.col("x_last.until").alias("until"), "n_seen")


def sends(states: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, at, signature) of each message sent in a run of days.

    ``states``: user_id, at, signature, of every time that a user's alerts were
    looked at and the user might have been written to. A message goes out if
    none went out on that day (in UTC) and the signature isn't that of the last
    message *sent*. ``users`` (id, last_sig, last_push_at) is what was sent before.

    Of a day's states two decide at most: the first, and the first that differs
    from it, whatever was sent before; so that a user's list, over which the
    messages are folded, has two entries a day. Of states at one time the
    smallest signature comes first. A null signature, user or time is no state.
    """
    known = states.where("user_id IS NOT NULL AND at IS NOT NULL AND signature IS NOT NULL").select("user_id", utc_day(F.col("at")).alias("day"), F.struct("at", "signature").alias("s"))
    first = known.groupBy("user_id", "day").agg(F.min("s").alias("first"))
    other = known.groupBy("user_id", "day", F.col("s.signature").alias("signature")).agg(F.min("s").alias("s"))
    other = other.join(first, ["user_id", "day"]).where("signature <> first.signature").groupBy("user_id", "day").agg(F.min("s").alias("other"))
    each = first.join(other, ["user_id", "day"], "left")
    listed = each.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", "first", "other"))).alias("days"))
    if users is None:
        begun = listed.withColumns({"x_sig": F.lit(None).cast("string"), "x_day": F.lit(None).cast("date")})
    else:
        before = users.select(F.col("id").alias("user_id"), F.col("last_sig").cast("string").alias("x_sig"), utc_day(F.col("last_push_at")).alias("x_day"))
        begun = listed.join(before, "user_id", "left")
    kind = known.select("s").schema["s"].dataType.simpleString()
    none = F.lit(None).cast(kind)

    def step(held: Column, d: Column) -> Column:
        fresh = F.when(~d["first"]["signature"].eqNullSafe(held["sig"]), d["first"]).otherwise(d["other"])
        now = F.when(held["day"].eqNullSafe(d["day"]), none).otherwise(fresh)
        return F.struct(F.coalesce(now["signature"], held["sig"]).alias("sig"), F.when(now.isNotNull(), d["day"]).otherwise(held["day"]).alias("day"), F.concat(held["sent"], F.filter(F.array(now), lambda x: x.isNotNull())).alias("sent"))

    start = F.struct(F.col("x_sig").alias("sig"), F.col("x_day").alias("day"), F.array().cast(f"array<{kind}>").alias("sent"))
    folded = begun.select("user_id", F.aggregate("days", start, step, lambda held: held["sent"]).alias("sent"))
    return folded.select("user_id", F.explode("sent").alias("s")).select("user_id", "s.*")


def stamps(sent: DataFrame, users: DataFrame) -> DataFrame:
    """``users`` (id, last_sig, last_push_at) as the messages ``sent`` leave them."""
    last = sent.groupBy("user_id").agg(F.max(F.struct("at", "signature")).alias("x_last"))
    joined = users.join(last, F.col("id") == F.col("user_id"), "left").drop("user_id")
    stamped = {"last_sig": F.coalesce("x_last.signature", "last_sig"), "last_push_at": F.coalesce(F.col("x_last.at").cast(users.schema["last_push_at"].dataType), "last_push_at")}
    return joined.withColumns(stamped).drop("x_last")
