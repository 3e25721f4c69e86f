"""Queries over a run of days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import history
from ..sources.tables import table
from .queries import query

#: Users stand for things, three to a brand; a purchase is a sighting.
THINGS = 3


def _sightings(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "events").withColumn("at", F.to_date("ts"))
    return rows.where("event_type = 'purchase'").select(F.col("user_id").alias("id"), F.floor(F.col("user_id") / THINGS).alias("brand"), "at"), rows.select("at").distinct()


@query(
    f"""
WITH e AS (SELECT user_id AS id, user_id // {THINGS} AS brand, ts::DATE AS t, event_type FROM events),
s AS (SELECT DISTINCT id, brand, t FROM e WHERE event_type = 'purchase'),
r AS (SELECT t, row_number() OVER (ORDER BY t) AS k FROM (SELECT DISTINCT t FROM e)),
held AS (
  SELECT i.id, r.t, r.k, (SELECT max(s.t) FROM s WHERE s.id = i.id AND s.t <= r.t) AS seen FROM (SELECT DISTINCT id FROM s) i, r
), there AS (
  SELECT h.* FROM held h WHERE seen IS NOT NULL AND t - seen <= {rules.GRACE_DAYS} AND NOT EXISTS (SELECT 1 FROM s WHERE s.brand = h.id // {THINGS} AND s.t > h.seen AND s.t <= h.t)
), spans AS (SELECT *, k - row_number() OVER (PARTITION BY id ORDER BY k) AS span FROM there)
SELECT id, id // {THINGS} AS brand, min(t) AS added_at, max(seen) AS last_seen_at, max(t) AS until, count(DISTINCT seen) AS n_seen FROM spans GROUP BY id, span"""
)
def presence(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of presence over all days."""
    seen, runs = _sightings(spark, folder)
    return history.presence(seen, runs)


@query(
    f"""
WITH e AS (SELECT user_id AS id, user_id // {THINGS} AS brand, ts::DATE AS t, event_type FROM events),
s AS (SELECT DISTINCT id, brand, t FROM e WHERE event_type = 'purchase'), r AS (SELECT DISTINCT t FROM e),
held AS (SELECT i.id, r.t, (SELECT max(s.t) FROM s WHERE s.id = i.id AND s.t <= r.t) AS seen FROM (SELECT DISTINCT id FROM s) i, r)
SELECT t AS "at", count(*) AS n, count(*) FILTER (seen = t) AS n_live, count(*) FILTER (seen < t) AS n_carried FROM held h
WHERE seen IS NOT NULL AND t - seen <= {rules.GRACE_DAYS} AND NOT EXISTS (SELECT 1 FROM s WHERE s.brand = h.id // {THINGS} AND s.t > h.seen AND s.t <= h.t) GROUP BY t"""
)
def catalog_days(spark: SparkSession, folder: str) -> DataFrame:
    """How many things each day's catalog had, and how many of them it only carried, from the spans."""
    seen, runs = _sightings(spark, folder)
    spans = history.presence(seen, runs)
    days = spans.select(F.explode(F.sequence("added_at", "until", F.expr("INTERVAL 1 DAY"))).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    live = seen.distinct().groupBy("at").agg(F.count(F.lit(1)).alias("n_live"))
    return days.join(runs, "at").join(live, "at", "left").select("at", "n", F.coalesce("n_live", F.lit(0)).alias("n_live"), (F.col("n") - F.coalesce("n_live", F.lit(0))).alias("n_carried"))


_SQL_SENT = """
WITH RECURSIVE s AS (
  SELECT user_id, ts AS t, event_type || ':' || floor(value / 25)::INT AS signature, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type || ':' || floor(value / 25)::INT) AS k FROM events
), f AS (
  SELECT user_id, 0 AS k, NULL::TIMESTAMP AS sent_at, 'purchase:0' AS last_sig, TIMESTAMP '2024-01-01 00:00:00' + to_days((user_id % 4)::INT) AS last_at, false AS sent FROM (SELECT DISTINCT user_id FROM s)
  UNION ALL SELECT f.user_id, s.k, s.t, CASE WHEN go THEN s.signature ELSE f.last_sig END, CASE WHEN go THEN s.t ELSE f.last_at END, go
  FROM f JOIN s ON s.user_id = f.user_id AND s.k = f.k + 1, LATERAL (SELECT s.t::DATE <> f.last_at::DATE AND s.signature <> f.last_sig AS go)
)"""


def _states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "events")
    signature = F.concat("event_type", F.lit(":"), F.floor(F.col("value") / 25).cast("string"))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 4).cast("int"))
    users = rows.select(F.col("user_id").alias("id")).distinct().withColumns({"last_sig": F.lit("purchase:0"), "last_push_at": stamp})
    return rows.select("user_id", F.col("ts").alias("at"), signature.alias("signature")), users


@query(_SQL_SENT + ' SELECT user_id, sent_at AS "at", last_sig AS signature FROM f WHERE sent')
def digests_sent(spark: SparkSession, folder: str) -> DataFrame:
    """Every message of a run of days, each decided by the last one sent."""
    return history.sends(*_states(spark, folder))


@query(_SQL_SENT + " SELECT user_id AS id, arg_max(last_sig, k) AS last_sig, arg_max(last_at, k) AS last_push_at FROM f GROUP BY user_id")
def digest_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """M7: what the messages of these days leave stamped."""
    states, users = _states(spark, folder)
    return history.stamps(history.sends(states, users), users)
