"""Queries that replay requests from a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import replay
from ..sources.tables import table
from .queries import AS_OF, as_of, query

#: What an event stands for: by its type, one step for small values and one for others.
STEPS = {"signup": ("submit", "approve"), "view": ("review", "email"), "click": ("approve", "remint"), "error": ("reject", "decline"), "purchase": ("add", "notify")}
SMALL = 20


def _log(spark: SparkSession, folder: str) -> DataFrame:
    step = F.lit(None).cast("string")
    for kind, (a, b) in STEPS.items():
        step = F.when(F.col("event_type") == kind, F.when(F.col("value") < SMALL, a).otherwise(b)).otherwise(step)
    return table(spark, folder, "events").select(F.col("user_id").alias("id"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), step.alias("step"))


_SQL_CASES = "CASE event_type " + " ".join(f"WHEN '{k}' THEN CASE WHEN value < {SMALL} THEN '{a}' ELSE '{b}' END" for k, (a, b) in STEPS.items()) + " END"
_SQL_REPLAY = f"""
WITH RECURSIVE t(step, a, b) AS (VALUES {", ".join(str(t) for t in replay.TRANSITIONS)}),
e AS (SELECT user_id AS id, ts, event_id AS seq, {_SQL_CASES} AS step, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f AS (
  SELECT DISTINCT id, 0 AS k, NULL::TIMESTAMP AS ts, NULL::BIGINT AS seq, NULL::VARCHAR AS step, '' AS state_before, false AS legal, '' AS state_after FROM e
  UNION ALL SELECT f.id, e.k, e.ts, e.seq, e.step, f.state_after, t.step IS NOT NULL, coalesce(t.b, f.state_after)
  FROM f JOIN e ON e.id = f.id AND e.k = f.k + 1 LEFT JOIN t ON t.step = e.step AND t.a = f.state_after
)"""


@query(_SQL_REPLAY + " SELECT id, seq, step, state_before, legal, state_after FROM f WHERE k > 0")
def request_replay(spark: SparkSession, folder: str) -> DataFrame:
    """M1 to M6: every step of a log, whether it was legal, and what it did."""
    return replay.replayed(_log(spark, folder)).select("id", "seq", "step", "state_before", "legal", "state_after")


@query(
    _SQL_REPLAY
    + f""" SELECT id, arg_max(state_after, k) AS status, max(ts) FILTER (step IN ('review', 'reject')) AS processed_at, max(ts) FILTER (step = 'email') AS review_emailed_at,
  count(*) FILTER (step = 'remint') AS n_reminted, max(ts) FILTER (step = 'add') AS added_at, max(ts) FILTER (step = 'notify') AS notified_at
FROM f WHERE legal AND ts <= TIMESTAMP '{AS_OF}' GROUP BY id"""
)
def request_states(spark: SparkSession, folder: str) -> DataFrame:
    """M1 to M6: how every request stood at a time in between."""
    return replay.states_at(replay.replayed(_log(spark, folder)), as_of())
