"""Exact deduplication by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Groups into which the rows of one text are salted before they are combined.
SALTS = 32
#: A group of more than this part of all rows is hot; there are fewer than 1 / HOT_PART of them.
HOT_PART = 0.001

#: Above any row number of monotonically_increasing_id.
_STEP = 2**62


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every row of ``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_digest``.

    Texts are equal when their characters are. Rows are combined three times,
    each time by digest *and* whole text: inside each input partition (Spark's
    partial aggregate), over salted digest groups, and over the salts. A group
    never meets in one task before it is one row per salt.

    ``keep_id`` is the largest key of the group; the row that has it is ``kept``.
    ``key`` is an integer column. Defined results: a null text counts as empty;
    a null key loses to any other; of rows repeated with the same key and text,
    exactly one is kept; an empty table gives an empty result. Input columns
    named like a result column are replaced by it. ``df`` must give the same
    rows in the same order when it is read again, as a table does.
    """
    own = {"keep_id", "group_size", "kept", "text_digest"}
    names = [c for c in df.columns if c.lower() not in own]
    rid = F.monotonically_increasing_id()
    rows = df.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(2**63)).cast("long")).alias("x_key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("x_text"),
        rid.alias("x_rid"),
    )
    # Largest key, then largest row number, as one number: a decimal can be
    # kept in the hash aggregate's buffer, a struct can't.
    rows = rows.withColumn("x_win", (F.col("x_key").cast("decimal(19,0)") * F.lit(_STEP).cast("decimal(19,0)") + F.col("x_rid").cast("decimal(19,0)")).cast("decimal(38,0)"))
    rows = rows.withColumn("x_digest", digest(F.col("x_text")))

    salted = (
        rows.select("x_key", "x_win", "x_digest", "x_text", (F.spark_partition_id() % SALTS).alias("x_salt"))
        .groupBy("x_digest", "x_salt", "x_text")
        .agg(F.max("x_key").alias("x_key"), F.max("x_win").alias("x_win"), F.count(F.lit(1)).alias("x_n"))
    )
    winners = salted.groupBy("x_digest", "x_text").agg(F.max("x_key").alias("w_key"), F.max("x_win").alias("w_win"), F.sum("x_n").alias("w_n"))

    found = written(winners.drop("x_text"), "exact-winners")
    # A digest that two different texts share (not seen with SHA-256) sends the
    # whole join back through the texts themselves.
    clash = found.groupBy("x_digest").count().where("count > 1").limit(1).count() > 0
    by = ["x_digest", "x_text"] if clash else ["x_digest"]
    if clash:
        found = written(winners, "exact-winners-text")

    # Hot groups: a bounded number, so their winners are broadcast. The others
    # are joined by digest, and none of them has more than HOT_PART of the rows.
    total = found.agg(F.sum("w_n")).first()[0] or 0
    hot = found.where(F.col("w_n") > total * HOT_PART).select(*by, *[F.col(c).alias(f"h{c}") for c in ("w_key", "w_win", "w_n")])
    rows = rows.join(F.broadcast(hot), by, "left")
    rows = rows.withColumn("x_by", F.when(F.col("hw_n").isNull(), F.col("x_digest")).otherwise(F.concat(F.lit("hot "), F.col("x_rid"))))
    rest = found.where(F.col("w_n") <= total * HOT_PART).select(F.col("x_digest").alias("x_by"), *by[1:], "w_key", "w_win", "w_n")
    rows = rows.join(rest.hint("merge"), ["x_by", *by[1:]], "left")

    best = F.coalesce("hw_key", "w_key")
    return rows.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.when(best != F.lit(-(2**63)).cast("long"), best).alias("keep_id"),
        F.coalesce("hw_n", "w_n").alias("group_size"),
        (F.col("x_win") == F.coalesce("hw_win", "w_win")).alias("kept"),
        F.col("x_digest").alias("text_digest"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLES = {"op5_exact_dedup": ORACLE}
