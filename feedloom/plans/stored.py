"""Queries through tables that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import announce
from ..sources import push_sink, snapshots
from ..sources.tables import publish_folder, table
from .queries import ORACLES, _follows, _new_brands, _profiles, query


@query("SELECT p_partkey::VARCHAR AS id, p_name AS name, p_size AS price FROM part")
def published_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions published, a third one held back by the gate, and the last one read again."""
    schema, root = "id string, name string, price int", publish_folder(spark)
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), "p_size", "p_retailprice")
    snapshots.publish(parts.select("id", "name", F.rint("p_retailprice").cast("int").alias("price")), root)
    snapshots.publish(parts.select("id", "name", F.col("p_size").cast("int").alias("price")), root)
    few = table(spark, folder, "region").select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"), F.lit(1).alias("price"))
    if snapshots.publish(few, root) is not None:
        raise AssertionError("the gate let a version of few rows through")
    return snapshots.read_published(spark, root, schema)


@query(
    """SELECT o_orderkey AS id, CASE WHEN u.id IS NULL THEN o_orderstatus ELSE 'S' END AS status, u.shipped FROM orders
LEFT JOIN (SELECT l_orderkey AS id, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey HAVING count_if(l_linestatus = 'O') = 0) u ON u.id = o_orderkey"""
)
def merged_state(spark: SparkSession, folder: str) -> DataFrame:
    """K3: a table of state, patched bucket by bucket."""
    items = table(spark, folder, "lineitem")
    date = items.schema["l_shipdate"].dataType
    state = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.lit(None).cast(date).alias("shipped"))
    done = items.groupBy(F.col("l_orderkey").alias("id")).agg(F.count_if(F.col("l_linestatus") == "O").alias("open"), F.max("l_shipdate").alias("shipped")).where("open = 0")
    path = publish_folder(spark)
    snapshots.write_state(state, path)
    snapshots.merge_state(spark, path, done.select("id", F.lit("S").alias("status"), "shipped"))
    return snapshots.read_state(spark, path).select("id", "status", "shipped")


@query(
    f"""WITH m AS ({ORACLES["announce_messages"]}), b AS (SELECT (row_number() OVER (ORDER BY brand || '|' || user_id) - 1) // 100 AS batch_no FROM m)
SELECT batch_no, count(*) AS n, true AS ok FROM b GROUP BY batch_no"""
)
def push_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """K6: announcements sent in batches (to a sender that only looks at them), and what became of each batch."""
    people = announce.recipients(_new_brands(spark, folder), _follows(spark, folder))
    rows = announce.messages(people, _profiles(spark, folder)).withColumn("key", F.concat("brand", F.lit("|"), F.col("user_id").cast("string")))
    _, outcomes = push_sink.send_batches(rows, "key", "feedloom.sources.push_sink:dry_run", "announcements")
    return outcomes.select("batch_no", "n", "ok")
