"""Queries through the engine's small files: configurations, hand-offs, users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import announce
from ..sources import tables
from ..sources.tables import publish_folder, table
from .queries import AS_OF, _new_brands, as_of, query


def _file(df: DataFrame) -> str:
    """One line, in a file of its own: what a configuration or a hand-off is."""
    path = publish_folder(df.sparkSession)
    df.coalesce(1).write.text(path)
    return path


def _domain(name: str) -> Column:
    return F.concat(F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", "")), F.lit(".com"))


def _config(spark: SparkSession, folder: str) -> str:
    key = F.col("n_nationkey")
    store = F.struct(key, F.struct(F.col("n_name").alias("brand"), _domain("n_name").alias("domain"), F.when(key % 3 > 0, F.when(key % 3 == 1, "EUR").otherwise("GBP")).alias("currency"), F.when(key % 5 == 0, F.lit(True)).alias("multiBrand")).alias("s"))
    listed = F.transform(F.array_sort(F.collect_list(store)), lambda x: x["s"])
    rows = table(spark, folder, "nation").agg(listed.alias("brands"))
    rates = F.create_map(F.lit("EUR"), F.lit(1.08), F.lit("GBP"), F.lit(1.27))
    return _file(rows.select(F.to_json(F.struct(rates.alias("fx_to_usd"), F.lit(60).alias("perBrand"), "brands")).alias("value")))


_SQL_DOMAIN = "lower(regexp_replace({}, '[^A-Za-z0-9]', '', 'g')) || '.com'"


@query(
    f"""WITH s AS (SELECT n_name AS brand, {_SQL_DOMAIN.format("n_name")} AS domain, ['USD', 'EUR', 'GBP'][n_nationkey % 3 + 1] AS currency, n_nationkey AS o FROM nation
UNION ALL SELECT s_name, CASE WHEN s_suppkey % 5 = 0 THEN upper({_SQL_DOMAIN.format("n_name")}) ELSE {_SQL_DOMAIN.format("s_name")} END, 'USD', NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT brand, domain, currency FROM s QUALIFY row_number() OVER (PARTITION BY lower(domain) ORDER BY o NULLS LAST, domain) = 1"""
)
def stores_written(spark: SparkSession, folder: str) -> DataFrame:
    """A configuration's stores with new ones behind them, one a domain, written and read."""
    stores, _, _ = tables.read_stores(spark, _config(spark, folder))
    near = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.upper(_domain("n_name")).alias("there"))
    added = table(spark, folder, "supplier").join(near, "s_nationkey").select(F.col("s_name").alias("brand"), F.when(F.col("s_suppkey") % 5 == 0, F.col("there")).otherwise(_domain("s_name")).alias("domain"), F.lit("USD").alias("currency"))
    path = publish_folder(spark)
    tables.write_stores(stores, added, path)
    return spark.read.schema("brand string, domain string, currency string").json(path)


@query("SELECT p_partkey::VARCHAR AS id, p_brand AS brand, p_name AS name, p_size::INT AS price, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_days(p_size::INT), '%Y-%m-%dT%H:%M:%SZ') AS added_at FROM part")
def curated_read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a file of products, one with each id twice, and one without."""
    from ..functions import times

    stamp = F.concat(F.date_format(F.lit("2024-01-01").cast("date") + F.col("p_size").cast("int"), "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    row = lambda price, item: F.struct(item.alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), price.alias("price"), stamp.alias("addedAt"))
    item, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("int")
    rows = table(spark, folder, "part").select(F.floor(F.col("p_partkey") / 250).alias("file"), F.col("p_partkey").alias("at"), F.posexplode(F.array(row(F.lit(1), item), row(size, item), row(size, F.lit(None).cast("string")))).alias("pos", "p"))
    path = publish_folder(spark)
    # A file for each 250 parts: a file of products is read whole. The last row of an id counts, so that their order is given.
    listed = F.array_sort(F.collect_list(F.struct("at", "pos", "p")))
    parts = rows.groupBy("file").agg(F.transform(listed, lambda x: x["p"]).alias("products"))
    parts.select(F.to_json(F.struct("products")).alias("value")).repartition(8).write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_curated(spark, path).select("id", "brand", "name", "price", times.iso(F.col("added_at")).alias("added_at"))


@query(f"""SELECT c_custkey AS id, 'ExponentPushToken[' || c_custkey || ']' AS token, c_mktsegment AS last_sig, TIMESTAMP '{AS_OF}' AS last_push_at FROM customer WHERE c_custkey % 4 > 1""")
def push_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users with a token; and none where the columns aren't there yet."""
    key = F.col("c_custkey")
    token = F.when(key % 4 > 1, F.concat(F.lit("ExponentPushToken["), key, F.lit("]"))).when(key % 4 == 1, "")
    profiles = table(spark, folder, "customer").select(key.alias("id"), token.alias("push_token"), F.col("c_mktsegment").alias("last_marketing_push_sig"), as_of().alias("last_marketing_push_at"), as_of().alias("updated_at"))
    none = tables.push_users(profiles.drop("last_marketing_push_at")).select(F.col("id").cast("long"), "token", "last_sig", F.col("last_push_at").cast("timestamp_ntz"))
    return tables.push_users(profiles).select("id", "token", "last_sig", "last_push_at").unionByName(none)


@query(f"SELECT min(p_partkey) AS id, TIMESTAMP '{AS_OF}' AS notified_at FROM part GROUP BY p_brand")
def notified_updates(spark: SparkSession, folder: str) -> DataFrame:
    """M6: the stamp of every announced request."""
    return announce.notified_updates(_new_brands(spark, folder), as_of())


@query(f"SELECT strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%dT%H:%M:%SZ') AS generated_at, p_brand AS brand, min(p_partkey) % 97 + 1 AS user_id, min(p_partkey) AS request_id FROM part GROUP BY p_brand")
def new_brands_file(spark: SparkSession, folder: str) -> DataFrame:
    """K5: the hand-off of new brands, written and read."""
    path = publish_folder(spark)
    tables.write_new_brands(_new_brands(spark, folder), as_of(), path)
    held = spark.read.schema("generatedAt string, brands array<struct<brand: string, user_id: bigint, request_id: bigint>>").json(path)
    return held.select(F.col("generatedAt").alias("generated_at"), F.explode("brands").alias("b")).select("generated_at", "b.*")
