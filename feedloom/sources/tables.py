"""Reading and writing of the engine's tables and files."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.text import blank, brand_keys

RAW_PRODUCT = (
    "store_order int, pos int, id long, title string, handle string, vendor string, product_type string, tags array<string>, "
    "images array<struct<src: string>>, options array<struct<name: string, position: int, values: array<string>>>, "
    "variants array<struct<price: string, available: boolean, option1: string, option2: string, option3: string>>"
)
STORE_CONFIG = "fx_to_usd map<string, double>, perBrand int, brands array<struct<brand: string, domain: string, currency: string, multiBrand: boolean>>"
CATALOG = (
    "id string, brand string, name string, price int, category string, color_tags array<string>, image_url string, "
    "sizes array<string>, images array<string>, affiliate_url string, last_seen_at timestamp, added_at timestamp"
)
_PUBLISHED = (
    "id string, brand string, name string, price int, category string, colorTags array<string>, imageUrl string, "
    "sizes array<string>, images array<string>, affiliateUrl string, lastSeenAt string, addedAt string"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def publish_folder(spark: SparkSession) -> str:
    """A new folder under the one in ``spark.checkpoint.dir``, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_feedloom_dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = spark._feedloom_dir = "file://" + tempfile.mkdtemp(prefix="feedloom-")
    return f"{folder.rstrip('/')}/feedloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Written once to the folder in ``spark.checkpoint.dir``, and read back: a lost executor costs no lineage."""
    spark, path = df.sparkSession, publish_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_stores(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(stores in order, currency rates, products a brand) of a configuration file."""
    config = spark.read.schema(STORE_CONFIG).json(path, multiLine=True)
    stores = config.select(F.posexplode("brands").alias("store_order", "s")).select("store_order", "s.brand", "s.domain", F.coalesce("s.currency", F.lit("USD")).alias("currency"), F.coalesce("s.multiBrand", F.lit(False)).alias("multi_brand"))
    rates = config.select(F.explode("fx_to_usd").alias("currency", "fx"))
    return stores, rates, config.select("perBrand").first()[0]


def read_landed_pages(spark: SparkSession, path: str, stores: DataFrame) -> DataFrame:
    """Raw products of landed storefront pages: JSON lines {domain, page, products: [...]}.

    Whatever fetched them has paged through the stores; here a page is a row.
    """
    product = T.StructType([f for f in T._parse_datatype_string(RAW_PRODUCT).fields if f.name not in ("store_order", "pos")])
    pages = spark.read.schema(T.StructType([T.StructField("domain", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("products", T.ArrayType(product))])).json(path)
    rows = pages.select("domain", "page", F.posexplode("products").alias("i", "p"))
    return rows.join(stores.select("domain", "store_order"), "domain").select("store_order", (F.col("page") * 250 + F.col("i")).alias("pos"), "p.*")


def _catalog_rows(published: DataFrame) -> DataFrame:
    return published.select(
        "id", "brand", "name", "price", "category", F.col("colorTags").alias("color_tags"), F.col("imageUrl").alias("image_url"), "sizes", "images",
        F.col("affiliateUrl").alias("affiliate_url"), F.try_to_timestamp("lastSeenAt").alias("last_seen_at"), F.try_to_timestamp("addedAt").alias("added_at"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A published catalog, {products: [...]} or a bare list; of rows with one id the last counts."""
    from ..operators.snapshots import latest_by_id

    text = spark.read.text(path, wholetext=True)
    rows = f"array<struct<{', '.join(c.replace(' ', ': ', 1) for c in _PUBLISHED.split(', '))}>>"
    bare = F.from_json("value", rows)
    wrapped = F.from_json("value", f"struct<products: {rows}>")["products"]
    listed = text.select(F.posexplode(F.when(F.ltrim("value").startswith("["), bare).otherwise(wrapped)).alias("pos", "p")).select("pos", "p.*")
    return _catalog_rows(latest_by_id(listed))


def read_or_empty(spark: SparkSession, path: str, schema: str = CATALOG) -> DataFrame:
    """A snapshot in Parquet, or no rows where there is none, or a file of it can't be read."""
    from .snapshots import readable

    found = readable(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def templates(spark: SparkSession, text: str) -> DataFrame:
    """(brand_key, template) of a JSON object; what isn't one, and entries without ``{url}``, are passed over."""
    try:
        data = json.loads(text or "{}")
    except ValueError:
        data = {}
    rows = {brand_keys([b])[0]: t for b, t in (data.items() if isinstance(data, Mapping) else ()) if isinstance(t, str) and "{url}" in t}
    return spark.createDataFrame(list(rows.items()), "brand_key string, template string")


def push_users(profiles: DataFrame) -> DataFrame:
    """(id, token, last_sig, last_push_at, active_at) of profiles with a token; none where the columns aren't there yet."""
    needed = ["push_token", "last_marketing_push_sig", "last_marketing_push_at", "updated_at"]
    if not set(needed) <= set(profiles.columns):
        return profiles.sparkSession.createDataFrame([], "id string, token string, last_sig string, last_push_at timestamp, active_at timestamp")
    return profiles.where(blank(F.col("push_token")) != "").select("id", *[F.col(c).alias(n) for c, n in zip(needed, ("token", "last_sig", "last_push_at", "active_at"))])


def artifact_stamps(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha1, bytes) of files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha1("content").alias("sha1"), F.col("length").alias("bytes"))


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated rows of a file {products: [...]}; none where it is missing or isn't JSON."""
    try:
        return read_catalog(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(CATALOG)])
        raise


def write_catalog(df: DataFrame, path: str, least: int = rules.MIN_PUBLISHED) -> bool:
    """The catalog of record, as the next version under ``path`` (see ``snapshots.publish``); with fewer than ``least`` rows nothing is written, and the answer is False."""
    from .snapshots import publish

    return publish(df, path, least) is not None


def write_new_brands(added: DataFrame, as_of: Column, path: str) -> None:
    """The hand-off to whatever announces: one JSON object {generatedAt, brands: [{brand, user_id, request_id}]} of a day's few new stores."""
    from ..functions.times import iso

    listed = F.array_sort(F.collect_list(F.struct("brand", "user_id", "request_id")))
    added.agg(listed.alias("brands")).select(iso(as_of).alias("generatedAt"), "brands").coalesce(1).write.mode("overwrite").json(path)


def export_catalog(df: DataFrame, path: str) -> None:
    """One compact JSON file, in feed order: for a catalog that one reader takes whole."""
    columns = [c for c in ("part", "round", "turn", "pos", "id") if c in df.columns]
    df.orderBy(*columns).coalesce(1).write.mode("overwrite").json(path)


def write_stores(stores: DataFrame, added: DataFrame, path: str) -> None:
    """The configuration's stores with new ones behind them, one a domain."""
    from ..operators.selection import keep_first

    both = stores.unionByName(added.select("brand", "domain", "currency"), allowMissingColumns=True)
    keep_first(both.withColumn("x_d", F.lower(blank(F.col("domain")))), ["x_d"], [F.col("store_order").asc_nulls_last(), "domain"]).drop("x_d").write.mode("overwrite").json(path)


def vector_payload(vector: Column) -> Column:
    """A quantized vector as base64 of its bytes."""
    digits = F.transform(vector, lambda x: F.lpad(F.hex(F.pmod(x.cast("int"), F.lit(256)).cast("long")), 2, "0"))
    return F.replace(F.base64(F.unhex(F.array_join(digits, ""))), F.lit("\r\n"), F.lit(""))
