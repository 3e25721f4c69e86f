"""Queries by rules that are rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import ruled
from ..sources.tables import table
from .queries import query, sql_category, sql_colors, sql_junk

_SQL_KEPT = f"array_to_string(CASE WHEN len(shown) > 0 THEN shown WHEN len(behind) > 0 THEN behind ELSE ['{rules.DEFAULT_COLORS[0]}'] END, ',') AS colors"


@query(
    f"""SELECT p_partkey, junk, category, {_SQL_KEPT} FROM (
  SELECT p_partkey, {sql_junk("p_name", "p_retailprice % 40", "p_type")} AS junk, {sql_category("lower(p_type || ' ' || p_name)")} AS category,
    {sql_colors("lower(p_name || ' ' || p_type)")} AS shown, {sql_colors("lower(p_brand || ' ' || p_name)")} AS behind FROM part)"""
)
def ruled_products(spark: SparkSession, folder: str) -> DataFrame:
    """Junk, category and colours of products, by the table of rules."""
    # Few bytes, and much work each: dealt anew, however few files they lie in.
    parts = table(spark, folder, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    options = F.array(F.struct(F.lit("Colour").alias("name"), F.lit(1).alias("position"), F.array("p_name").alias("values")))
    out = ruled.classified(parts, "p_partkey", F.col("p_name"), F.col("p_type"), F.col("p_retailprice") % 40, ruled.built_in(spark), F.array("p_brand"), options)
    return out.select("p_partkey", "junk", "category", F.array_join("color_tags", ",").alias("colors"))


@query(
    f"""SELECT doc_id, junk, category, {_SQL_KEPT} FROM (
  SELECT doc_id, {sql_junk("coalesce(text, '')", "n_chars", "coalesce(source, '')")} AS junk, {sql_category("lower(coalesce(source, '') || ' ' || coalesce(text, ''))")} AS category,
    {sql_colors("lower(coalesce(text, '') || ' ' || coalesce(source, ''))")} AS shown, [] AS behind FROM documents)"""
)
def ruled_texts(spark: SparkSession, folder: str) -> DataFrame:
    """P1 P2 F5 F6 on whole texts, by the same rules."""
    docs = table(spark, folder, "documents")
    out = ruled.classified(docs, "doc_id", F.col("text"), F.col("source"), F.col("n_chars"), ruled.built_in(spark))
    return out.select("doc_id", "junk", "category", F.array_join("color_tags", ",").alias("colors"))


@query(
    """WITH r AS (SELECT row_number() OVER (ORDER BY item_id) AS rank, lower(regexp_extract(text, '[A-Za-z0-9]+')) AS word FROM benchmark),
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents),
h AS (SELECT doc_id, rank, r.word FROM w JOIN (SELECT word, min(rank) AS rank FROM r WHERE word <> '' GROUP BY word) r ON w.word IN (r.word, r.word || 's', r.word || 'es'))
SELECT doc_id, arg_min(word, rank) AS label FROM h GROUP BY doc_id"""
)
def ruled_first(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that another table gives (the first word of each benchmark item, in their order), the first that a text meets."""
    word = F.lower(F.regexp_extract("text", "[A-Za-z0-9]+", 0))
    made = table(spark, folder, "benchmark").select(word.alias("keyword"), "item_id").where("keyword <> ''").groupBy("keyword").agg(F.min("item_id").alias("item_id"))
    table_ = made.select(F.lit("first").alias("name"), F.lit("text").alias("field"), F.lit("word").alias("mode"), F.col("item_id").cast("int").alias("rank"), F.col("keyword").alias("label"), "keyword")
    hits = ruled.rule_hits(table(spark, folder, "documents"), "doc_id", {"text": F.lower("text")}, table_)
    return ruled.first_labels(hits, "doc_id").select("doc_id", "label")
