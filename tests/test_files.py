"""Queries through written files, at sizes where Spark aggregates in another way."""

from pyspark.sql import functions as F

from feedloom.plans.files import curated_read


def test_curated_rows_keep_their_order_in_many_files(spark, tmp_path):
    """One task makes more than 128 files, where Spark aggregates on by sorting: each id's last row still counts."""
    parts = spark.range(40_000).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("n").alias("p_name"), F.lit(7).alias("p_size"))
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert curated_read(spark, str(tmp_path)).groupBy("price").count().collect() == [(7, 40_000)]
