"""Snapshots on disk: versions with a fallback, and state that is changed bucket by bucket."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from .tables import CATALOG, materialize

#: Versions that stay readable.
VERSIONS_KEPT = 3
BUCKETS = 64
BUCKET = "bucket"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = _files(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def _manifests(spark: SparkSession, root: str) -> list[dict]:
    """The manifests that can be read, latest first."""
    out = []
    for name in reversed(_names(spark, f"{root}/manifests")):
        text = spark.read.text(f"{root}/manifests/{name}", wholetext=True).first()
        try:
            manifest = json.loads(text[0]) if text else None
        except ValueError:
            continue
        if isinstance(manifest, dict) and {"version", "n"} <= set(manifest):
            out.append(manifest)
    return out


def publish(df: DataFrame, root: str, least: int = rules.MIN_PUBLISHED, keep: int = VERSIONS_KEPT) -> str | None:
    """Writes ``df`` as the next version of the catalog under ``root``, and says which; None if it has fewer than ``least`` rows.

    A version is a folder of its own, and counts once its manifest, a small file
    that is written last and never again, is there. A run that breaks off leaves
    at most a folder that no manifest names. Versions before the last ``keep`` go.
    Two runs at once end with one error and one version.
    """
    spark, held = df.sparkSession, materialize(df)
    n = held.count()
    if n < least:
        return None
    last = max([int(v[1:]) for v in _names(spark, f"{root}/versions")] + [int(v.split(".")[0][1:]) for v in _names(spark, f"{root}/manifests")], default=0)
    version = f"v{last + 1:08d}"
    held.write.mode("errorifexists").parquet(f"{root}/versions/{version}")
    path, files = _files(spark, f"{root}/manifests/{version}.json")
    out = files.create(path, False)
    out.write(bytearray(json.dumps({"version": version, "n": n}).encode()))
    out.close()
    for old in _manifests(spark, root)[keep:]:
        for name in (f"manifests/{old['version']}.json", f"versions/{old['version']}"):
            path, files = _files(spark, f"{root}/{name}")
            files.delete(path, True)
    return version


def _unreadable(error: Exception) -> bool:
    """Whether reading failed for the files: not there, cut off, or no Parquet."""
    told = str(error)
    return any(sign in told for sign in ("PATH_NOT_FOUND", "does not exist", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "FileNotFoundException", "UNABLE_TO_INFER_SCHEMA"))


def readable(spark: SparkSession, path: str, schema: str | T.StructType = CATALOG) -> DataFrame | None:
    """A snapshot in Parquet, or None if any of its files can't be read (every file's footer is)."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.count()
        return found
    except Exception as e:
        if _unreadable(e):
            return None
        raise


def read_published(spark: SparkSession, root: str, schema: str | T.StructType = CATALOG) -> DataFrame:
    """The last version that is whole: readable, with as many rows as its manifest says; no rows if there is none."""
    for manifest in _manifests(spark, root):
        found = readable(spark, f"{root}/versions/{manifest['version']}", schema)
        if found is not None and found.count() == manifest["n"]:
            return found
    return spark.createDataFrame([], schema)


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def write_state(df: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """A table of state in Parquet, in folders by a hash of its key; a bucket has as many files as its size asks for."""
    df.withColumn(BUCKET, _bucket(key, buckets)).hint("rebalance", BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def merge_state(spark: SparkSession, path: str, updates: DataFrame, key: str = "id", buckets: int = BUCKETS) -> list[int]:
    """Puts ``updates`` (key, changed columns), one row a key, into a table made by ``write_state``; the buckets that were written.

    The result is that of ``apply_updates`` on the whole table. Only the buckets
    that hold a key of the updates are read and written; the files of all others
    stay as they are. Keys that the table lacks change nothing (as a patch by
    key does), and two updates of one key are an error. ``buckets`` is what the table was written with.
    """
    from ..operators.requests import apply_updates

    held = materialize(updates.where(F.col(f"`{key}`").isNotNull()).withColumn(BUCKET, _bucket(key, buckets)))
    if held.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"updates have a {key} more than once")
    state = spark.read.parquet(path)
    touched = [r[0] for r in held.select(BUCKET, key).join(state.select(BUCKET, key), [BUCKET, key], "left_semi").select(BUCKET).distinct().collect()]
    if not touched:
        return []
    # Written before the table is: what is read isn't what is overwritten.
    changed = materialize(apply_updates(state.where(F.col(BUCKET).isin(touched)), held.drop(BUCKET), key))
    changed.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return sorted(touched)
