"""Versions with a fallback, and merges bucket by bucket."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators.requests import apply_updates
from feedloom.sources import snapshots
from feedloom.sources.tables import read_or_empty

SCHEMA = "id string, price int"


def rows(spark, n, price=1):
    return spark.range(n).select(F.concat(F.lit("p"), "id").alias("id"), F.lit(price).alias("price"))


def held(spark, root):
    return {(r.id, r.price) for r in snapshots.read_published(spark, root, SCHEMA).collect()}


def files(folder):
    return sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_versions_and_fallback(spark, tmp_path):
    root = str(tmp_path / "catalog")
    assert held(spark, root) == set()
    assert snapshots.publish(rows(spark, 30), root) == "v00000001"
    assert snapshots.publish(rows(spark, 30, 2), root) == "v00000002" and {p for _, p in held(spark, root)} == {2}
    assert snapshots.publish(rows(spark, 19, 3), root) is None and {p for _, p in held(spark, root)} == {2}  # the gate is closed
    # A run that broke off before its manifest.
    rows(spark, 30, 4).write.parquet(f"{root}/versions/v00000003")
    assert {p for _, p in held(spark, root)} == {2}
    assert snapshots.publish(rows(spark, 30, 5), root) == "v00000004" and {p for _, p in held(spark, root)} == {5}
    # A file cut off, then one lost, then a manifest that is no JSON.
    path = files(f"{root}/versions/v00000004")[0]
    with open(path, "r+b") as f:
        f.truncate(os.path.getsize(path) // 2)
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    assert {p for _, p in held(spark, root)} == {2}
    os.remove(files(f"{root}/versions/v00000002")[-1])
    assert {p for _, p in held(spark, root)} == {1}
    with open(f"{root}/manifests/v00000009.json", "w") as f:
        f.write("{torn")
    assert {p for _, p in held(spark, root)} == {1}
    # The next version comes after all of them; old ones go.
    assert snapshots.publish(rows(spark, 40, 6), root, keep=2) == "v00000010" and len(held(spark, root)) == 40
    assert snapshots._names(spark, f"{root}/versions") == ["v00000003", "v00000004", "v00000010"]


def test_unreadable_snapshot_is_empty(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    assert read_or_empty(spark, path, SCHEMA).count() == 0
    rows(spark, 5).write.parquet(path)
    assert read_or_empty(spark, path, SCHEMA).count() == 5
    with open(f"{path}/part-junk.snappy.parquet", "w") as f:
        f.write("this is no Parquet file at all")
    assert read_or_empty(spark, path, SCHEMA).count() == 0


def test_merge_touches_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "state")
    state = spark.range(500).selectExpr("id", "'pending' AS status", "CAST(NULL AS STRING) AS reason", "id % 7 AS other")
    snapshots.write_state(state, path, buckets=16)
    before = {f: os.stat(f).st_mtime_ns for f in files(path)}
    updates = spark.createDataFrame([(3, "rejected", "small"), (77, "awaiting_review", None), (900, "added", None)], "id long, status string, reason string")
    touched = snapshots.merge_state(spark, path, updates, buckets=16)
    after = {f: os.stat(f).st_mtime_ns for f in files(path)}
    of = lambda f: int(f.split("bucket=")[1].split("/")[0])
    assert 1 <= len(touched) <= 2 and {of(f) for f in after} == {of(f) for f in before}
    assert {f: t for f, t in before.items() if of(f) not in touched} == {f: t for f, t in after.items() if of(f) not in touched}
    assert not {f for f in before if of(f) in touched} & set(after)
    got = snapshots.read_state(spark, path)
    assert sorted(map(tuple, got.select(*state.columns).collect()), key=repr) == sorted(map(tuple, apply_updates(state, updates).collect()), key=repr)
    assert snapshots.merge_state(spark, path, updates.where("id = 900"), buckets=16) == [] and snapshots.merge_state(spark, path, updates.limit(0), buckets=16) == []
    with pytest.raises(ValueError):
        snapshots.merge_state(spark, path, updates.union(updates), buckets=16)
