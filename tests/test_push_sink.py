"""Batches that are sent, refused, and tried again."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import announce
from feedloom.sources import push_sink

HERE = "tests.test_push_sink"


def picky(token, rows):
    """Refuses a batch with a message to ``bad``."""
    if any(r["to"] == "bad" for r in rows):
        raise ConnectionError("no such address")


def once_lost(token, rows):
    """Loses the whole task at its first try, after a batch went out."""
    folder = os.environ.get("FEEDLOOM_TEST_SENT") or rows[0]["folder"]
    with open(f"{folder}/log", "a") as f:
        f.write(f"{token}\n")
    if not os.path.exists(f"{folder}/lost"):
        open(f"{folder}/lost", "w").close()
        raise SystemExit("executor lost")


def rows(spark, n, folder=""):
    return spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") == 250, "bad").otherwise(F.concat(F.lit("t"), "id")).alias("to"), F.lit(folder).alias("folder"), (F.col("id") % 3).alias("request_id"))


def test_one_batch_fails(spark, tmp_path):
    path = f"file://{tmp_path}/outcomes"
    numbered, outcomes = push_sink.send_batches(rows(spark, 530), "k", f"{HERE}:picky", "day1", path)
    got = sorted(map(tuple, outcomes.collect()))
    assert [g[:3] for g in got] == [(0, 100, True), (1, 100, True), (2, 100, False), (3, 100, True), (4, 100, True), (5, 30, True)]
    assert got[2][3] == "ConnectionError: no such address"
    assert push_sink.delivered(numbered, outcomes).count() == 430 and not glob.glob(f"{tmp_path}/outcomes/_staged/*")
    assert {tuple(r) for r in push_sink.reached(numbered, outcomes, "request_id").collect()} == {(0, 144, 33), (1, 144, 33), (2, 142, 34)}
    # Every announced request is stamped, also one whose batch failed.
    asked = numbered.select("request_id", F.lit("x").alias("brand")).distinct()
    stamped = announce.notified_updates(asked, F.lit("2024-01-20 12:00:00").cast("timestamp"))
    assert sorted(r.id for r in stamped.collect()) == [0, 1, 2]
    _, more = push_sink.send_batches(rows(spark, 5), "k", f"{HERE}:picky", "day2", path)
    assert [tuple(r) for r in more.collect()] == [(0, 5, True, None)]
    assert push_sink.send_batches(rows(spark, 0), "k", f"{HERE}:picky", "day3", f"{path}0")[0].count() == 0


def test_lost_job_leaves_nothing_and_can_be_repeated(spark, tmp_path):
    path = f"file://{tmp_path}/outcomes"
    frame = rows(spark, 120, str(tmp_path))
    with pytest.raises(Exception):
        push_sink.send_batches(frame, "k", f"{HERE}:once_lost", "day1", path)
    assert not glob.glob(f"{tmp_path}/outcomes/**/*.json", recursive=True)
    _, outcomes = push_sink.send_batches(frame, "k", f"{HERE}:once_lost", "day1", path)
    assert sorted(map(tuple, outcomes.collect())) == [(0, 100, True, None), (1, 20, True, None)]
    tokens = open(tmp_path / "log").read().split()
    assert set(tokens) == {"day1-0", "day1-1"} and len(tokens) > 2


def test_dry_run():
    push_sink.dry_run("t", [{"to": "x", "body": "hello"}])
    for row in ({"to": None}, {"to": "x", "body": "y" * 5000}):
        with pytest.raises(ValueError):
            push_sink.dry_run("t", [row])
