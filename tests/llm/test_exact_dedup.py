import hashlib
import random

import pytest
from pyspark.sql import functions as F

from feedloom.llm.exact_dedup import exact_dedup, op5_exact_dedup, sha256

from .cases import awkward, empty


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    keep = {t: max((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    return sorted(((k, t, keep[t or ""], len(groups[t or ""])) for k, t in rows), key=repr)


# A digest of one hex digit makes different texts meet: they must not be merged.
@pytest.mark.parametrize("digest", [sha256, lambda c: F.substring(sha256(c), 1, 1)])
def test_against_brute_force(spark, digest):
    rnd = random.Random(5)
    rows = [(k, rnd.choice(["", None, "a", "b", "A", "a "] + [f"t{i}" for i in range(40)])) for k in range(300)] + [(1000 + k, "hot") for k in range(150)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    frame.write.mode("overwrite").parquet(path := f"/tmp/feedloom-test-{rnd.random()}")
    got = exact_dedup(spark.read.parquet(path), digest=digest).collect()
    assert sorted(((r.doc_id, r.text, r.keep_id, r.group_size) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_awkward_rows(spark):
    got = exact_dedup(awkward(spark)).collect()
    assert len(got) == 12 and set(exact_dedup(awkward(spark)).columns) >= {"doc_id", "text", "source", "keep_id", "kept", "x_text"}
    by_text = {}
    for r in got:
        by_text.setdefault(r.text or "", []).append(r)
    for rows in by_text.values():
        assert sum(r.kept for r in rows) == 1, "of repeated rows exactly one stays"
    assert {r.keep_id for r in by_text[""]} == {4} and len(by_text[""]) == 3
    assert [r.keep_id for r in by_text["a row without an id"]] == [None]
    assert exact_dedup(empty(spark)).count() == 0


def test_query(spark):
    rows = op5_exact_dedup(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts) and all(r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in rows)


def test_native(spark):
    plan = exact_dedup(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
