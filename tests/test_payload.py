"""Search on int8 vectors with a bound, against exact cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions import vectors
from feedloom.operators import neighbours, payload


def frame_of(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<float>")


def brute(vectors, k):
    v = np.asarray(vectors, np.float32).astype(float)
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    c = np.round(v @ v.T, 9)
    out = []
    for i in range(len(v)):
        others = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-c[i, j], j))[:k]
        out += [(i, r + 1, j) for r, j in enumerate(others)]
    return sorted(out)


@pytest.mark.parametrize("dim, n", [(8, 150), (1100, 40)])
def test_equals_exact_search(spark, monkeypatch, dim, n):
    """Several blocks and groups of queries; copies and zero vectors among them."""
    monkeypatch.setattr(payload, "BLOCK", 16)
    monkeypatch.setattr(payload, "QUERIES_TOGETHER", 48)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(n, dim))
    vectors[10:14] = vectors[9]
    vectors[20] = 0
    vectors[30] = vectors[31] * 3
    frame = frame_of(spark, vectors)
    rows = payload.published(frame)
    got = payload.k_nearest_published(rows, frame, None, 4).collect()
    assert sorted((r.query_id, r["rank"], r.neighbour_id) for r in got) == brute(vectors, 4)
    some = payload.k_nearest_published(rows, frame, rows.where("id % 7 = 0"), 4).collect()
    assert sorted((r.query_id, r["rank"], r.neighbour_id) for r in some) == [x for x in brute(vectors, 4) if x[0] % 7 == 0]
    left = [tuple(r) for r in payload.candidates(rows, rows, 4).collect()]
    assert len(set(left)) == len(left) and set(left) >= {(q, j) for q, _, j in brute(vectors, 4)}
    # Where all pairs lie close together in many dimensions, the bound leaves most of them.
    assert dim > 100 or len(left) < n * n / 3


def test_bound_holds(spark):
    """What rounding loses is never more than ``rest`` says."""
    rng = np.random.default_rng(6)
    frame = frame_of(spark, rng.normal(size=(50, 30)))
    rows = payload.published(frame).withColumn("q", F.unbase64("payload")).collect()
    v = {r.id: np.array(r.vec) / np.linalg.norm(np.array(r.vec)) for r in frame.collect()}
    q = {r.id: np.frombuffer(bytes(r.q), np.int8) / 127 for r in rows}
    rest = {r.id: r.rest for r in rows}
    for a in v:
        assert abs(np.linalg.norm(v[a] - q[a]) - rest[a]) < 1e-12 and rest[a] <= 0.51 / 127 * 30**0.5
        for b in v:
            bound = rest[a] * np.linalg.norm(q[b]) + np.linalg.norm(q[a]) * rest[b] + rest[a] * rest[b]
            assert abs(v[a] @ v[b] - q[a] @ q[b]) <= bound + 1e-12


def test_few_rows(spark):
    frame = frame_of(spark, [[1, 0], [0, 1], [1, 1]])
    got = payload.k_nearest_published(payload.published(frame), frame, None, 5).collect()
    assert sorted((r.query_id, r["rank"], r.neighbour_id) for r in got) == [(0, 1, 2), (0, 2, 1), (1, 1, 2), (1, 2, 0), (2, 1, 0), (2, 2, 1)]
    odd = frame.union(spark.createDataFrame([(9, None), (8, [])], frame.schema))
    assert payload.published(odd).count() == 3
    assert payload.k_nearest_published(payload.published(frame.limit(0)), frame.limit(0)).count() == 0
    assert payload.k_nearest_published(payload.published(frame.limit(1)), frame.limit(1)).count() == 0


def test_same_as_blocks_of_doubles(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = {tuple(r) for r in neighbours.k_nearest(items, items, 3, "vec_id", "embedding").select("query_id", "rank", "neighbour_id").collect()}
    rows = payload.published(items, "vec_id", "embedding")
    assert {tuple(r)[:3] for r in payload.k_nearest_published(rows, items, None, 3, "vec_id", "embedding").collect()} == want
    assert payload.candidates(rows, rows, 3).count() < 0.05 * items.count() ** 2


def test_pairs_do_not_travel(spark, monkeypatch):
    """Of very many copies of one vector every pair is a candidate; a query still gives no more than its k nearest, and its number."""
    monkeypatch.setattr(payload, "BLOCK", 64)
    monkeypatch.setattr(payload, "QUERIES_TOGETHER", 128)
    monkeypatch.setattr(payload, "_EXACT", 256)
    rng = np.random.default_rng(7)
    vectors = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 300, axis=0), rng.normal(size=(60, 8))])
    frame = frame_of(spark, vectors)
    rows = payload.published(frame)
    normal = frame.select("id", F.transform("vec", lambda x: x.cast("double")).alias("v"))
    found = payload._searched(rows.join(normal, "id"), rows.join(normal, "id"), 3, "nearest")
    assert found.count() == 3 * len(vectors)
    got = payload.k_nearest_published(rows, frame, None, 3).collect()
    assert sorted((r.query_id, r["rank"], r.neighbour_id) for r in got) == brute(vectors, 3)
    of = {r.query_id: r["count"] for r in payload.candidates(rows, rows, 3).groupBy("query_id").count().collect()}
    assert {r.query_id: r.n_left for r in payload.n_candidates(rows, rows, 3).collect()} == of and of[0] >= 299


def test_few_blocks_are_many_tasks(spark, monkeypatch):
    """Queries that one task could hold still go to as many as the cores can do."""
    monkeypatch.setattr(payload, "BLOCK", 32)
    rng = np.random.default_rng(8)
    frame = frame_of(spark, rng.normal(size=(256, 8)))
    rows = payload.published(frame)
    assert payload.candidates(rows, rows, 3).select(F.spark_partition_id()).distinct().count() >= 4


def test_length_is_made_once(spark):
    """Not once for each component, which takes the square of the dimension."""
    plan = spark.range(1).select(vectors.l2_normalize(F.array(F.lit(3.0), F.lit(4.0))).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(") == 1


@pytest.mark.parametrize("k", [3, 500])
def test_counts_as_bounds_in_doubles(spark, monkeypatch, k):
    """Single precision decides no pair that lies close to its bar: many are equal to it here; with few items all are left."""
    monkeypatch.setattr(payload, "BLOCK", 64)
    rng = np.random.default_rng(9)
    near = rng.normal(size=(1, 16)) + 0.02 * rng.normal(size=(120, 16))
    some = np.concatenate([np.repeat(np.eye(16)[:2], 40, axis=0), np.zeros((3, 16)), near, rng.normal(size=(90, 16))])
    frame = frame_of(spark, some)
    rows = payload.published(frame)
    held = rows.select("id", F.unbase64("payload").alias("q"), "rest").orderBy("id").collect()
    q, rest = np.array([np.frombuffer(bytes(r.q), np.int8) for r in held]).astype(float), np.array([r.rest for r in held])
    length = np.sqrt((q**2).sum(axis=1)) / 127
    product, error = q @ q.T / 127**2, rest[:, None] * length + length[:, None] * rest + rest[:, None] * rest
    low, high = product - error, product + error
    np.fill_diagonal(low, -np.inf), np.fill_diagonal(high, -np.inf)
    floor = np.sort(low, axis=1)[:, -k] if k < len(some) else np.full(len(some), -1e9)
    want = {i: int(n) for i, n in enumerate((high >= floor[:, None] - payload._SLACK).sum(axis=1))}
    assert {r.query_id: r.n_left for r in payload.n_candidates(rows, rows, k).collect()} == want
    pairs = payload.candidates(rows, rows, k)
    assert pairs.distinct().count() == pairs.count() == sum(want.values())


def test_single_and_double_precision(spark):
    """Vectors in floats, as they are, and in doubles give the same, whatever their length."""
    rng = np.random.default_rng(10)
    frame = frame_of(spark, rng.normal(size=(80, 8)) * rng.uniform(0.1, 50, size=(80, 1)))
    doubles = frame.withColumn("vec", F.col("vec").cast("array<double>"))
    found = [payload.k_nearest_published(payload.published(f), f, None, 4).withColumn("cosine", F.round("cosine", 9)).orderBy("query_id", "rank").collect() for f in (frame, doubles)]
    assert found[0] == found[1] and len(found[0]) == 320
