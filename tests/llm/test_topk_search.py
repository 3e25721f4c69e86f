import numpy as np
import pytest

from feedloom.llm import topk_search
from feedloom.llm.topk_search import Block, op3_topk_search, top_k


def brute(rows, k, every):
    """rows: (id, vector or None), in order."""
    fine = [(i, v, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for a, (q, _, x) in enumerate(fine):
        if q % every == 0:
            scored = sorted((-int(x @ y), v, b) for b, (v, _, y) in enumerate(fine) if b != a and len(x) == len(y))
            out += [(q, r + 1, v, -s) for r, (s, v, _) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["normal", "few values", "positive", "one cluster"])
def test_block(kind):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(size=(300, 8)), "few values": rng.integers(-2, 3, (300, 8)), "positive": rng.random((300, 8)), "one cluster": 1 + rng.normal(size=(300, 8)) / 50}[kind]
    x = np.floor(256 * x).astype(np.int64)
    ids = rng.permutation(300)
    block = Block(np.arange(300), ids, x)
    for q in range(0, 300, 7):
        best, scores = block.top(x[q], 5, q)
        s = x @ x[q]
        s[q] = -(10**12)
        want = np.lexsort((ids, -s))[:5]
        assert (block.ids[best] == ids[want]).all() and (scores == s[want]).all()


def test_a_floor_stops_earlier():
    rng = np.random.default_rng(4)
    x, ids = np.floor(256 * rng.normal(size=(2000, 8))).astype(np.int64), np.arange(2000)
    block = Block(ids, ids, x)
    for q in range(0, 2000, 97):
        best, scores = block.top(x[q], 5, q)
        for floor in (-(10**9), int(scores[2]), int(scores[0]) + 1):
            some, kept = block.top(x[q], 5, q, floor)
            fits = scores >= floor
            assert list(some) == list(best[fits]) and list(kept) == list(scores[fits])


def test_stops_early():
    x = np.zeros((5000, 4), np.int64)
    x[:, 0] = np.arange(5000)
    block = Block(np.arange(5000), np.arange(5000), x)
    block.x = type("Counted", (np.ndarray,), {"rows": 0, "__getitem__": lambda s, k: (setattr(type(s), "rows", type(s).rows + np.size(k)), np.ndarray.__getitem__(s, k))[1]})(x.shape, x.dtype, x)
    best, _ = block.top(np.array([1, 0, 0, 0]), 3, -1)
    assert list(block.ids[best]) == [4999, 4998, 4997] and type(block.x).rows < 100


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 4)
    monkeypatch.setattr(topk_search, "GROUP_QUERIES", 2)
    rows = [(0, [1.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (20, None), (30, [None, 1.0]), (40, [float("nan"), 1.0]), (50, [float("inf"), 1.0]), (60, []), (None, [1.0, 1.0]), (7, [0.5, 0.5]), (8, [-1.0, 2.0]), (70, [1.0, 2.0, 3.0]), (-10, [0.0, 0.0]), (11, [1e-9, -1e-9])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id AS score", "vec_id AS v", "1 AS d")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, 5, 10).collect())
    assert got == brute(rows, 5, 10)
    assert top_k(frame.limit(0), 5, 10).count() == 0 and top_k(frame.where("vec_id = 70")).count() == 0


@pytest.mark.parametrize("block", [8192, 60])
def test_query(spark, monkeypatch, block):
    """Also where the first block gives the others their floor."""
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in op3_topk_search(spark, folder).collect()) == brute(rows, 5, 50)
