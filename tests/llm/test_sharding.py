import zlib

import numpy as np
import pytest

from feedloom.llm.sharding import op9_sharding, permute, shard, shard_groups

from .cases import awkward, empty


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 15, 16, 17, 1000, 4097])
def test_permutation(n):
    places = permute(np.arange(n), n)
    assert sorted(places) == list(range(n))
    assert (permute(np.arange(n)[::-1], n)[::-1] == places).all()
    if n > 100:
        assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.1 and (permute(np.arange(n), n, 7) != places).any()


def check_law(rows, shards):
    counts = {}
    for r in rows:
        counts.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    sizes = [len(counts.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = op9_sharding(spark, folder).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.law == "rows" and r.grown_shard is None for r in rows)
    check_law(rows, 24)


def feistel(number, n, seed):
    """The same permutation, one number at a time in plain integers."""

    def mix(x, key):
        z = (x + key) % 2**64
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        return z ^ (z >> 31)

    half = 1
    while 4**half < n:
        half += 1
    keys = [mix(k * 0x9E3779B97F4A7C15 % 2**64, seed) for k in range(1, 7)]
    while True:
        left, right = divmod(number, 2**half)
        for key in keys:
            left, right = right, left ^ (mix(right, key) % 2**half)
        number = left * 2**half + right
        if number < n:
            return number


def test_against_brute_force(spark):
    """Shard and slot of every document from its place in order of the id."""
    folder = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.shard, r.slot) for r in shard(frame, 24).collect()}
    places = {doc: feistel(k, len(got), 2024) for k, doc in enumerate(sorted(got))}
    assert got == {doc: (p % 24, p // 24) for doc, p in places.items()}


def test_partitions_do_not_matter(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {r.doc_id: (r.shard, r.slot) for r in shard(frame.coalesce(1), 5).collect()}
    assert one == {r.doc_id: (r.shard, r.slot) for r in shard(frame.repartition(9), 5).collect()}


def test_awkward_rows(spark):
    rows = shard(awkward(spark), 3).collect()
    assert len(rows) == 12 and {r.size for r in rows if r.doc_id == 3} == {8}
    check_law(rows, 3)
    assert sorted(r.row_no for r in rows) == list(range(12))
    assert shard(empty(spark), 3).count() == 0


def of_groups(numbered, shards, seed=2024):
    """numbered: (key, group) in order of the rows' numbers. Shard and slot of each key, a row at a time."""
    n, groups = len(numbered), {}
    for k, (_, g) in enumerate(numbered):
        groups.setdefault(g, []).append(k)
    several = sorted((v for v in groups.values() if len(v) > 1), key=lambda v: feistel(v[0], n, seed))
    total, before = sum(map(len, several)), 0
    held, most = [[] for _ in range(shards)], [n // shards + (s < n % shards) for s in range(shards)]
    loose = [v[0] for v in groups.values() if len(v) == 1]
    for v in several:
        s = before * shards // total
        room = most[s] - len(held[s])
        held[s] += v[:room]
        loose += v[room:]
        before += len(v)
    places = [(s, a) for s in range(shards) for a in range(len(held[s]), most[s])]
    at = {k: (s, a) for s, v in enumerate(held) for a, k in enumerate(v)}
    at |= {k: places[feistel(i, len(loose), seed)] for i, k in enumerate(sorted(loose))}
    return {numbered[k][0]: (s, feistel(a, most[s], seed)) for k, (s, a) in at.items()}


def numbered(frame):
    rows = frame.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS t1", "xxhash64(1, coalesce(text, '')) AS t2").orderBy("t1", "t2", "doc_id").collect()
    return [(r.doc_id, (r.t1, r.t2)) for r in rows]


def test_groups_against_brute_force(spark):
    """No group of equal texts is split."""
    folder = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.shard, r.slot) for r in op9_sharding(spark, folder).collect()}
    rows = numbered(frame)
    assert got == of_groups(rows, 24)
    shards = {}
    for k, g in rows:
        shards.setdefault(g, set()).add(got[k][0])
    assert len(shards) < len(rows) and all(len(s) == 1 for s in shards.values())


@pytest.mark.parametrize("hot, n", [(40, 100), (100, 100), (0, 100), (7, 3000), (0, 2)])
def test_large_groups(spark, hot, n):
    """A group larger than a shard goes on into others; counts still differ by one at most; partitions don't matter."""
    frame = spark.range(n).selectExpr("id AS doc_id", f"CASE WHEN id < {hot} THEN 'hot' WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN concat('pair', id div 10) ELSE string(id) END AS text")
    rows = shard_groups(frame.repartition(7), 6).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == of_groups(numbered(frame), 6)
    check_law(rows, 6)


def test_awkward_groups(spark):
    rows = shard_groups(awkward(spark), 3).collect()
    assert len(rows) == 12
    check_law(rows, 3)
    assert shard_groups(empty(spark), 3).count() == 0
