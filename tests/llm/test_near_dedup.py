import random

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import near_dedup
from feedloom.llm.components import components
from feedloom.llm.near_dedup import bands, drop_near_duplicates, likely, near_duplicates, op4_near_dedup, registers, shingle_hashes, shingle_set

from .cases import awkward, empty


def brute(rows, k, percent):
    """{key: (size of set, component)}, by comparing all pairs."""
    sets = {}
    for key, text in rows:
        sets.setdefault(key, []).append(shingle_set(text or "", k))
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        ra, rb = sorted((root(a), root(b)))
                        parent[rb] = ra
    return {key: root(key) for key in keys}


def check(spark, rows, k, percent):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(frame, k=k, percent=percent).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert {(r.doc_id, r.n_shingles) for r in got} == {(key, len(shingle_set(t or "", k))) for key, t in rows}


def edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**6)}"
    return " ".join(out)


def test_groups(spark):
    """Copies, chains of edits, a group of many copies edited more or less, short texts, a common passage."""
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(400)}"
    rows, passage = [], " ".join(f"p{i}" for i in range(60))
    base = [word() for _ in range(150)]
    rows += [edited(rnd, base, rnd.choice([0, 1, 2, 3, 4, 8, 15, 30])) for _ in range(120)]
    chain = [word() for _ in range(120)]
    for _ in range(25):
        chain = edited(rnd, chain, 2).split()
        rows.append(" ".join(chain))
    rows += [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] * 2
    rows += [passage + " " + " ".join(word() for _ in range(rnd.randrange(5, 60))) for _ in range(40)]
    rows += ["a b c d e f g h i", "A B  c\td e f g h i", "", None, " "]
    rnd.shuffle(rows)
    check(spark, list(enumerate(rows)), 3, 85)


def test_groups_by_long_lists(spark, monkeypatch):
    """The same where shingles of more than two documents are met by size."""
    monkeypatch.setattr(near_dedup, "SHORT", 2)
    test_groups(spark)


def met(sizes, lefts, t):
    """Pairs (x, y) of rows of one shingle that meet by size."""
    n = len(sizes)
    rows = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([7] * n, range(n), sizes, range(n), lefts, [-1] * n)], names=["shingle", "rep", "n", "component", "left", "main"])
    at = {}
    for b in near_dedup._size_nodes(t)([rows]):
        for y, node in zip(b.column(1).to_pylist(), b.column(6).to_pylist()):
            at.setdefault(node, []).append(y)
    return [(x, y) for b in near_dedup._size_range(t)([rows]) for x, node in zip(b.column(1).to_pylist(), b.column(6).to_pylist()) for y in at.get(node, ())]


@pytest.mark.parametrize("t", [80, 85, 100])
def test_rows_meet_sizes_they_fit(t):
    """Every row meets each row whose size fits what it has left, once, and no other."""
    rnd = random.Random(t)
    sizes = [rnd.choice([rnd.randrange(1, 60), rnd.randrange(1, 3000)]) for _ in range(500)]
    lefts = [rnd.randrange(n * t // 100, n + 1) for n in sizes]
    fits = lambda a, b: 100 * sizes[b] >= t * sizes[a] and 100 * sizes[a] >= t * sizes[b] and lefts[a] * (100 + t) >= (sizes[a] + sizes[b]) * t
    assert sorted(met(sizes, lefts, t)) == [(a, b) for a in range(500) for b in range(500) if fits(a, b)]


def test_a_common_passage_makes_no_pairs():
    """Documents with 90 shingles in common and 10 or more of their own: whatever their number, none meet."""
    rnd = random.Random(5)
    for n in (2_000, 32_000):
        assert met([90 + rnd.randrange(16, 22) for _ in range(n)], [90] * n, 85) == []


def test_threshold_is_met_exactly(spark):
    # 17 of 20 shingles shared is 0.85; 16 of 19 isn't.
    words = [f"w{i}" for i in range(22)]
    rows = [(1, " ".join(words[:20])), (2, " ".join(words[:19])), (3, " ".join(words)), (4, " ".join(words[:19]).upper())]
    check(spark, rows, 3, 85)
    check(spark, rows, 5, 80)


def test_repeated_ids_and_equal_sets(spark):
    """A key with two texts joins what either is like, and takes its empty rows along; texts of one set are compared."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (2, a + " x"), (2, b), (3, b + " y"), (3, ""), (4, ""), (4, None), (7, a.upper() + "  "), (8, "c d e f g c d e f g"), (9, "c d e f g c d e")]
    check(spark, rows, 3, 85)
    kept = drop_near_duplicates(spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, t1 int"), k=3, percent=85).collect()
    # Rows are told apart here: of each group one row stays, and rows without shingles.
    assert sorted(r.t1 for r in kept) == [0, 2, 4, 5, 6, 8]


def test_sets_of_one_digest_are_told_apart(spark, monkeypatch):
    """If two sets share a digest under one seed, the next one is taken."""
    real = near_dedup._sketch
    monkeypatch.setattr(near_dedup, "_sketch", lambda k, seed: _all_alike(real(k, seed)) if seed == 0 else real(k, seed))
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    check(spark, [(1, a), (2, b), (3, a + " x")], 3, 85)


def _all_alike(sketch):
    def run(batches):
        for b in sketch(batches):
            same = pa.array([5] * b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([same if n in ("h1", "h2") else c for n, c in zip(b.schema.names, b.columns)], names=b.schema.names)

    return run


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: r.component_id for r in op4_near_dedup(spark, folder).collect()}
    assert got == brute(rows, 3, 85)


def test_awkward_rows(spark):
    got = near_duplicates(awkward(spark)).collect()
    assert len(got) == 12
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert of[1].component_id == of[2].component_id == 1 and of[1].kept and not of[2].kept
    assert all(of[k].component_id == k and of[k].n_shingles == 0 for k in (3, 4, 5))
    assert sorted((r.component_id or 0, r.kept, r.n_shingles) for r in got if r.doc_id is None) == [(0, True, 0), (0, True, 1)]
    frame = awkward(spark)
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert near_duplicates(empty(spark)).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:1700]), np.unique(pool[300:2000])  # 1400 of 2000: 0.7
    ra, rb = registers(a), registers(b)
    assert (np.maximum(ra, rb) == registers(np.union1d(a, b))).all()
    assert abs((ra == rb).mean() - 0.7) < 0.15
    sure = lambda x, y, t: likely(registers(x)[None], registers(y)[None], np.array([len(x)]), np.array([len(y)]), t)[0]
    assert sure(a, b, 0.7) and sure(a, a, 0.99) and not sure(a, b[-900:], 0.85) and not sure(a[:1000], np.unique(pool[2000:]), 0.5)
    assert len(set(bands(ra))) == near_dedup.BANDS and (bands(ra) >= 0).all()


def test_no_similar_pair_is_thought_unlikely():
    rng = np.random.default_rng(2)
    for n in (7, 20, 100, 1000):
        for _ in range(150):
            pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
            out = max(1, int(n * 0.08))
            a, b = np.unique(pool[:n]), np.unique(pool[out : n + out])
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            if j >= 0.85:
                assert likely(registers(a)[None], registers(b)[None], np.array([len(a)]), np.array([len(b)]), 0.85)[0]


def test_hashes_are_of_sets():
    assert len(shingle_hashes("a b c a b c a b c", 3)) == len(shingle_set("a b c a b c a b c", 3)) == 3
    assert (shingle_hashes("A b", 3) == shingle_hashes("a  B", 3)).all() and len(shingle_hashes("a b", 3)) == 1
    assert shingle_hashes("É", 3)[0] != shingle_hashes("é", 3)[0]  # only A-Z are lower-cased


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    n = 150
    edges = [(i, i + 1) for i in range(40)] + [(60, k) for k in range(61, 90)] + [(rnd.randrange(90, n), rnd.randrange(90, n)) for _ in range(45)]
    edges = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in edges]
    parent = {}
    root = lambda x: x if parent.setdefault(x, x) == x else root(parent[x])
    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_only_what_is_compared_travels(spark):
    """Rows without a partner are left out before a shuffle: of 1,000 unlike texts and a pair alike few but the pair are left."""
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(1000)] + [(k, " ".join(f"same{j}" for j in range(60)) + f" {k}") for k in (2000, 2001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    search = near_dedup._Search(docs, "doc_id", "text", 3, 85)
    assert {r.doc for r in search.met.collect()} >= {2000, 2001} and search.met.count() == search.members.select("rep").distinct().count() < 20
    left = {r.doc for r in search._meeting(search.docs, search.met, ["doc", "t1", "t2"]).collect()}
    assert left >= {r.doc for r in search.met.collect()} and len(left) < 40
