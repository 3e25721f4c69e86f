import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import phrases

from .cases import awkward, empty

FOLDER = "/root/testdata/sf0.001"


def brute(rows, least=30, covered=80, most=2000):
    """Rows (lang, text) to (lang, rank, phrase, a, l, r, n, score), in plain Python."""
    small = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, out = {}, []
    for r in rows:
        f = counts.setdefault(r.lang if r.lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r.text or "").translate(small)):
            w = re.findall(r"[^ \t]+", piece)
            f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in frequent.items():
            for part in {p[i : i + k] for k in range(2, len(p)) for i in range(len(p) - k + 1)}:
                longer[part] = max(longer[part], a)
        found = []
        for p, a in frequent.items():
            if p not in longer or 100 * longer[p] < covered * a:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n, -score) for k, (score, a, p, left, right) in enumerate(sorted(found)[:most])]
    return sorted(out)


def made(frame, **more):
    out = phrases.best(phrases.collocations(frame, **more)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(map(tuple, out.collect()))


def test_query_against_brute_force(spark):
    got = phrases.op11_phrase_mining(spark, FOLDER)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


@pytest.mark.parametrize("least", [3, 8])
def test_smaller_counts(spark, least):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute(frame.collect(), least=least)
    assert len(want) > 200 and made(frame.repartition(5), least=least) == want


def test_hot_pair(spark):
    """One pair of words before ever others: its occurrences are dealt by what follows."""
    frame = spark.range(4000).select(F.lit("en").alias("lang"), F.concat(F.lit("hot pair "), (F.col("id") % 60).cast("string"), F.lit(" x"), (F.col("id") % 7).cast("string"), F.lit(". hot pair hot pair hot pair")).alias("text"))
    want = brute(frame.collect())
    assert len(want) > 60 and made(frame) == want


def test_runs_cut_by_batches():
    """Prefixes that a batch may hold in part are given in parts; sums are as if nothing were cut."""
    rng = np.random.default_rng(3)
    h = np.sort(rng.integers(1, 5, (3000, 4)).view([("", np.int64)] * 4).ravel(), order=["f0", "f1", "f2", "f3"])
    columns = [h[f] for f in h.dtype.names]
    rows = pa.RecordBatch.from_arrays([pa.array(np.ones(3000, bool)), *map(pa.array, columns), pa.array(rng.integers(1, 4, 3000))], names=["whole", "h1", "h2", "h3", "h4", "n"])
    want = Counter()
    for _, a, b, c, d, n in zip(*(x.to_pylist() for x in rows.columns)):
        want[a, b, c, 0] += n
        want[a, b, c, d] += n
    for size in (1, 7, 500, 3000):
        got = Counter()
        for b in phrases._grow(30)(rows.slice(at, size) for at in range(0, 3000, size)):
            for *key, n in zip(*(x.to_pylist() for x in b.columns)):
                got[tuple(key)] += n
        assert {k: v for k, v in got.items() if v >= 30} == {k: v for k, v in want.items() if v >= 30}


def test_awkward_rows(spark):
    frame = awkward(spark)
    want = brute(frame.select("lang", "text").collect(), least=2)
    assert want and made(frame, least=2) == want
    assert made(frame.where("doc_id = 6"))  # one very long text
    assert made(empty(spark)) == []
    odd = spark.createDataFrame([("A\tb  C.d e\x0bd e,,a b c",)] * 40, "text string").withColumn("lang", F.lit(None).cast("string"))
    assert made(odd) == brute(odd.collect())
