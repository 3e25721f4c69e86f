import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from feedloom.llm.near_dedup import shingle_set

from .cases import awkward

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The documents after each stage."""
    out, docs = {"start": spark.read.parquet(f"{FOLDER}/documents.parquet")}, spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "exact_dedup", "near_dedup", "packing"]
    for name in ("toxicity", "language_id", "exact_dedup", "near_dedup"):
        assert kept[name].columns == list(corpus_pipeline.COLUMNS)


def test_toxic_go_and_clean_stay(spark, kept):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = texts(kept["toxicity"])
    gone = set(texts(kept["start"])) - set(left)
    assert gone and not any(labels.get(d) == 0 for d in gone)
    words = {"stupid", "idiot", "moron", "clown", "loser", "trash", "disgusting", "scum", "pathetic", "worthless"}
    assert not any(words & set(t.lower().split()) for t in left.values())


def test_clean_languages_stay(kept):
    assert set(texts(kept["language_id"])) == {d for d, t in texts(kept["toxicity"]).items() if any(c.isalpha() for c in t)}


def test_exact_copies_go(kept):
    before, after = texts(kept["language_id"]), texts(kept["exact_dedup"])
    largest = {t: max(d for d, x in before.items() if x == t) for t in set(before.values())}
    assert after == {d: t for t, d in largest.items()}


def test_near_copies_go(kept):
    before, after = texts(kept["exact_dedup"]), texts(kept["near_dedup"])
    sets = {d: shingle_set(t, 5) for d, t in before.items()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(sets)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    assert set(after) == {d for d in sets if root(d) == d}


def test_packing_keeps_every_token(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in kept["packing"].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.token_ids)))
    left = texts(kept["near_dedup"])
    assert set(pieces) == set(left)
    for doc, text in left.items():
        raw = b"".join(x for _, x in sorted(pieces[doc]))
        assert [int.from_bytes(raw[k : k + 4], "little") for k in range(0, len(raw), 4)] == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_run(spark, kept):
    same = lambda df: sorted((r.doc_id, r.start, r.length, bytes(r.token_ids)) for r in df.collect())
    assert same(corpus_pipeline.run(spark, FOLDER)) == same(kept["packing"])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_awkward_rows(spark, name, stage, tmp_path):
    spark.createDataFrame([(1, 0), (7, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    awkward(spark).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert stage(spark, rows, str(tmp_path)).count() > 0
    assert stage(spark, rows.limit(0), str(tmp_path)).count() == 0
    assert stage(spark, rows.select("doc_id", F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars"), str(tmp_path)).count() >= 0
