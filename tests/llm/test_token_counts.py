import random
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.token_counts import CountTree, apply_edits, build_trees, op10_token_counts, pre_tokens, revisions

from .cases import awkward, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDIT = "array<struct<position: long, n_deleted: long, inserted: string>>"


def apply(text, edits):
    for position, n, inserted in edits:
        position = min(max(position, 0), len(text))
        text = text[:position] + inserted + text[position + max(n, 0) :]
    return text


def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_random_edits():
    counts, rnd = pre_tokens(PATH), random.Random(4)
    parts = ["a", "bc", " ", "  ", "\n", "'", "'re", "s", "é", "1", "23", ".", "!?", "日本", " the", " word", "ll", "\t", "'ll", "\U0001f600"]
    made = lambda *sizes: "".join(rnd.choice(parts) for _ in range(rnd.choice(sizes)))
    for _ in range(1500):
        text = made(0, 1, 3, 10, 60, 600)
        tree = CountTree(text, counts)
        if rnd.random() < 0.7:
            tree = CountTree(text, counts, *tree.kept())
        for _ in range(rnd.randrange(1, 6)):
            edit = (rnd.randrange(-2, len(text) + 3), rnd.choice([-1, 0, 0, 1, 2, 5, 80, 900]), made(0, 1, 2, 5, 50))
            tree.edit(*edit)
            text = apply(text, [edit])
            assert tree.text() == text and [p for k in range(len(tree.leaves)) for p in tree._leaf(k)] == counts.split(text)
            assert tree.n_chars == len(text) and tree.n_tokens == len(counts.encode(text))


def test_work_is_local():
    """A small edit of a long text encodes a few words."""
    tree = CountTree("some words that go on " * 20_000, pre_tokens(PATH))
    kept = CountTree(tree.original, tree.counts, *tree.kept())
    for t in (tree, kept):
        t.edit(200_000, 3, "new")
        assert 0 < t.encoded < 100
    assert sum(leaf is not None for leaf in kept.leaves) <= 3 and kept.kept() == tree.kept()


def test_leaves_stay_small():
    tree = CountTree("a b", pre_tokens(PATH))
    for k in range(3000):
        tree.edit(1, 0, f" w{k}")
    assert max(map(len, tree.leaves)) <= 32 * 9 and tree.n_tokens == library()(tree.text())


def test_query(spark):
    folder, count = "/root/testdata/sf0.001", library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        at = [zlib.crc32(f"{r.doc_id}-{k}".encode()) % (len(text) + 1) for k in range(3)]
        after = apply(text, [(at[0], 12, "revised "), (at[1], 40, ""), (at[2], 0, " A sentence that wasn't there.\n")])
        assert (r.n_tokens, r.n_edits, r.n_tokens_edited, r.n_chars_edited) == (count(text), 3, count(after), len(after))


def test_awkward_rows(spark):
    frame, count = awkward(spark).withColumn("x_edits", F.lit(1)).withColumn("c0", F.lit(2)), library()
    trees = build_trees(frame, PATH)
    assert set(frame.columns) <= set(trees.columns)
    rows = apply_edits(trees, revisions(F.col("doc_id"), F.coalesce("text", F.lit(""))), PATH)
    assert set(frame.columns) <= set(rows.columns)
    assert len(rows.collect()) == 12 and all(r.n_tokens == count(r.text) and r.n_tokens_edited == count(r.text_edited) == sum(r.tree_tokens) for r in rows.collect())
    none = apply_edits(trees, F.lit(None).cast(EDIT), PATH).collect()
    assert all((r.n_edits, r.encoded_chars, r.n_tokens_edited) == (0, 0, r.n_tokens) for r in none)
    holes = F.array(F.lit(None), F.struct(F.lit(None).cast("long").alias("position"), F.lit(None).cast("long").alias("n_deleted"), F.lit("x ").alias("inserted")), F.struct(F.lit(10**9).cast("long").alias("position"), F.lit(5).cast("long").alias("n_deleted"), F.lit(None).cast("string").alias("inserted"))).cast(EDIT)
    twice = apply_edits(apply_edits(trees, holes, PATH), holes, PATH, "text_edited")
    for r in twice.collect():
        assert r.n_edits == 2 and r.text_edited == "x x " + (r.text or "") and r.n_tokens_edited == count(r.text_edited)
    assert apply_edits(build_trees(empty(spark), PATH), F.lit(None).cast(EDIT), PATH).count() == 0


def test_added_tokens_in_edited_texts():
    """Edits make, break and move the strings of added tokens; counts are the library's in its default setting."""
    counts, rnd, tokenizer = pre_tokens(PATH), random.Random(5), Tokenizer.from_file(PATH)
    parts = ["<|endoftext|>", "<|endof", "text|>", "<|", "|>", "endoftext", " ", "  ", "'", "s", "a", " the", "\n"]
    made = lambda *sizes: "".join(rnd.choice(parts) for _ in range(rnd.choice(sizes)))
    for _ in range(1000):
        text = made(0, 1, 3, 10, 60, 300)
        tree = CountTree(text, counts)
        for _ in range(rnd.randrange(1, 6)):
            edit = (rnd.randrange(len(text) + 1), rnd.choice([0, 0, 1, 2, 5, 13, 80]), made(0, 1, 2, 5))
            tree.edit(*edit)
            text = apply(text, [edit])
            assert tree.text() == text and [p for k in range(len(tree.leaves)) for p in tree._leaf(k)] == counts.split(text)
            assert tree.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
