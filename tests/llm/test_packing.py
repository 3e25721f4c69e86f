import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.packing import cut, encode_whole, first_fit, op8_packing, pack

from .cases import awkward, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 1000, 1024])
def test_cut(capacity):
    for n in range(1, 3 * capacity):
        pieces = cut(n, capacity)
        assert sum(p for p, _ in pieces) == n
        for length, j in pieces:
            assert length * j <= capacity and (length == capacity // j or length <= 32)


def test_first_fit():
    assert first_fit([6, 5, 4, 4], 10) == [(0, 0), (1, 0), (0, 6), (1, 5)]


def check(rows, texts, encode, capacity=1024):
    """Every id in one piece, pieces gapless in their sequences; the part of tokens in what is filled."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = encode(text) + [0], 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows) / (len(by_sequence) * capacity)


@pytest.mark.parametrize("scale, least", [("sf0.001", 0.98), ("sf0.01", 0.995)])
def test_query(spark, library, scale, least):
    folder = f"/root/testdata/{scale}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert check(op8_packing(spark, folder).collect(), texts, library) > least


def test_many_partitions(spark, library, tmp_path):
    """Each task leaves open bins; together they still fill up."""
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    frame.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert check(op8_packing(spark, str(tmp_path)).collect(), texts, library) > 0.995


@pytest.mark.parametrize("capacity", [64, 256, 512, 1024])
def test_every_capacity(spark, library, capacity):
    """No sequence is too full, also where pieces of several lengths are of one class."""
    texts = {k: "word " * (7 * k % (2 * capacity)) for k in range(60)} | {100: "a <|endoftext|> b", 101: "", 102: None}
    rows = pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6), PATH, capacity)
    rows = rows.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset").collect()
    assert check(rows, texts, library, capacity) > 0.8


def test_awkward_rows(spark, library):
    rows = pack(awkward(spark), PATH, 64).collect()
    assert sum(r.length for r in rows) == sum(len(library(t)) + 1 for t in [r.text for r in awkward(spark).select("text").collect()])
    assert [bytes(r.token_ids) for r in rows if r.doc_id == 3] == [b"\0\0\0\0"]
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in filled.values():
        at = sorted(pieces)
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 64
    assert pack(empty(spark), PATH).count() == 0


def test_ids_are_the_librarys(library):
    encode = encode_whole(PATH)
    for text in ["", " ", "a  b\n\n c", "don't I'LL", "x" * 3000, "<|endoftext|> a", "日本語 é́ \U0001f600", "\t    z", "1234567 !!??", "ab" * 900]:
        assert encode(text) == library(text)


def test_added_tokens_in_texts(spark):
    """Ids are those of the library in its default setting, which finds added tokens in texts."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = {k: t for k, t in enumerate(["<|endoftext|>", "a <|endoftext|> b", "don't<|endoftext|>'s  <|endoftext|>\n\nx", "x <|endoftext|"])}
    rows = pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH).collect()
    got = {r.doc_id: np.frombuffer(bytes(r.token_ids), "<u4").tolist() for r in rows}
    assert got == {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()}
