import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from array import array

from feedloom.llm.sentence_pieces import encode_pieces, load, op6_sentence_pieces

from .cases import awkward, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts(library):
    _, encoder = load(PATH)
    rnd = random.Random(11)
    signs = "ab teoin▁ \n\t.,é½日本\U0001d518​0<s>/'ABC"
    for _ in range(5000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(30)))
        ids = array("i", encoder.encode(text)).tolist()
        assert ids == library.encode(text), text
        assert encoder.pieces.decode(ids) == library.decode(ids)
    encoder.check(library)


def test_long_word(library):
    _, encoder = load(PATH)
    text = "".join(random.Random(1).choice("abcde") for _ in range(50_000))
    assert array("i", encoder.encode(text)).tolist() == library.encode(text)


def test_difference_is_an_error(library):
    _, encoder = load(PATH)
    encoder.fresh.append(("word", b"\0\0\0\0"))
    with pytest.raises(ValueError):
        encoder.check(library)
    encoder.fresh.clear()


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op6_sentence_pieces(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_awkward_rows(spark, library):
    rows = encode_pieces(awkward(spark), PATH).collect()
    assert len(rows) == 12
    texts = {r.doc_id: r.text for r in awkward(spark).collect()}
    assert all(r.ids == library.encode(texts[r.doc_id] or "", add_eos=True) for r in rows if r.doc_id is not None)
    assert encode_pieces(empty(spark), PATH).count() == 0
    assert encode_pieces(awkward(spark), PATH, add_eos=False).where("size(ids) = 0").count() == 3
