import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import language_id
from feedloom.llm.language_id import UNKNOWN, Scorer, identify, op1_language_id, train

from .cases import awkward, empty


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(spark, docs):
    rows = op1_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    out = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.98


def test_held_out_labels_are_not_read(spark, docs, tmp_path):
    """Other labels, sources and rows order of held-out rows change nothing."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs.withColumns({"lang": F.when(held, "xx").otherwise(F.col("lang")), "source": F.lit("s")}).write.parquet(f"{tmp_path}/documents.parquet")
    as_is = {r.doc_id: (r.lang_pred, r.score) for r in op1_language_id(spark, "/root/testdata/sf0.01").collect()}
    assert as_is == {r.doc_id: (r.lang_pred, r.score) for r in op1_language_id(spark, str(tmp_path)).collect()}


def test_unseen_words_back_off(spark, docs):
    model = train(docs)
    scorer = Scorer(model)
    for word, lang in (("verheitungkeitlichschaft", "de"), ("ciónmentequeadollles", "es"), ("auxeauquementreelle", "fr"), ("thingerthatwhtion", "en")):
        assert word not in model.words and scorer.predict(word)[0] == lang
    assert scorer.predict("12 !?") == (UNKNOWN, 0.0) == scorer.predict("")


def test_long_tails_are_cut(spark, docs, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_WORDS", 50)
    monkeypatch.setattr(language_id, "MAX_GRAMS", 30)
    model = train(docs, max_rows=200)
    assert len(model.words) == 50 and len(model.grams) <= 120
    rows = identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9


def test_many_words_in_one_text(spark, docs, monkeypatch):
    monkeypatch.setattr(language_id, "_CACHE", 100)
    scorer = Scorer(train(docs, max_rows=200))
    text = " ".join("ab" + chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) for i in range(2000))
    assert scorer.predict(text) == scorer.predict(text) and scorer.predict("der und die")[0] == "de"


def test_awkward_rows(spark, docs):
    for model in (train(docs), train(awkward(spark)), train(empty(spark))):
        rows = identify(awkward(spark), model).collect()
        assert len(rows) == 12
        assert all((r.lang_pred, r.lang_score) == (UNKNOWN, 0.0) for r in rows if r.doc_id in (3, 4, 5, 8))
        assert identify(empty(spark), model).count() == 0
        assert set(awkward(spark).columns) <= set(identify(awkward(spark), model).columns)


def test_letters_are_unicode_letters(docs):
    scorer = Scorer(train(docs, max_rows=50))
    assert all(scorer.predict(t) == (UNKNOWN, 0.0) for t in ("½ ² Ⅷ ①", "12 ½", "_ __ 3²"))
    assert language_id.words("X² a_b Ⅷb ½") == ["x", "a", "b", "b"] and scorer.predict("und ½ die")[0] == "de"


def test_a_rare_language_is_learned(spark, docs):
    """However many rows the others have, and however few words are kept."""
    rare = spark.createDataFrame([(10**6 + k, f"zemlja nebo voda ogenj vetrov morje zemlja kamen{k}", "sl") for k in range(6)], "doc_id long, text string, lang string")
    model = train(docs.select("doc_id", "text", "lang").unionByName(rare), max_rows=100)
    assert "sl" in model.languages and Scorer(model).predict("voda ogenj zemlja")[0] == "sl"
