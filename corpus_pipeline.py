"""Stages that make packed training sequences of the documents: see STAGES.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. ``run``
writes each stage's rows as Parquet in the shared folder, and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import exact_dedup, language_id, near_dedup, packing, toxicity
from feedloom.llm.common import is_train, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose language is less sure than this go.
LEAST_LANGUAGE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores every text for toxicity; those at the threshold or above go. Learns from ``labels``.

    Null and empty texts stay, and so does every text if there are no labels.
    Each row is judged by itself: repeated rows, and rows with a null id, go only for their text.
    """
    labels = table(spark, sf_dir, "labels").where(is_train(F.col("doc_id")))
    scored = toxicity.score(docs.select(*COLUMNS), toxicity.train(docs, labels))
    return scored.where(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predicts every text's language; those without a letter, or unsure between languages, go.

    Null and empty texts have no letter and go. If no row names a language,
    there is nothing to learn from and all rows stay. Each row is judged by
    itself: repeated rows all stay or all go, as do rows with a null id.
    """
    model = language_id.train(docs.where(is_train(F.col("doc_id"))))
    if not model.languages:
        return docs.select(*COLUMNS)
    named = language_id.identify(docs.select(*COLUMNS), model)
    return named.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE)).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    Null texts count as empty; a null id loses to any other; of repeated rows exactly one stays.
    """
    return exact_dedup.exact_dedup(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 over five-word shingles the one with the smallest id stays.

    Texts without words, rows with a null id, and rows that no link joins to
    another stay, also those of an id whose other texts go.
    """
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what remains into sequences of 1024 tokens: one row a piece, with its token ids.

    Null and empty texts give the end id alone; repeated rows are packed as often as they come.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: Learned scores and tokens can't be given in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
