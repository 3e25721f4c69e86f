"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_model, is_train, mapped, most_frequent, session, table, text_of

#: Bounds of what is learned. About so many labelled rows of each language are
#: learned from, drawn by a hash of their id; so many words and n-grams are remembered.
MAX_TRAIN_ROWS = 5_000
MAX_LANGUAGES = 1_000  # the most frequent ones
MAX_WORDS = 60_000
MAX_GRAMS = 40_000  # of each length
LONGEST_GRAM = 4
LEAST_COUNT = 3
UNKNOWN = "und"

_CACHE = 400_000
_FLUSH = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters (Unicode's L) in lower case."""
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # Numbers that aren't digits, as in x², are no letters.
    return [w for x in found for w in ("".join(c if c.isalpha() else " " for c in x).split() if not x.isalpha() else (x,))]


def grams(word: str, n: int) -> Iterable[str]:
    marked = f"<{word}>"
    return (marked[k : k + n] for k in range(len(marked) - n + 1))


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]  # row of word_scores
    word_scores: np.ndarray  # log frequency in each language
    grams: dict[str, int]
    gram_scores: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)  # workers keep one scorer a model

    def unseen(self, word: str) -> list[int]:
        """Rows of gram_scores: for each end in the word that of the longest known n-gram there."""
        get, marked, rows = self.grams.get, f"<{word}>", []
        for end in range(2, len(marked) + 1):
            for start in range(max(0, end - LONGEST_GRAM), end):
                row = get(marked[start:end])
                if row is not None:
                    rows.append(row)
                    break
        return rows


class Scorer(dict):
    """Rows of a score matrix by word, filled as words are met; those of unseen words a text at a time."""

    def __init__(self, model: LanguageModel):
        self.model, self.used = model, 0
        self.rows = np.empty((_CACHE, len(model.languages)), np.float32)
        self.unseen: list[tuple[int, list[int]]] = []

    def __missing__(self, word: str) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])  # one text with very many words
        k = self.model.words.get(word)
        if k is not None:
            self.rows[self.used] = self.model.word_scores[k]
        elif found := self.model.unseen(word):
            self.unseen.append((self.used, found))
        else:
            self.rows[self.used] = 0
        self[word] = self.used
        self.used += 1
        return self[word]

    def _fill(self) -> None:
        """Scores of new unseen words: the mean over their n-grams, so that together these count as one word."""
        at, found = zip(*self.unseen)
        n = np.fromiter(map(len, found), np.int64, len(found))
        sums = np.add.reduceat(self.model.gram_scores[np.fromiter((r for f in found for r in f), np.int64, int(n.sum()))], np.cumsum(n) - n, axis=0)
        self.rows[list(at)] = sums / n[:, None]
        self.unseen.clear()

    def predict(self, text: str) -> tuple[str, float]:
        found = words(text)
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        if self.used > _CACHE // 2:
            self.clear()
            self.used = 0
            self.rows = self.rows[:_CACHE]
        at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        if self.unseen:
            self._fill()
        total = self.rows[at].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, word, n), summed as far as memory is given to it."""
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        langs, ws = zip(*held) if held else ((), ())
        out = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ws, pa.string()), pa.array(list(held.values()), pa.int64())], names=["lang", "word", "n"])
        held.clear()
        return out

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w, n in Counter(words(text)).items():
                held[lang, w] += n
            if len(held) > _FLUSH:
                yield flush()
    yield flush()


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) to (lang, gram, n)."""
    for b in batches:
        held: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in b.columns)):
            for length in range(1, LONGEST_GRAM + 1):
                for g in grams(word, length):
                    held[lang, g] += n
        langs, gs = zip(*held) if held else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(gs, pa.string()), pa.array(list(held.values()), pa.int64())], names=["lang", "gram", "n"])


def _scores(rows: list, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies from (key, lang, n)."""
    at: dict[str, int] = {}
    for r in rows:
        at.setdefault(r[0], len(at))
    counts = np.full((len(at), len(languages)), 0.5)
    col = {lang: k for k, lang in enumerate(languages)}
    for key, lang, n in rows:
        counts[at[key], col[lang]] += n
    return at, np.log(counts / counts.sum(axis=0)).astype(np.float32) if at else np.zeros((0, len(languages)), np.float32)


def train(df: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> LanguageModel:
    """Log frequencies of words and of n-grams (1 to 4 letters, with word ends) by language.

    Counted in Spark over about ``max_rows`` rows of each language, drawn by a
    hash of the key; the driver gets only MAX_WORDS and MAX_GRAMS, those that
    are most frequent in any of the languages, each beside its own words.
    """
    spark = session(df)
    labelled = df.where(F.col(f"`{label}`").isNotNull()).select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("string").alias("lang"), text_of(text).alias("text"))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES)
    parts = spark.createDataFrame(pa.Table.from_pylist([{"lang": r["lang"], "part": int(min(1.0, max_rows / r["rows"]) * 1_000_000)} for r in sizes.collect()], pa.schema([("lang", pa.string()), ("part", pa.int64())])))
    drawn = labelled.join(F.broadcast(parts), "lang").where(F.pmod(F.xxhash64("k", F.lit("language")), F.lit(1_000_000)) < F.col("part"))
    found = drawn.select("lang", "text").mapInArrow(_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    try:
        tokens = {r[0]: r[1] for r in found.groupBy("lang").agg(F.sum("n")).collect()}
        languages = sorted(tokens)
        totals = spark.createDataFrame(pa.Table.from_pylist([{"lang": x, "tokens": n} for x, n in tokens.items()], pa.schema([("lang", pa.string()), ("tokens", pa.int64())])))

        def top(counts: DataFrame, of: str, k: int) -> list:
            """(of, lang, n) of the ``k`` that are most frequent, as a part of a language's tokens (in millionths of millionths)."""
            share = (F.lit(1e12) * F.col("n") / F.col("tokens")).cast("long")
            ranked = counts.join(F.broadcast(totals), "lang").groupBy(of).agg(F.max(share).alias("share"), F.sum("n").alias("all")).where(F.col("all") >= LEAST_COUNT)
            return counts.join(F.broadcast(most_frequent(ranked.select(of, "share"), of, "share", k)), of).select(of, "lang", "n").collect()

        known = top(found, "word", MAX_WORDS)
        by_gram = found.select("lang", "word", "n").mapInArrow(_gram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
        tables = [_scores(top(by_gram.where(F.char_length("gram") == length), "gram", MAX_GRAMS), languages) for length in range(1, LONGEST_GRAM + 1)]
        by_gram.unpersist()
    finally:
        found.unpersist()
    gram_at: dict[str, int] = {}
    for at, _ in tables:
        first = len(gram_at)
        gram_at |= {g: first + k for g, k in at.items()}
    word_at, word_scores = _scores(known, languages)
    return LanguageModel(languages, word_at, word_scores, gram_at, np.concatenate([s for _, s in tables]))


def _predict(held, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = held_model(name, lambda: Scorer(held.value)).predict
        for b in batches:
            last = b.num_columns - 1
            made = [predict(t or "") for t in b.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], names=[*b.schema.names[:last], "lang_pred", "lang_score"])

    return run


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Every row of ``df`` with ``lang_pred`` and ``lang_score`` (0 to 1).

    A word that the model knows counts with its log frequency in each language;
    any other with the mean over its letters of the longest known n-gram that
    ends there. The best sum wins; the score is its share under equal priors.

    Null texts and texts without a letter give ``und`` and 0; very long texts
    are read whole; ties go to the language that sorts first; input columns
    named like a result are replaced; an empty table gives no rows.
    """
    spark = session(df)
    held = spark.sparkContext.broadcast(model)
    return mapped(df, [F.col(f"`{text}`").cast("string")], _predict(held, model.name), "lang_pred string, lang_score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(is_train(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", (~is_train(F.col("doc_id"))).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


QUERIES = {"op1_language_id": op1_language_id}
ORACLES: dict[str, str] = {}
