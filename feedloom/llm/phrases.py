"""Collocations: contiguous phrases grown to the right from projected occurrences of their prefixes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bit_set, session, table, text_of, written

#: Words of a phrase, its least count, and what part of it a longer phrase must have to stand for it, in percent.
LONGEST, LEAST, COVERED = 4, 30, 80
#: Scores are so many times the Dice coefficient's half, floored.
SCALE = 2_000_000
#: Phrases reported of each language.
REPORTED = 2000

#: Filters of what may be frequent, in bits: 4 MB for words, 16 MB for pairs, whatever the corpus. They only leave out what surely isn't.
WORD_BITS, PAIR_BITS = 25, 27
#: Texts are taken so many bytes at a time.
CHUNK_BYTES = 6_000_000
_WORDS_KEPT = 300_000

_SEPARATORS = b".,;:!?\n\v\f\r"
#: Separators become one of them, which no word holds; tabs are spaces; A-Z are small.
_PLAIN = bytes.maketrans(_SEPARATORS + b"\t" + bytes(range(65, 91)), b"." * len(_SEPARATORS) + b" " + bytes(range(97, 123)))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words in order, with ``.`` where pieces end."""
    return text.translate(_PLAIN).replace(b".", b" . ").split()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, tokens) of about CHUNK_BYTES of texts of one language."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            sizes[lang] += len(text) + 1
            if sizes[lang] >= CHUNK_BYTES:
                yield lang, tokens(b"\n".join(held.pop(lang)))
                del sizes[lang]
            elif len(held) > 64:  # many languages: whole sets of them at a time
                lang = max(sizes, key=sizes.__getitem__)
                yield lang, tokens(b"\n".join(held.pop(lang)))
                del sizes[lang]
    for lang, texts in held.items():
        yield lang, tokens(b"\n".join(texts))


def _seed_of(lang: str, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode(), seed)


def _hash(word: bytes, seed: int) -> int:
    """Never 0, which stands for no word."""
    return xxhash.xxh3_64_intdigest(word, seed) or 1


class _Hashes(dict):
    """Hashes of one language's words; 0 for the end of a piece and for words that the filter leaves out."""

    def __init__(self, seed: int, bits: np.ndarray):
        self.seed, self.bits = seed, bits

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        h = 0 if word == b"." else _hash(word, self.seed)
        at = h >> (64 - WORD_BITS)
        if h and not self.bits[at >> 3] >> (at & 7) & 1:
            h = 0
        self[word] = h
        return h


def _pair_code(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (first ^ (second >> np.uint64(31))) * _MIX + second
        x ^= x >> np.uint64(29)
        return x * np.uint64(0xBF58476D1CE4E5B9)


def _in_filter(code: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = code >> np.uint64(64 - PAIR_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _words(seed: int):
    """(lang, text) to (hash, lang, word, n), counted chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _chunks(batches):
            counts = Counter(found)
            counts.pop(b".", None)
            own = _seed_of(lang, seed)
            hashes = np.fromiter((_hash(w, own) for w in counts), np.uint64, len(counts)).view(np.int64)
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array([lang] * len(counts), pa.string()), words, pa.array(list(counts.values()), pa.int64())], names=["h", "lang", "word", "n"])

    return run


class _Sequences:
    """Chunks of texts as sequences of hashes."""

    def __init__(self, seed: int, words: Broadcast):
        self.seed, self.words, self.of = seed, words, {}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        bits = np.frombuffer(self.words.value, np.uint8)
        for lang, found in _chunks(batches):
            if len(self.of) > 16:
                self.of.clear()
            hashes = self.of.setdefault(lang, _Hashes(_seed_of(lang, self.seed), bits))
            yield np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def _runs(columns: list[np.ndarray], code: np.ndarray, n: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows combined, found by their code; equal codes of different rows only combine less."""
    order = np.argsort(code, kind="stable")
    columns = [c[order] for c in columns]
    new = np.ones(len(code), bool)
    if len(code):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(code))) if n is None else np.add.reduceat(n[order], at) if len(at) else n[:0]
    return [c[at] for c in columns], counts


def _batch(columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in columns], pa.array(n, pa.int64())], names=[*[f"h{i + 1}" for i in range(len(columns))], "n"])


def _pairs(seed: int, words: Broadcast):
    """(lang, text) to (h1, h2, n): each frequent word's occurrences, extended by the frequent word to the right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _Sequences(seed, words)(batches):
            first, second = x[:-1], x[1:]
            both = (first != 0) & (second != 0)
            first, second = first[both], second[both]
            yield _batch(*_runs([first, second], _pair_code(first, second), None))

    return run


def _pointers(seed: int, words: Broadcast, pairs: Broadcast):
    """(lang, text) to (h1, h2, h3, h4, n): occurrences of pairs that may be frequent, projected on what follows.

    ``h3`` and ``h4`` are the next words as far as each pair on the way may be
    frequent, else 0; occurrences that nothing follows aren't needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(pairs.value, np.uint8)
        for x in _Sequences(seed, words)(batches):
            fits = (x[:-1] != 0) & (x[1:] != 0)
            fits[fits] = _in_filter(_pair_code(x[:-1][fits], x[1:][fits]), bits)
            at = np.flatnonzero(fits[:-1] & fits[1:])  # of the first of three words
            last = np.append(fits, [False, False])[at + 2]
            padded = np.append(x, np.uint64(0))
            columns = [x[at], x[at + 1], x[at + 2], np.where(last, padded[at + 3], np.uint64(0))]
            code = _pair_code(_pair_code(columns[0], columns[1]), _pair_code(columns[2], columns[3]))
            yield _batch(*_runs(columns, code, None))

    return run


def _grow(least: int):
    """Rows (whole, h1, h2, h3, h4, n) in order of the hashes: the phrases that grow from each prefix (h1, h2), with counts.

    Depth first: the rows of a prefix are narrowed to those of its next word, and
    these to those of the one after. What has fewer than ``least`` occurrences
    isn't grown, unless its prefix is only in part here (``whole`` is false, or
    it may go on in the next batch): then parts are given, to be summed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            whole = b.column(0).to_numpy(zero_copy_only=False)
            h = [b.column(i).to_numpy() for i in range(1, 5)]
            n = b.column(5).to_numpy()
            out: list[tuple] = []

            def extend(low: int, high: int, depth: int, floor: int) -> None:
                column = h[depth][low:high]
                starts = low + np.append(0, np.flatnonzero(column[1:] != column[:-1]) + 1)
                counts = np.add.reduceat(n[low:high], starts - low)
                ends = np.append(starts[1:], high)
                for k in np.flatnonzero((counts >= floor) & (h[depth][starts] != 0)):
                    out.append((starts[k], depth, counts[k]))
                    if depth + 1 < LONGEST:
                        extend(starts[k], ends[k], depth + 1, floor)

            prefix = np.append(0, np.flatnonzero((h[0][1:] != h[0][:-1]) | (h[1][1:] != h[1][:-1])) + 1)
            ends = np.append(prefix[1:], b.num_rows)
            open_ = np.zeros(len(prefix), bool)
            open_[[0, -1]] = True
            open_ |= ~whole[prefix]
            totals = np.add.reduceat(n, prefix)
            for k in np.flatnonzero(open_ | (totals >= least)):
                extend(int(prefix[k]), int(ends[k]), 2, 1 if open_[k] else least)
            at, depth, counts = (np.array(x, np.int64) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
            columns = [h[0][at], h[1][at], h[2][at], np.where(depth > 2, h[3][at], 0)]
            yield _batch(columns, counts)

    return run


def _pair_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        code = _pair_code(*(c.to_numpy().view(np.uint64) for c in b.columns))
        yield pa.RecordBatch.from_arrays([pa.array((code >> np.uint64(64 - PAIR_BITS)).astype(np.int64))], names=["bit"])


def _counted_words(rows: DataFrame, seed: int) -> DataFrame | None:
    """(h, lang, word, n) of all words; None if two of them share a hash under this seed (not seen yet)."""
    parts = rows.mapInArrow(_words(seed), "h long, lang string, word string, n long")
    word = F.struct("lang", "word")
    counts = parts.groupBy("h").agg(F.sum("n").alias("n"), F.min(word).alias("w"), F.max(word).alias("x_last"))
    counts = written(counts, "words")
    if counts.where("w <> x_last").limit(1).count():
        return None
    return counts.select("h", "w.lang", "w.word", "n")


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): exact counts of all words and of phrases of 2 to 4 words with ``least`` occurrences.

    words: h (a hash that tells all words of all languages apart), lang, word,
    n, f >= least only. phrases: h1 to h4 (0 beyond the end), a. totals: lang, n.
    """
    spark = session(df)
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    seed = 0
    while (counts := _counted_words(rows, seed)) is None:
        seed += 1
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counts.where(F.col("n") >= least)
    word_filter = bit_set(spark, words.select(F.shiftrightunsigned("h", 64 - WORD_BITS).alias("bit")), WORD_BITS)
    # Occurrences of frequent words, extended to the right once.
    pairs = rows.mapInArrow(_pairs(seed, word_filter), "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("a"))
    pairs = written(pairs.where(F.col("a") >= least), "pairs")
    pair_filter = bit_set(spark, pairs.select("h1", "h2").mapInArrow(_pair_bits, "bit long"), PAIR_BITS)
    # Of frequent pairs, what follows each occurrence: one task for each pair,
    # but for the very frequent ones, which are dealt by what follows and summed.
    found = rows.mapInArrow(_pointers(seed, word_filter, pair_filter), "h1 long, h2 long, h3 long, h4 long, n long")
    hot = pairs.agg(F.sum("a")).first()[0] or 0
    hot = pairs.where(F.col("a") > hot / 1000).select("h1", "h2", F.lit(False).alias("whole"))
    found = found.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("whole", F.coalesce("whole", F.lit(True)))
    names = ["h1", "h2", "h3", "h4"]
    dealt = found.repartition("h1", "h2", F.when(~F.col("whole"), F.col("h3"))).sortWithinPartitions(*names).select("whole", *names, "n")
    grown = dealt.mapInArrow(_grow(least), "h1 long, h2 long, h3 long, h4 long, n long").groupBy(*names).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    phrases = pairs.select("h1", "h2", F.lit(0).cast("long").alias("h3"), F.lit(0).cast("long").alias("h4"), "a").unionByName(grown)
    return words, written(phrases, "phrases"), totals


def _part(first: int, last: int) -> Column:
    """The words ``first`` to ``last`` (from 1) of a phrase, as a key."""
    none = F.lit(0).cast("long")
    return F.struct(*[(F.col(f"h{first + i}") if first + i <= last else none).alias(f"h{i + 1}") for i in range(LONGEST)])


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): phrases of 2 to 4 words that stand for themselves, of each language.

    Texts, with A-Z lower-cased, are split into pieces at ``.,;:!?`` and line
    ends (10 to 13), pieces into words at spaces and tabs; phrases lie within
    pieces. ``a`` counts all occurrences, overlaps too, and is ``least`` or more; ``n``
    is of all words of the language. A phrase cut after k words has l = count of
    the first part, r = of the rest and the score floor(2000000 a / (l + r)); its
    lowest cut counts, ties to the smallest k. A phrase goes where a longer one
    that holds it has ``covered`` percent of its occurrences.

    A null language is ``und``; null and empty texts have no words; repeated
    rows count each; an empty table gives no rows; other columns aren't looked at.
    """
    words, phrases, totals = phrase_counts(df, text, lang, least)
    exact = "decimal(38,0)"
    size = F.when(F.col("h3") == 0, 2).when(F.col("h4") == 0, 3).otherwise(4)
    phrases = phrases.withColumn("size", size)
    # Shorter phrases inside longer ones, each with the most frequent of these.
    inner = []
    for length in range(3, LONGEST + 1):
        parts = [_part(first, first + k - 1) for k in range(2, length) for first in range(1, length - k + 2)]
        inner.append(phrases.where(F.col("size") == length).select("a", F.explode(F.array(*parts)).alias("key")))
    longer = inner[0].unionByName(inner[1]).groupBy("key").agg(F.max("a").alias("longer"))
    whole = _part(1, LONGEST)
    held = phrases.withColumn("key", whole).join(longer, "key", "left")
    kept = held.where(F.col("longer").isNull() | (F.lit(100).cast(exact) * F.col("longer").cast(exact) < F.lit(covered).cast(exact) * F.col("a").cast(exact)))
    # Every cut, with the counts of both of its parts.
    counts = phrases.select(whole.alias("key"), "a").unionByName(words.select(F.struct(F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(f"h{i}") for i in (2, 3, 4)]).alias("key"), F.col("n").alias("a")))
    cut = lambda length: F.array(*[F.struct(F.lit(k).alias("k"), _part(1, k).alias("left"), _part(k + 1, length).alias("right")) for k in range(1, length)])
    cuts = kept.drop("longer").withColumn("cut", F.explode(F.when(F.col("size") == 2, cut(2)).when(F.col("size") == 3, cut(3)).otherwise(cut(4))))
    side = lambda name, n: counts.select(F.col("key").alias(name), F.col("a").alias(n))
    cuts = cuts.select("key", "size", "a", "cut.*").join(side("left", "l"), "left").join(side("right", "r"), "right")
    score = F.expr(f"cast(a as {exact}) * {SCALE} div (cast(l as {exact}) + r)")
    lowest = cuts.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"), F.first("a").alias("a"), F.first("size").alias("size"))
    out = lowest.select("key.*", "size", "a", "low.l", "low.r", "low.score")
    # The words themselves; all of a phrase's are of one language.
    for i in range(1, LONGEST + 1):
        named = words.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), *["lang"] * (i == 1))
        out = out.join(named, f"h{i}", "inner" if i < 3 else "left")
    out = out.withColumn("phrase", F.concat_ws(" ", *[f"w{i}" for i in range(1, LONGEST + 1)]))
    return out.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best(found: DataFrame, most: int = REPORTED) -> DataFrame:
    """Each language's first ``most`` collocations, with ``rank``: by score, count, then the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(collocations(table(spark, sf_dir, "documents"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, k, w[i : i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k))
), f AS (SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
inner_ AS (
  SELECT lang, p[i : i + j - 1] AS p, max(a) AS longer FROM (SELECT lang, p, a, j, unnest(range(1, k - j + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS j) WHERE j < k) GROUP BY ALL
), kept AS (SELECT c.* FROM c LEFT JOIN inner_ USING (lang, p) WHERE longer IS NULL OR 100 * longer < 80 * a),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT x.lang, x.p, x.a, x.cut, l.a AS l, r.a AS r, (2000000::HUGEINT * x.a // (l.a + r.a))::BIGINT AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.p = x.p[1 : cut] JOIN f r ON r.lang = x.lang AND r.p = x.p[cut + 1 : x.k]
), low AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS k FROM scored),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM low WHERE k = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

QUERIES = {"op11_phrase_mining": op11_phrase_mining}
ORACLES = {"op11_phrase_mining": ORACLE}
