"""Cross-entropy difference between a target and a background n-gram model."""

from __future__ import annotations

import functools
import re
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import most_frequent, session, table, text_of, written
from .near_dedup import with_text_hashes

#: Weight of the unigram model inside the bigram model, as that many tokens seen.
BACKOFF = 5.0
#: Words of the shared vocabulary: those with a unigram probability of their own.
#: All others share what is left evenly; pairs are counted for every word.
VOCABULARY = 50_000
#: Pairs of the so many most frequent words are counted in a table of all such
#: pairs, which every task gets. Any other pair has a word beyond them, and so
#: less than 1 / FREQUENT of all tokens: no key of the shuffle is hotter.
FREQUENT = 1024
#: Up to so many target keys are broadcast to the texts; more are shuffled with them.
BROADCAST_KEYS = 500_000
#: Log probabilities are whole numbers of this unit, so that sums don't depend on their order.
UNIT = 2.0**-24

_KINDS = (r"[^\W\d_]+", r"\d+", r"[^\w\s]+")
_TOKEN = re.compile("|".join(_KINDS))
#: Words held by a task that counts them.
_FLUSH = 300_000
#: Characters that are split into tokens at a time, and tokens whose pairs are dealt at a time.
_WINDOW, _PIECE = 1 << 21, 1_000_000
#: Rows of a piece at most: a row's number there and its flags have 16 bits.
_ROWS, _WINDOW_ROWS = 8192, 1024
#: Stands for the start and the end of each text; no token is white space.
_BOUNDARY = "\n"
_END = len(_KINDS) + 1
#: A word's number in the vocabulary has so many bits.
_CODE_BITS = 16
#: Flags in a row's number: in the target, counted, scored.
_TARGET, _COUNTED, _SCORED = 1, 2, 4
#: Tokens of all rows for each partition that pairs are dealt to, at most. Pairs go where
#: their rarer word goes, so that a row's sums come back from few of them; those of a
#: word that alone has half as many tokens go by the pair.
PART_TOKENS = 1_000_000


def tokens(text: str) -> list[str]:
    """Runs of letters, of digits, and of other signs, in lower case."""
    return _TOKEN.findall(text.lower())


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Of each character: the kind of token that it belongs to (0: none), and a random number."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for i, kind in enumerate(_KINDS):
        for m in re.finditer(kind, every):
            kinds[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = i + 1
    return kinds, _finished(np.arange(1, sys.maxunicode + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number from 0 to n - 1, and what each gives 1 with, modulo 2^64."""
    base = 0x94D049BB133111EB
    return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (base, pow(base, -1, 1 << 64)))


def _finished(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hashed(chars: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of lower-cased texts, which end at ``ends``: (start, end, 64-bit hash) of each. An end is one as well, with the hash 0.

    A hash is the sum of the characters' numbers times powers by their place, all
    tokens' from one running sum. Windows are cut where a token ends.
    """
    kind_of, number_of = _characters()
    out, first, width = [], 0, _WINDOW
    while first < len(chars):
        points = np.frombuffer(chars[first : first + width].encode("utf-32-le"), np.uint32)
        kinds = kind_of[points]
        own = ends[np.searchsorted(ends, first) : np.searchsorted(ends, first + width)] - first
        kinds[own] = _END
        new = np.ones(len(points) + 1, bool)
        np.not_equal(kinds[1:], kinds[:-1], out=new[1:-1])
        new[own] = True
        at = np.flatnonzero(new)
        if first + width < len(chars):
            if len(at) == 2:
                width *= 2
                continue
            at = at[:-1]  # the last token may go on
        powers, inverses = _powers(width)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(number_of[points] * powers[: len(points)], out=sums[1:])
        kept = kinds[at[:-1]] > 0
        start, end = at[:-1][kept], at[1:][kept]
        hashes = np.maximum(_finished((sums[end] - sums[start]) * inverses[start]), np.uint64(1))
        hashes[kinds[start] == _END] = 0
        out.append((start + first, end + first, hashes))
        first, width = first + int(at[-1]), _WINDOW
    return tuple(np.concatenate(x) for x in zip(*out))


def _windows(texts: pa.Array) -> Iterator[tuple[int, str, np.ndarray]]:
    """Whole texts, about _WINDOW characters at a time: (how many, in lower case with a boundary after each, where they end)."""
    held, ends, size = [], [], 0
    for k, text in enumerate(texts):
        held.append(text.as_py().lower())
        size += len(held[-1]) + 1
        ends.append(size - 1)
        if size >= _WINDOW or len(held) == _WINDOW_ROWS or k == len(texts) - 1:
            yield len(held), _BOUNDARY.join([*held, ""]), np.array(ends)
            held, ends, size = [], [], 0


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it in any of the columns, the first place too."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, flags) to (word, n, n in target), with one boundary a text."""
    held: tuple[Counter, Counter] = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        words = list(held[0])
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[0][w] for w in words], pa.int64()), pa.array([held[1][w] for w in words], pa.int64())], names=["word", "n", "n_target"])
        for c in held:
            c.clear()
        return out

    for b in batches:
        first, flags = 0, b.column(1).to_numpy() & _TARGET
        for k, chars, ends in _windows(b.column(0)):
            start, end, hashes = _hashed(chars, ends)
            of_target = flags[first : first + k][np.cumsum(hashes == 0) - (hashes == 0)].astype(np.int64)
            order = np.argsort(hashes)
            new = _changes(hashes[order])
            words = [chars[i:j] for i, j in zip(start[order[new]].tolist(), end[order[new]].tolist())]
            for c, counts in zip(held, (np.diff(new, append=len(order)), np.add.reduceat(of_target[order], new))):
                for word, n in zip(words, counts.tolist()):
                    if n:
                        c[word] += n
            first += k
            if len(held[0]) > _FLUSH:
                yield flush()
    yield flush()


def _vocabulary(numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, ascending, and their numbers."""
    if not numbers:
        return np.zeros(1, np.uint64), np.zeros(1, np.int64)
    words = list(numbers)
    hashes = _hashed(_BOUNDARY.join([*words, ""]), np.cumsum([len(w) + 1 for w in words]) - 1)[2]
    hashes = hashes[hashes > 0]
    order = np.argsort(hashes)
    return hashes[order], np.array(list(numbers.values()))[order]


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of about _PIECE tokens, the text being the last column: (rows, first and second code of each pair, its row, pairs a row).

    Codes are the numbers of words of the vocabulary, hashes below 0 of others, and 0 for the boundary.
    """
    known, numbers = vocabulary
    for b in batches:
        first, held, size, n_rows, done = 0, [], 0, 0, 0
        for k, chars, ends in _windows(b.column(b.num_columns - 1)):
            hashes = _hashed(chars, ends)[2]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            held.append(np.where(known[at] == hashes, numbers[at], -1 - (hashes >> np.uint64(1)).astype(np.int64)))
            held[-1][hashes == 0] = 0
            size, n_rows, done = size + len(hashes), n_rows + k, done + k
            if size > _PIECE or n_rows > _ROWS - _WINDOW_ROWS or done == b.num_rows:
                codes = np.concatenate([np.zeros(1, np.int64), *held])
                of = np.cumsum(codes == 0)[:-1] - 1
                yield b.slice(first, n_rows), codes[:-1], codes[1:], of, np.bincount(of)
                first, held, size, n_rows = done, [], 0, 0


def _among(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Pairs of two frequent words."""
    return (a >= 0) & (a < size) & (b >= 0) & (b < size)


def _count_frequent(held):
    """(flags, text) to (cell, n, n in target): pairs of frequent words, cells being numbered by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, size = held.value
        counts = np.zeros((2, size * size), np.int64)
        for rows, a, b, of, _ in _pieces(batches, vocabulary):
            fits = _among(a, b, size)
            of_target = (rows.column(0).to_numpy() & _TARGET)[of[fits]].astype(np.int64)
            counts += np.bincount(of_target * (size * size) + a[fits] * size + b[fits], minlength=2 * size * size).reshape(2, -1)
        at = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.sum(axis=0)[at]), pa.array(counts[1][at])], names=["cell", "n", "n_target"])

    return run


@dataclass
class PairModel:
    """What the two models know before all pairs are counted. Index 0 is the background's, 1 the target's."""

    rows: DataFrame  # counted from: k, t1, t2, flags, text
    docs: DataFrame  # as given
    key: str
    numbers: dict[str, int]
    single: np.ndarray  # probability of each word by number; the last is that of any word outside the vocabulary
    total: np.ndarray  # what counts of single words are divided by
    before: np.ndarray  # how often each word of the vocabulary comes before another
    frequent: np.ndarray  # how often each pair of frequent words comes
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def size(self) -> int:
        return int(self.frequent.shape[1])


def _rows(df: DataFrame, key: str, text: str, flags: Column) -> DataFrame:
    own = df.select(F.col(f"`{key}`").cast("long").alias("k"), text_of(text).alias("text"))
    return with_text_hashes(own, "text").select("k", "t1", "t2", flags.cast("int").alias("flags"), "text")


def train(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, frequent: int = FREQUENT) -> PairModel:
    """Both models, counted over every row: the background over all, the target over those whose key ``target`` holds.

    They are matched in vocabulary (the most frequent words of all rows, ties
    in order of the word), order and smoothing, not in size: the background is
    every row, those of the target too. The driver gets the vocabulary's counts
    and the pairs of ``frequent`` words, bounded at any size; all other pairs,
    of all words, are counted when texts are scored, in the executors, and grow
    with the corpus.

    Null texts count as empty, which is one boundary; a row with a null key is
    never of the target; repeated rows count as often as they come. Without
    rows, or without a target, words have the smoothing's probability alone.
    """
    if vocabulary >= 1 << _CODE_BITS:
        raise ValueError(f"a vocabulary has fewer than {1 << _CODE_BITS} words")
    spark = session(df)
    keys = target.select(F.col(f"`{key}`").cast("long").alias("k")).where("k IS NOT NULL").distinct().withColumn("of_target", F.lit(_TARGET))
    rows = _rows(df, key, text, F.lit(_COUNTED))
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    rows = rows.join(F.broadcast(keys) if few else keys.hint("merge"), "k", "left").select("k", "t1", "t2", (F.col("flags") + F.coalesce("of_target", F.lit(0))).alias("flags"), "text")
    if not few:
        # Rows are numbered by their place, which a second run of a shuffle may change.
        rows = written(rows, "rows")

    counted = rows.select("text", "flags").mapInArrow(_count_words, "word string, n long, n_target long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
    counted = written(counted, "words")
    words = counted.where(F.col("word") != _BOUNDARY)
    top = most_frequent(words, "word", "n", vocabulary).collect()
    numbers = {r["word"]: i + 1 for i, r in enumerate(top)}
    none = lambda c: F.coalesce(F.sum(c), F.lit(0))
    texts = counted.where(F.col("word") == _BOUNDARY).agg(none("n"), none("n_target")).first()
    n_words, *totals = words.agg(F.count(F.lit(1)), none("n"), none("n_target")).first()
    others = n_words - len(top)
    before = np.array([[texts[m], *(r[m + 1] for r in top)] for m in (0, 1)], np.float64)
    rest = [(totals[m] - before[m, 1:].sum()) / max(others, 1) for m in (0, 1)]
    all_ = [totals[m] + texts[m] + n_words + 1 for m in (0, 1)]
    single = np.array([[*((before[m] + 1) / all_[m]), (rest[m] + 1) / all_[m]] for m in (0, 1)])

    size = min(frequent, len(top) + 1)
    held = spark.sparkContext.broadcast((_vocabulary({w: i for w, i in numbers.items() if i < size}), size))
    cells = rows.select("flags", "text").mapInArrow(_count_frequent(held), "cell long, n long, n_target long").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).toArrow()
    pairs = np.zeros((2, size * size))
    for m, c in enumerate(("n", "n_target")):
        pairs[m, cells["cell"].to_numpy()] = cells[c].to_numpy()
    pairs = pairs.reshape(2, size, size)
    return PairModel(rows, df, key, numbers, single, np.array(all_, np.float64), before, pairs)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x = (x + b.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return x.view(np.int64)


def _key_starts(before: np.ndarray) -> np.ndarray:
    """Where the keys of pairs begin, in their first 32 bits, by second word; then those with any outside the vocabulary, then those of contexts outside it.

    Each word of the vocabulary has a share as it is frequent, of a half; so
    pairs lie about as evenly over 64 bits as their hashes.
    """
    widths = np.maximum((before[0] + 1) / (before[0] + 1).sum() * (1 << 31), 1).astype(np.uint64)
    others = widths.sum()
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(widths), np.array([others + np.uint64(1 << 30)])])


def _keys(second: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys in the shares of ``second`` (see ``_key_starts``), by a hash."""
    hashes, low = hashes.view(np.uint64), np.uint64(32)
    spans = np.diff(starts, append=np.uint64(1 << 32))
    first = starts[second] + (((hashes >> low) * spans[second]) >> low)
    return ((first << low) | (hashes & np.uint64((1 << 32) - 1))).view(np.int64)


_BUNDLE = "part int, block long, row array<smallint>, key array<long>, own array<tinyint>, more array<int>, brought array<long>"
_SHARE = "block long, kind int, row array<smallint>, units array<int>, brought array<long>"
#: Kinds of shares: the background's and the target's, each in two parts, and what rows bring along.
_LARGE, _BROUGHT = 2, 4


def _counts(of: np.ndarray, codes: np.ndarray, bits: int) -> np.ndarray:
    """For each element, how often its row ``of`` has its code (0 to 2^bits - 1)."""
    both = (of << bits) | codes
    order = np.argsort(both)
    n = np.diff(_changes(both[order]), append=len(order))
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(n, n)
    return out


def _units(x: np.ndarray) -> np.ndarray:
    return np.round(np.log(x) / UNIT).astype(np.int64)


def _lists(ends: np.ndarray, values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _events(held):
    """(k, t1, t2, flags, text) to bundles of events (row, key, own, more) for each partition.

    Of each row: every pair with a word that isn't frequent, once, and every
    context outside the vocabulary. ``own`` is how often the row itself has a
    pair's second word, if that is of the vocabulary; -1 if the pair comes more
    than once or this is large: ``more`` has both then, in turn. For the rows that
    are scored, one more bundle of a piece brings what they are known by and
    their sums, in which no other row has the pairs and contexts that travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, single, total, before, frequent, common, whole, parts = held.value
        size, n_vocabulary = frequent.shape[1], before.shape[1]
        names, starts = [c.split(" ")[0] for c in _BUNDLE.split(", ")], _key_starts(before)
        block = TaskContext.get().partitionId() << 32
        dealt_as = np.uint16 if parts <= 1 << 16 else np.int64  # numpy sorts 16 bits by radix
        part_of = lambda word: (_finished(word * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(dealt_as)

        for rows, a, b, of, n in _pieces(batches, vocabulary):
            block += 1
            flags = rows.column(3).to_numpy().astype(np.int64)
            fits, placed, known = _among(a, b, size), a >= 0, b >= 0
            # How often the row has the second word, and so the first, which is the one before it.
            own_b = np.zeros(len(b), np.int64)
            own_b[known] = _counts(of[known], b[known], _CODE_BITS)
            own_a = np.roll(own_b, 1)
            own_a[np.cumsum(n) - n] = 1
            # Pairs to be counted, and contexts, each once for each row.
            apart, alone_a = ~fits, a[~placed]
            second = np.concatenate([np.where(known, b, n_vocabulary)[apart], np.full(len(alone_a), n_vocabulary + 1)])
            keys = _keys(second, np.concatenate([_mixed(a[apart], b[apart]), _mixed(alone_a, ~alone_a)]), starts)
            if len(keys):
                rarer = np.concatenate([np.maximum(a[apart].view(np.uint64), b[apart].view(np.uint64)), alone_a.view(np.uint64)])
                by_pair = common[np.minimum(rarer, np.uint64(n_vocabulary)).astype(np.int64)]
                to = part_of(np.where(by_pair, keys.view(np.uint64), rarer))
                rs = np.concatenate([of[apart], of[~placed]]).astype(np.uint16)
                own = np.concatenate([own_b[apart], np.zeros(len(alone_a), np.int64)])
                order = np.argsort(keys)
                order = order[np.argsort(rs[order], kind="stable")]
                new = _changes(keys[order], rs[order])
                times = np.diff(new, append=len(order))
                order = order[new]
                dealt = np.argsort(to[order], kind="stable")
                order, times = order[dealt], times[dealt]
                to, own = to[order], own[order]
                large = (times > 1) | (own > 126)
                heads = _changes(to)
                ends = np.append(heads, len(to))
                row = (rs[order].astype(np.int64) << 3) + flags[rs[order]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(to[heads].astype(np.int32)), pa.array(np.full(len(heads), block)),
                    _lists(ends, row.astype(np.uint16).view(np.int16), pa.int16()), _lists(ends, keys[order], pa.int64()), _lists(ends, np.where(large, -1, own).astype(np.int8), pa.int8()),
                    _lists(2 * np.append(0, np.cumsum(large))[ends], np.stack([times[large], own[large]], 1).ravel().astype(np.int32), pa.int32()), pa.nulls(len(heads), pa.list_(pa.int64())),
                ], names=names)
            scored = np.flatnonzero(flags & _SCORED)
            if len(scored):
                brought = []
                own_pair = _counts(of[fits], a[fits] * size + b[fits], 2 * max(size - 1, 1).bit_length())
                for m, counted in enumerate((_COUNTED, _COUNTED + _TARGET)):
                    # A row that the model was counted from is scored without what it brought.
                    less = ((flags & counted) == counted)[of].astype(np.int64)
                    found = BACKOFF * (single[m, np.where(known, b, n_vocabulary)] - own_b * less / total[m])
                    found[fits] += frequent[m, a[fits], b[fits]] - own_pair * less[fits]
                    context = np.full(len(a), BACKOFF)
                    context[placed] += before[m, a[placed]] - own_a[placed] * less[placed]
                    brought.append(pa.array(np.add.reduceat(_units(found) - _units(context), np.cumsum(n) - n)[scored]))
                brought += [pa.array(n[scored]), *[rows.column(c).take(pa.array(scored)) for c in ((0, 1, 2) if whole else (0,))]]
                none = lambda t: pa.nulls(1, pa.list_(t))
                ends = np.array([0, len(scored)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block % parts], pa.int32()), pa.array([block]), _lists(ends, scored.astype(np.int16), pa.int16()),
                    none(pa.int64()), none(pa.int8()), none(pa.int32()), _lists(ends * len(brought), pa.concat_arrays(brought), pa.int64()),
                ], names=names)

    return run


def _shares(held):
    """All bundles of a partition to what the other rows' pairs add to each row's sums, by block, with what rows bring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, total, before = held.value
        rest, key_starts = before.shape[1], _key_starts(before)
        names = [c.split(" ")[0] for c in _SHARE.split(", ")]
        bundles = []
        for b in batches:
            brought = b.column("brought")
            if brought.null_count < len(brought):
                own = b.filter(brought.is_valid())
                yield pa.RecordBatch.from_arrays([own.column("block"), pa.array(np.full(len(own), _BROUGHT, np.int32)), own.column("row"), pa.nulls(len(own), pa.list_(pa.int32())), own.column("brought")], names=names)
                b = b.filter(brought.is_null())
            bundles.append(b.select(["block", "row", "key", "own", "more"]))
        events = pa.Table.from_batches(bundles).combine_chunks() if bundles else None
        if not events:
            return
        bundles.clear()
        blocks, row, keys, own, more = [c.chunk(0) for c in events.columns]
        bundle = np.repeat(np.arange(len(blocks)), row.value_lengths().to_numpy())
        blocks, row, keys, own, more = blocks.to_numpy(), row.flatten().to_numpy().view(np.uint16), keys.flatten().to_numpy(), own.flatten().to_numpy().astype(np.int32), more.flatten().to_numpy()
        times, large = np.ones(len(own), np.int32), own < 0
        times[large], own[large] = more[::2], more[1::2]
        order = np.argsort(keys)
        new = _changes(keys[order])
        sizes = np.diff(new, append=len(order))
        of_row = _changes(bundle, row)  # rows ascend in a bundle
        for m, counted in enumerate((_COUNTED, _COUNTED + _TARGET)):
            mine = np.where((row & counted) == counted, times, 0)[order].astype(np.int64)
            # A row that the models were counted from is scored without what it brought.
            n = np.repeat(np.add.reduceat(mine, new), sizes) - mine
            met = np.flatnonzero((n > 0) & ((row[order] & _SCORED) > 0))
            n, at = n[met], order[met]
            word = np.searchsorted(key_starts, keys[at].view(np.uint64) >> np.uint64(32), side="right") - 1
            less = (row[at] & counted) == counted
            alone = BACKOFF * (single[m, np.minimum(word, rest)] - own[at] * less / total[m])
            context = word > rest
            alone[context] = BACKOFF
            units = np.zeros(len(keys), np.int64)
            units[at] = (_units(n + alone) - _units(alone)) * np.where(context, -1, 1) * times[at]
            sums = np.add.reduceat(units, of_row)
            some = (sums + (1 << 30)) % (1 << 31) - (1 << 30)
            for kind, values in ((m, some), (m + _LARGE, (sums - some) >> 31)):
                there = np.flatnonzero(values)
                if len(there):
                    at = of_row[there]
                    starts = _changes(bundle[at])
                    ends = np.append(starts, len(at))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(blocks[bundle[at[starts]]]), pa.array(np.full(len(starts), kind, np.int32)), _lists(ends, (row[at] >> 3).astype(np.int16), pa.int16()),
                        _lists(ends, values[there].astype(np.int32), pa.int32()), pa.nulls(len(starts), pa.list_(pa.int64())),
                    ], names=names)

    return run


def _summed(whole: bool):
    """All shares of blocks to (k, [t1, t2,] n_tokens, ce_target, ce_background) of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        brought: dict[int, tuple[np.ndarray, pa.Array]] = {}
        for b in batches:
            rows, units, own = b.column("row"), b.column("units"), b.column("brought")
            for i, (block, kind) in enumerate(zip(b.column("block").to_pylist(), b.column("kind").to_pylist())):
                row = rows[i].values.to_numpy()
                if kind == _BROUGHT:
                    brought[block] = row, own[i].values
                else:
                    if block not in sums:
                        sums[block] = np.zeros((2, _ROWS), np.int64)
                    sums[block][kind % _LARGE, row] += units[i].values.to_numpy().astype(np.int64) << (31 * (kind >= _LARGE))
        for block, (row, values) in brought.items():
            k = len(row)
            background, target, pairs = values[: 3 * k].to_numpy().reshape(3, k)
            if block in sums:
                background, target = background + sums[block][0, row], target + sums[block][1, row]
            known_by = [values[i * k : (i + 1) * k] for i in range(3, 6 if whole else 4)]
            yield pa.RecordBatch.from_arrays([*known_by, pa.array(pairs - 1), *[pa.array(-x * UNIT / pairs) for x in (target, background)]], names=["k", *(["t1", "t2"] if whole else []), "n_tokens", "ce_target", "ce_background"])

    return run


def _scores(rows: DataFrame, model: PairModel, whole: bool) -> DataFrame:
    """(k, [t1, t2,] n_tokens, ce_target, ce_background) of each scored row."""
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-int(model.total[0]) // PART_TOKENS))
    common = np.append(model.before[0] > PART_TOKENS // 2, False)
    held = spark.sparkContext.broadcast((_vocabulary(model.numbers), model.single, model.total, model.before, model.frequent, common, whole, parts))
    dealt = rows.mapInArrow(_events(held), _BUNDLE).repartitionById(parts, F.col("part"))
    shares = dealt.mapInArrow(_shares(spark.sparkContext.broadcast((model.single, model.total, model.before))), _SHARE)
    known_by = "k long, " + "t1 long, t2 long, " * whole
    return shares.repartition(max(least, parts // 4), "block").mapInArrow(_summed(whole), known_by + "n_tokens long, ce_target double, ce_background double")


def score_keys(df: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """(key, ``n_tokens``, ``ce_target``, ``ce_background``, ``ce_difference``) of every row of ``df``.

    Cross-entropies are nats a token, the end of the text counted as one; the
    difference is target less background: the lower, the more the text is like
    the target and unlike the corpus. A pair of words has the probability
    (n(a, b) + BACKOFF p(b)) / (n(a) + BACKOFF).

    A row that the models were counted from (``df`` is what ``train`` got) is
    scored without what it brought itself: its own pairs and contexts are taken
    out of n, its own uses of a word of the vocabulary out of p(b), in the
    target only if it is of the target. The number that p is divided by, and the
    share of a word outside the vocabulary, stay those of all rows. A row of any
    other table is scored by all that was counted.

    All pairs but those of two frequent words are brought together once by a
    hash of the pair, where the models' texts and the scored ones meet: there
    they are counted, and each text gets its share back, summed in the task, if
    any other row has its pairs. A task holds the pairs of its partition.

    A null or empty text is the boundary alone (0 tokens); very long texts are
    scored whole; repeated rows get the same score; an empty table gives no rows.
    """
    session(df)
    if df is model.docs:
        rows = model.rows.withColumn("flags", F.col("flags") + F.lit(_SCORED))
    else:
        rows = model.rows.unionByName(_rows(df, model.key, text, F.lit(_SCORED)))
    return _scores(rows, model, False).withColumnRenamed("k", model.key).withColumn("ce_difference", F.col("ce_target") - F.col("ce_background"))


def score(df: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """Every row of ``df`` with the scores of ``score_keys``; columns named like a result are replaced."""
    session(df)
    key = model.key
    rows = model.rows.withColumn("flags", F.col("flags") + F.lit(_SCORED)) if df is model.docs else model.rows.unionByName(_rows(df, key, text, F.lit(_SCORED)))
    results = ("n_tokens", "ce_target", "ce_background")
    # Rows with one key and text have one score.
    scores = _scores(rows, model, True).groupBy("t1", "t2", "k").agg(*[F.max(c).alias(f"r{i}") for i, c in enumerate(results)])
    own = [c for c in df.columns if c.lower() not in (*results, "ce_difference")]
    named = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)], F.col(f"`{key}`").cast("long").alias("own_k"), text_of(text).alias("text"))
    named = with_text_hashes(named, "text").drop("text").withColumnsRenamed({"t1": "own_t1", "t2": "own_t2"})
    same = (F.col("t1") == F.col("own_t1")) & (F.col("t2") == F.col("own_t2")) & F.col("k").eqNullSafe(F.col("own_k"))
    return named.join(scores, same).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)], *[F.col(f"r{i}").alias(c) for i, c in enumerate(results)], (F.col("r1") - F.col("r2")).alias("ce_difference"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is the documents that ``labels`` calls good; the background is all documents; none is scored by its own words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_keys(docs, train(docs, table(spark, sf_dir, "labels").where("quality = 1")))


QUERIES = {"op7_lm_scoring": op7_lm_scoring}
ORACLES: dict[str, str] = {}
