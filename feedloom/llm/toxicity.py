"""Toxicity scores from texts restored through a noisy channel."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_of, bit_set, dropped, has_bit, held_model, is_train, mapped, most_frequent, session, table, text_of, written

#: Bounds of what is remembered of all labelled rows: so many words and word
#: beginnings; the character model has the most frequent words.
MAX_FEATURES = 5_000
MODEL_WORDS = 20_000
#: A feature counts when so large a part of the texts with it is toxic, of so many
#: texts at least; of all that count this part may be due to chance.
LEAST_SURE, LEAST_TEXTS, CHANCE = 0.85, 3, 0.02
#: Bits that leave out rows without a label: 16 MB, whatever the corpus.
LABEL_BITS = 27
#: Lengths of word beginnings that are learned besides whole words.
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7

#: The channel: what a sign may stand for, and the cost (in nats) of each change.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
COST_SIGN, COST_SKIP, COST_SHORTER, COST_BREAK = 0.5, 0.7, 0.3, 2.0

#: Letters of an n-gram of the character model; what stands before a word.
ORDER = 5
START = "^" * (ORDER - 1)

_PLAIN_ENDS = ".,;:?\"'[]{}<>()*%&#-_/\\=~^`«»„“”…"
_LAST_SIGNS = re.compile(r"(?:([!|$+@])\1+|!)$")
_TRIPLE = re.compile(r"(.)\1\1")
_RUN = re.compile(r"(.)\1+")
#: A row of single letters stands between white space or punctuation; what follows an apostrophe in a word is none.
_SPACED = re.compile(r"(?<![^\W_])(?<![^\W_]['’])(?:[^\W_]|[@$!|])(?:[ .\-_*]+(?:[^\W_]|[@$!|])){2,}(?![^\W_])")
_CLASSES = str.maketrans({**{c: x[0] for c, x in LEET.items()}, "l": "i", "£": "i"})
#: A word is known, and so not noise, when so many clean texts have it.
KNOWN_IN = 3
_CACHE = 200_000
_FLUSH = 300_000


@dataclass
class CharModel:
    """Interpolated character n-grams (up to ORDER letters) over words; costs in nats."""

    counts: dict[str, float] = field(default_factory=dict)
    known: dict[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, words: Iterable[tuple[str, float]]) -> CharModel:
        counts: Counter = Counter()
        for word, weight in words:
            marked = START + word + "$"
            for k in range(len(START), len(marked)):
                for n in range(ORDER):
                    context = marked[k - n : k]
                    counts[context + marked[k]] += weight
                    counts[context + "\0"] += weight
        return cls(dict(counts))

    def cost(self, context: str, char: str) -> float:
        at = context + char
        made = self.known.get(at)
        if made is None:
            c, p = self.counts, 1 / 500
            for n in range(ORDER):
                ctx = context[len(context) - n :]
                p = (c.get(ctx + char, 0) + 2 * p) / (c.get(ctx + "\0", 0) + 2)
            if len(self.known) > _CACHE:
                self.known.clear()
            made = self.known[at] = -math.log(p)
        return made


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each sign, or run of one sign, of the token: what it may have been, and at what cost.

    A letter stays; a sign that looks like letters becomes one of them or goes;
    other signs (separators) go; a run of one letter may be any shorter; a space
    between single letters goes, or ends a word.
    """
    out = []
    k, low = 0, token.lower()
    while k < len(low):
        c = low[k]
        run = 1
        while k + run < len(low) and low[k + run] == c:
            run += 1
        if c.isalpha():
            # Up to two of a letter are told apart; a word has no more.
            out.append([(c * n, COST_SHORTER * (min(run, 3) - n)) for n in range(1, min(run, 2) + 1)])
        elif c in LEET:
            for _ in range(min(run, 2)):
                out.append([(x, COST_SIGN) for x in LEET[c]] + [("", COST_SKIP + COST_SIGN)])
        elif c == " ":
            out.append([("", 0.0), (" ", COST_BREAK)])
        else:
            out.append([("", COST_SKIP)])
        k += run
    return out


def restore(token: str, chars: CharModel) -> str:
    """The likeliest word, or words, behind ``token``: Viterbi over its lattice, states being the last letters, as many as the model looks back."""
    states: dict[str, tuple[float, tuple | None]] = {START: (0.0, None)}
    for choices in lattice(token):
        reached: dict[str, tuple[float, tuple | None]] = {}
        for context, (cost, path) in states.items():
            for letters, own in choices:
                ctx, total = context, cost + own
                for x in letters:
                    total += chars.cost(ctx, "$" if x == " " else x)
                    ctx = START if x == " " else ctx[1:] + x
                if ctx not in reached or total < reached[ctx][0]:
                    reached[ctx] = (total, (path, letters) if letters else path)
        states = reached
    _, path = min((cost + chars.cost(ctx, "$"), k) for k, (ctx, (cost, _)) in enumerate(states.items()))
    node, parts = list(states.values())[path][1], []
    while node:
        node, letters = node[0], node[1]
        parts.append(letters)
    return "".join(reversed(parts))


def core_of(token: str) -> str:
    """The token in lower case, without punctuation at its ends."""
    return _LAST_SIGNS.sub("", token.strip(_PLAIN_ENDS)).rstrip(_PLAIN_ENDS).lower()


def obscured(core: str) -> bool:
    """Whether a token holds signs among letters, or a letter three times in a row."""
    return (not core.isalpha() and any(map(str.isalpha, core))) or _TRIPLE.search(core) is not None


def outline(core: str) -> str:
    """What the channel leaves of a word: classes of letters that one sign may stand for, runs as one, nothing else."""
    return _RUN.sub(r"\1", "".join(filter(str.isalpha, core.translate(_CLASSES))))


def beginnings(word: str) -> list[str]:
    return [word[:n] + "*" for n in PREFIXES if len(word) >= n]


@dataclass
class ToxicModel:
    prior: float
    sure: dict[str, float]  # how surely a text with this word, or beginning, is toxic
    chars: CharModel
    known: frozenset[str] = frozenset()  # words of clean texts
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer(dict):
    """(restored word, how sure, outline) by token; remembers what it has met."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.whole = {outline(w) for w in model.sure if not w.endswith("*")}
        self.starts = {w[:k] for w in self.whole for k in range(1, len(w) + 1)}
        self.begun = {outline(w) for w in model.sure if w.endswith("*")}
        self.lengths = sorted({len(w) for w in self.begun})

    def _sure(self, word: str) -> float:
        """Of the word where it is known, else of its surest beginning."""
        get = self.model.sure.get
        return get(word) or (max([get(f, 0.0) for f in beginnings(word)], default=0.0) if self.begun else 0.0)

    def _restored(self, token: str, core: str, made: tuple[str, float], sure_of) -> tuple[str, float]:
        # A sign at the end may be a letter, or punctuation: both are tried.
        for t in dict.fromkeys((core, token)):
            for word in restore(t, self.model.chars).split():
                if (sure := sure_of(word)) > made[1]:
                    made = (word, sure)
        return made

    def __missing__(self, token: str) -> tuple[str, float, str]:
        core = token.lower() if token.isalpha() else core_of(token)
        made = (core, self._sure(core))
        if core.isalpha():
            shape = _RUN.sub(r"\1", core.replace("l", "i"))
            # Only letters met twice can be other than they are. What is
            # restored keeps the outline, so that others need no decoding.
            if not made[1] and _RUN.search(core) and (core not in self.model.known or _TRIPLE.search(core)):
                signs = len(token) > len(core) and any(map(LEET.__contains__, token))
                if signs or shape in self.whole or any(shape[:n] in self.begun for n in self.lengths):
                    made = self._restored(token, core, made, self._sure)
        else:
            shape = outline(core)
            # Numbers are read as whole words only.
            if not made[1] and (" " in core or any(map(str.isalpha, core))):
                made = self._restored(token, core, made, self._sure)
            elif not made[1] and not any(map(str.isalpha, token)) and outline(token.lower()) in self.whole:
                made = self._restored(token, core, made, lambda w: self.model.sure.get(w, 0.0))
        if len(self) > _CACHE:
            self.clear()
        self[token] = found = (*made, shape)
        return found

    def cut(self, tokens: list[str], outlines: list[str]) -> Iterator[tuple[str, str, float]]:
        """Words that white space was put into: neighbouring tokens that together have a marked word's outline, but aren't all words."""
        for first, start in enumerate(outlines):
            if start not in self.starts or start in self.whole:
                continue
            made = start
            for last in range(first + 1, len(tokens)):
                made = _RUN.sub(r"\1", made + outlines[last])
                if made not in self.starts or outlines[last] in self.whole:
                    break
                if made in self.whole and outlines[last]:
                    pieces = list(map(core_of, tokens[first : last + 1]))
                    joined = "".join(pieces)
                    if any(map(str.isalpha, joined)) and not all(x in self.model.known for x in pieces):
                        for word in restore(joined, self.model.chars).split():
                            if sure := self.model.sure.get(word):
                                yield " ".join(tokens[first : last + 1]), word, sure

    def score(self, text: str) -> tuple[float, list[tuple[str, str, float]]]:
        """The chance that the text is toxic, and its evidence: (token, restored, how sure)."""
        tokens = text.split()
        found = list(map(self.__getitem__, tokens))
        spaced = [(m, re.sub(r"[ .\-_*]+", " ", m)) for m in _SPACED.findall(text)]
        hits = list(dict.fromkeys((t, word, sure) for t, (word, sure, _) in zip(tokens, found) if sure))
        hits += [(m, word, sure) for m, (word, sure, _) in ((m, self[t]) for m, t in dict(spaced).items()) if sure]
        hits += dict.fromkeys(self.cut(tokens, [shape for _, _, shape in found]))
        clean, seen = 1.0 - self.model.prior, set()
        for _, word, sure in hits:
            if word not in seen:
                seen.add(word)
                clean *= 1.0 - sure
        return 1.0 - clean, sorted(hits)


def _learn_rows(labelled: Broadcast):
    """(k, bit, text) to (k, words, sketch) of rows whose bit is set: the words of a text, each once, and the least hash of three words in a row, alike for copies of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(has_bit(b.column(1).to_numpy(), labelled)))
            words, sketches = [], []
            for text in b.column(2).to_pylist():
                w = text.split()
                words.append(" ".join({c for t in set(w) if (c := core_of(t)).isalpha()}))
                sketches.append(min((xxhash.xxh3_64_intdigest(" ".join(w[k : k + 3])) for k in range(max(1, len(w) - 2))), default=0) - 2**63)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.string()), pa.array(sketches, pa.int64())], names=["k", "words", "sketch"])

    return run


def _labelled_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(words, toxic, sketch) of every row of ``docs`` that has a label.

    Texts stay where they are read: a bit set of fixed size leaves out rows that
    surely have no label, and of the others only their words go to their labels.
    """
    spark = session(docs)
    own = docs.select(F.col(f"`{key}`").alias("k"), text_of(text).alias("text"))
    bit = bit_of(F.xxhash64("k"), LABEL_BITS).alias("bit")
    # Keys of one type have one hash; a label whose key can't be of the documents' type has none.
    of_type = F.col(f"`{key}`").try_cast(own.schema["k"].dataType).alias("k")
    known = labels.where(F.col(f"`{label}`").isNotNull()).select(of_type, F.col(f"`{label}`").cast("int").alias("toxic")).where("k IS NOT NULL").groupBy("k").agg(F.max("toxic").alias("toxic"))
    labelled = bit_set(spark, known.select(bit), LABEL_BITS)
    kind = own.schema["k"].dataType.simpleString()
    said = own.select("k", bit, "text").mapInArrow(_learn_rows(labelled), f"k {kind}, words string, sketch long")
    # Words are shuffled at any size, so that their bytes grow as the rows do.
    return said.join(known.hint("merge"), "k").select("words", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"), "sketch")


def _count(of):
    """(words, toxic, sketch) to (f, sketch, clean): features ``of`` words in clean texts with their number, in toxic ones with each sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean: Counter = Counter()
        toxic: set[tuple[str, int]] = set()

        def flush() -> pa.RecordBatch:
            marked = list(toxic)
            f = [*clean, *(m[0] for m in marked)]
            n = [*clean.values(), *[0] * len(marked)]
            out = pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array([None] * len(clean) + [m[1] for m in marked], pa.int64()), pa.array(n, pa.int64())], names=["f", "sketch", "clean"])
            clean.clear()
            toxic.clear()
            return out

        for b in batches:
            for words, is_toxic, sketch in zip(*(c.to_pylist() for c in b.columns)):
                found = {f for w in words.split() for f in of(w)}
                if is_toxic:
                    toxic.update((f, sketch) for f in found)
                else:
                    clean.update(found)
                if len(clean) + len(toxic) > _FLUSH:
                    yield flush()
        yield flush()

    return run


def _sure(counts: DataFrame, clean: int, toxic: int) -> list:
    """The features that mark toxic texts: (f, toxic, sure), at most MAX_FEATURES.

    Among those taken chance may have made the part CHANCE (Benjamini and
    Hochberg 1995): the more features are marked, the less evidence each needs,
    so that a language with few toxic texts has its words learned as well.
    """
    # How large a part of a feature's texts is toxic, as it is, and as if there
    # were as many toxic texts as clean ones.
    part = (F.col("toxic") + 0.1) / (F.col("toxic") + F.col("clean") + 0.6)
    even = F.col("toxic") / max(toxic, 1)
    even = even / (even + (F.col("clean") + 0.5) / max(clean, 1))
    # Evidence, in nats, that its texts aren't spread as all texts are.
    prior = min(max(toxic / max(toxic + clean, 1), 1e-6), 1 - 1e-6)
    n = F.col("toxic") + F.col("clean")
    nats = F.col("toxic") * F.log(F.col("toxic") / n / prior) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - prior))).otherwise(0.0)
    tested = counts.where(n >= LEAST_TEXTS).count()
    likely = counts.where((n >= LEAST_TEXTS) & (F.col("toxic") > 0)).withColumn("sure", F.least(part, even)).withColumn("tenths", F.floor(nats * 10)).where(F.col("sure") >= LEAST_SURE)
    above, bound = 0, math.inf
    for r in sorted(likely.groupBy("tenths").count().collect(), key=lambda r: -r["tenths"]):
        above += r["count"]
        if r["tenths"] / 10 >= math.log(tested / (CHANCE * above)):
            bound = r["tenths"]
    return most_frequent(likely.where(F.col("tenths") >= F.lit(float(bound))), "f", "toxic", MAX_FEATURES).collect()


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicModel:
    """Words, and beginnings of words, that mark toxic texts; and the character model.

    Counted in Spark over all labelled rows. Toxic texts with one sketch
    (copies) count once for a feature. Ids with a null label
    aren't learned from; of an id labelled more than once the largest counts.
    """
    once = written(_labelled_rows(docs, labels, key, text, label), "labelled")
    try:
        sizes = {r[0]: r[1] for r in once.groupBy("toxic").agg(F.countDistinct("sketch")).collect()}
        clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
        counted = lambda of: once.mapInArrow(_count(of), "f string, sketch long, clean long").groupBy("f", "sketch").agg(F.sum("clean").alias("clean")).groupBy("f").agg(F.sum("clean").alias("clean"), F.count("sketch").alias("toxic")).persist()
        by_word = counted(lambda w: (w,))
        best = _sure(by_word, clean, toxic)
        frequent = most_frequent(by_word.select("f", (F.col("clean") + F.col("toxic")).alias("n"), "clean"), "f", "n", MODEL_WORDS).collect()
        by_word.unpersist()
        # Beginnings are for words that aren't known: those that are say nothing about them.
        known = {r["f"] for r in best}
        by_start = counted(lambda w: () if w in known else beginnings(w))
        starts = _sure(by_start, clean, toxic)
        by_start.unpersist()
    finally:
        dropped(once)
    weights = {r["f"]: math.log1p(r["n"]) for r in frequent}
    top = max(weights.values(), default=1.0)
    weights |= {r["f"]: 20 * top for r in best}  # words that it must find behind the noise
    return ToxicModel(0.5 * toxic / max(toxic + clean, 1), {r["f"]: float(r["sure"]) for r in best + starts}, CharModel.of(weights.items()), frozenset(r["f"] for r in frequent if r["clean"] >= KNOWN_IN))


_EVIDENCE = pa.list_(pa.struct([("token", pa.string()), ("restored", pa.string()), ("sure", pa.float64())]))


def _score(held, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held_model(name, lambda: Scorer(held.value)).score
        for b in batches:
            last = b.num_columns - 1
            made = [score(t or "") for t in b.column(last).to_pylist()]
            evidence = pa.array([[dict(zip(("token", "restored", "sure"), h)) for h in hits] for _, hits in made], _EVIDENCE)
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array([s for s, _ in made], pa.float64()), evidence], names=[*b.schema.names[:last], "toxicity", "evidence"])

    return run


def score(df: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """Every row of ``df`` with ``toxicity`` (0 to 1) and ``evidence`` (token, restored, sure).

    Tokens with signs inside or of signs alone, letters three in a row (two,
    where the word isn't known), rows of single letters, and neighbouring
    tokens that make up a marked word are restored by Viterbi; words and their beginnings are then
    looked up, and their chances combined as independent.

    Null and empty texts get the prior, without evidence; very long texts are
    read whole; input columns named like a result are replaced; repeated rows
    get the same score; an empty table gives no rows.
    """
    spark = session(df)
    held = spark.sparkContext.broadcast(model)
    return mapped(df, [F.col(f"`{text}`").cast("string")], _score(held, model.name), "toxicity double, evidence array<struct<token: string, restored: string, sure: double>>")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(is_train(F.col("doc_id"))))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (~is_train(F.col("doc_id"))).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLES: dict[str, str] = {}
