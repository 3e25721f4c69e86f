"""Near-duplicates by SetSketch registers, confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bit_of, bit_set, dropped, join_hot, session, table, text_of, where_set, written
from .components import components

#: Registers: BANDS x BAND_ROWS of them, each the least of an exponential
#: variable over the set, kept as the truncated logarithm to base BASE.
BANDS, BAND_ROWS, BASE = 25, 5, 1.02
REGISTERS = BANDS * BAND_ROWS
_SHIFT, _BITS = 250, 11  # registers lie in 0 to 2^11 - 1
#: In so many rounds at most components of one bucket are compared with so many
#: documents of its largest each; what stays apart then goes through the prefix filter.
ROUNDS, TRIES = 2, 4
#: Bits that leave out what shares no bucket before it is shuffled: 4 MB, whatever the corpus.
MET_BITS = 25
#: A pair is left out before the exact check only if its registers are e^20
#: times less likely at the threshold, or above, than at their best.
UNLIKELY = 20.0

_WORDS_KEPT = 150_000
_CHUNK = 4096
_rng = np.random.default_rng(20240607)
_FACTORS = (_rng.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)).reshape(-1, 1)
_ADDENDS = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint32).reshape(-1, 1)


class _WordHashes(dict):
    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


@lru_cache(maxsize=2)
def _hashes(seed: int) -> _WordHashes:
    return _WordHashes(seed)


def words(text: str) -> list[bytes]:
    """Words between spaces (and 9 to 13), with A-Z lower-cased: what bytes' methods do."""
    return text.encode().lower().split()


def shingle_set(text: str, k: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(k))))


def shingle_hashes(text: str, k: int, seed: int = 0) -> np.ndarray:
    """The set's 64-bit hashes, sorted."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes(seed).__getitem__, w), np.uint64, len(w))
    n = max(1, len(w) - k + 1)
    with np.errstate(over="ignore"):
        x = np.full(n, len(w) if len(w) < k else k, np.uint64)
        for i in range(min(k, len(w))):
            x = (x ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return np.unique(x)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes; those of a union are the larger of each."""
    x = (hashes >> np.uint64(16)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for at in range(0, len(x), _CHUNK):
        np.minimum(least, (_FACTORS * x[at : at + _CHUNK] + _ADDENDS).min(axis=1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)) + _SHIFT, 0, 2**_BITS - 1).astype(np.int16)


def bands(regs: np.ndarray) -> np.ndarray:
    """Each band's registers, whole, and its number, in one integer."""
    out = np.arange(BANDS, dtype=np.int64)
    for column in regs.reshape(BANDS, BAND_ROWS).T:
        out = (out << _BITS) | column
    return out


def likely(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a similarity of ``threshold`` or more isn't out of the question, pair by pair.

    The joint likelihood of how many registers are larger on one side, on the
    other, and equal, given both sizes (Ertl 2021), over a grid of similarities.
    """
    above, below = (regs_a > regs_b).sum(axis=1), (regs_a < regs_b).sum(axis=1)
    equal = regs_a.shape[1] - above - below
    u = (n_a / (n_a + n_b)).reshape(-1, 1)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101).reshape(1, -1)
    j = np.minimum(grid, most) * (1 - 1e-9)
    p = lambda x: -np.log(1 - x * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    with np.errstate(divide="ignore"):
        log = lambda x: np.log(np.maximum(x, 1e-12))
        ll = above.reshape(-1, 1) * log(up) + below.reshape(-1, 1) * log(down) + equal.reshape(-1, 1) * log(1 - up - down)
    enough = np.where(j >= threshold - 0.01, ll, -np.inf).max(axis=1)
    return (most.ravel() >= threshold - 1e-9) & (enough >= ll.max(axis=1) - UNLIKELY)


def _sketch(k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                n, h1, h2, regs, band = [], [], [], [], []
                for text in b.column(3).to_pylist():
                    x = shingle_hashes(text, k, seed)
                    d = xxhash.xxh3_128_digest(x.tobytes())
                    r = registers(x)
                    n.append(len(x))
                    h1.append(int.from_bytes(d[:8], "big", signed=True))
                    h2.append(int.from_bytes(d[8:], "big", signed=True))
                    regs.append(r.tobytes())
                    band.append(bands(r))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(regs, pa.binary()), pa.array(band, pa.list_(pa.int64()))],
                    names=["doc", "t1", "t2", "n", "h1", "h2", "regs", "bands"],
                )

    return run


def _sizes(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(shingle_hashes(t, k)) for t in b.column(0).to_pylist()], pa.int64())], names=["n"])

    return run


def _keep_likely(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, c = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.int16).reshape(b.num_rows, -1) for i in (3, 5))
            keep = likely(a, c, b.column(2).to_numpy().astype(float), b.column(4).to_numpy().astype(float), threshold)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _shingles(k: int):
    """(rep, n, component, text) to one row a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = [shingle_hashes(t, k).view(np.int64) for t in b.column(3).to_pylist()]
                n = [len(x) for x in sets]
                yield pa.RecordBatch.from_arrays([*[pa.array(np.repeat(b.column(i).to_numpy(), n)) for i in range(3)], pa.array(np.concatenate(sets))], names=["rep", "n", "component", "shingle"])

    return run


#: Rows of a shingle's list that are compared all with all; longer lists are met by size.
SHORT = 64
_LIST = "shingle long, rep long, n long, component long, left long, main long"


def _size_range(t: int):
    """Rows of _LIST to one row for each node of the binary tree over sizes that makes up the sizes which the row's partners can have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, left = b.column(2).to_numpy(), b.column(4).to_numpy()
            # Of similar sets the smaller has t percent of the larger; and the overlap, no
            # more than what is left, is t / (100 + t) of both sizes.
            low, high = -(-n * t // 100), np.minimum(n * 100 // t, left * (100 + t) // t - n) + 1
            at, nodes, level = [], [], 0
            rows = np.flatnonzero(low < high)
            low, high = low[rows], high[rows]
            while len(rows):
                for odd, node in ((low & 1 == 1, low), (high & 1 == 1, high - 1)):
                    at.append(rows[odd])
                    nodes.append((level << 48) | node[odd])
                low, high, level = (low + 1) >> 1, high >> 1, level + 1
                more = low < high
                rows, low, high = rows[more], low[more], high[more]
            yield _with_nodes(b, at, nodes)

    return run


def _size_nodes(t: int):
    """Rows of _LIST to one row for each node over their own size that a range of ``_size_range`` can use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy()
            # The widest range that holds n is that of the largest partner, n / t.
            widest = n * (100.0 / t) * (100.0 / t - t / 100.0) + 2
            at, nodes = [], []
            for level in range(int(np.log2(widest.max(initial=2))) + 1):
                rows = np.flatnonzero(widest >= 1 << level)
                at.append(rows)
                nodes.append((level << 48) | (n[rows] >> level))
            yield _with_nodes(b, at, nodes)

    return run


def _with_nodes(b: pa.RecordBatch, at: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(at) if at else np.empty(0, np.int64)
    made = b.take(pa.array(every))
    return pa.RecordBatch.from_arrays([*made.columns, pa.array(np.concatenate(nodes) if nodes else every, pa.int64())], names=[*b.schema.names, "node"])


def long_lists(rows: DataFrame, t: int) -> tuple[DataFrame, DataFrame]:
    """The two sides of a join by shingle and ``node`` that meets a row with the rows of sizes it can be similar to, each once.

    Where very many documents share a passage, and are too unlike beside it, no
    size fits, and none of them meet; otherwise their number would be squared.
    """
    columns = [c.split(" ")[0] for c in _LIST.split(", ")]
    named = rows.select(*columns)
    return named.where("component <> main").mapInArrow(_size_range(t), f"{_LIST}, node long"), named.mapInArrow(_size_nodes(t), f"{_LIST}, node long")


def _confirm(k: int, percent: int):
    """Rows (a, chunk, b, text), in order, a's own text first: the pairs that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first = None, set()
        for b in batches:
            found_a, found_b = [], []
            for a, chunk, other, text in zip(*(c.to_pylist() for c in b.columns)):
                if other is None:
                    if own != (a, chunk):
                        own, first = (a, chunk), shingle_set(text, k)
                    continue
                second = shingle_set(text, k)
                common = len(first & second)
                if own == (a, chunk) and 100 * common >= percent * (len(first) + len(second) - common):
                    found_a.append(a)
                    found_b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return run


class _Search:
    """The sketches, sets and texts of documents, and the links found so far.

    Rows are told apart by their key and two hashes of their text (``t1``,
    ``t2``), so that rows of one key may have different texts. Rows with one and
    the same set of shingles are one node, ``rep``.
    """

    def __init__(self, df: DataFrame, key: str, text: str, k: int, percent: int):
        self.k, self.percent = k, percent
        self.docs = with_text_hashes(df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("doc"), text_of(text).alias("text")), "text")
        self.of = df.sparkSession.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))  # of nodes with links
        # Two different sets are similar enough only if they are large enough.
        self.least = next(n for n in range(1, 10_000) if 100 * n >= percent * (n + 1))
        seed = 0
        while not self._read(seed):
            seed += 1

    def _read(self, seed: int) -> bool:
        """Sketches, sets, buckets and texts; False if two sets share a digest under this seed (not seen yet)."""
        docs, k = self.docs, self.k
        sketched = docs.select("doc", "t1", "t2", "text").mapInArrow(_sketch(k, seed), "doc long, t1 long, t2 long, n long, h1 long, h2 long, regs binary, bands array<long>")
        self.sketches = written(sketched, "sketches")
        equal = self.sketches.where("n > 0").groupBy("h1", "h2").agg(
            F.min(F.struct("doc", "t1", "t2", "n", "regs", "bands")).alias("s"), *[f(t).alias(f.__name__ + t) for f in (F.min, F.max) for t in ("t1", "t2")]
        )
        several = (F.col("mint1") < F.col("maxt1")) | (F.col("mint2") < F.col("maxt2"))
        self.sets = written(equal.select(F.monotonically_increasing_id().alias("rep"), "h1", "h2", "s.*", several.alias("several")), "sets")
        entries = self.sets.where(F.col("n") >= self.least).select("rep", "n", F.explode("bands").alias("band"))
        buckets = written(entries.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        # Joins on a bucket or a shingle that very many rows share are split by
        # the adaptive skew join; small sides Spark broadcasts by their written size.
        self.members = written(self._meeting(entries, buckets, ["band"]).join(buckets.drop("size"), "band"), "members")
        rows = ["doc", "t1", "t2"]
        self.met = written(self.sets.join(self.members.select("rep").distinct(), "rep", "left_semi").select("rep", *rows, "n", "regs"), "met")
        involved = self.met.select("rep", *rows)
        # Texts of one set, where they differ, each with a node of its own below 0.
        twins = self.sketches.select("h1", "h2", *rows).join(self.sets.where("several").select("h1", "h2", "rep", F.col("t1").alias("r1"), F.col("t2").alias("r2")), ["h1", "h2"])
        twins = twins.where("t1 <> r1 OR t2 <> r2").groupBy("rep", "t1", "t2").agg(F.min("doc").alias("doc"))
        twins = written(twins.select("rep", (-1 - F.monotonically_increasing_id()).alias("twin"), *rows), "twins")
        heads = self.sets.where("several").select("rep", *rows)
        wanted = written(involved.unionByName(heads).distinct().unionByName(twins.select(F.col("twin").alias("rep"), *rows)), "wanted")
        # Only texts that are compared travel, and these at any size, so that their bytes grow as the rows do.
        found = written(self._meeting(docs, wanted, rows).join(wanted.hint("merge"), rows).select("rep", "text"), "wanted-texts")
        self.texts = written(found.distinct(), "texts")
        n = twins.count()
        return not n or self._confirmed(twins.select(F.col("rep").alias("a"), F.col("twin").alias("b")), 100).count() == n

    def _meeting(self, df: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
        """The rows of ``df`` that may have a partner in ``other``: few without one are left."""
        bit = bit_of(F.xxhash64(*by), MET_BITS)
        return where_set(df, bit, bit_set(df.sparkSession, other.select(bit.alias("bit")), MET_BITS))

    def _confirmed(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Those of the pairs (a, b) whose whole sets are similar enough."""
        # A document with very many partners is sent once to each chunk of them.
        kept = written(pairs.repartition("a", "b").withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), 33)), "pairs")
        sent = kept.select("a", "chunk", F.col("a").alias("rep"), F.lit(None).cast("long").alias("b")).distinct().unionByName(kept.select("a", "chunk", F.col("b").alias("rep"), "b"))
        rows = sent.join(self.texts, "rep").select("a", "chunk", "b", "text")
        sorted_ = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
        links = written(sorted_.mapInArrow(_confirm(self.k, percent), "a long, b long"), "links")
        dropped(kept)
        return links

    def link(self, pairs: DataFrame) -> int:
        """Joins the components of those pairs (a, b) that are links; their number. Very frequent documents stand in ``a``."""
        pairs = written(pairs, "candidates")
        sizes = self.met.select("rep", "n", "regs")
        side = lambda s: sizes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
        of_a = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(side("a"), "a")
        total = pairs.count()
        if not total:
            return 0
        both = join_hot(pairs, of_a, "a", total).join(side("b"), "b").select("a", "b", "n_a", "regs_a", "n_b", "regs_b")
        both = both.where((F.col("n_a") * 100 >= F.col("n_b") * self.percent) & (F.col("n_b") * 100 >= F.col("n_a") * self.percent))
        new = self._confirmed(both.mapInArrow(_keep_likely(self.percent / 100), "a long, b long"), self.percent)
        found = new.count()
        if found:
            self.merge(new)
        dropped(pairs, new)
        return found

    def merge(self, links: DataFrame) -> None:
        """Adds links between nodes: the components that they join become one."""
        for end in ("a", "b"):
            links = links.join(self.of.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        stars = components(links)
        step = written(stars, "step")
        dropped(stars)
        fresh = step.join(self.of, "node", "left_anti")
        moved = self.of.join(step.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
        before, self.of = self.of, written(moved.select("node", F.coalesce("into", "component").alias("component")).unionByName(fresh), "components")
        dropped(step, before)

    def placed(self, rows: DataFrame, compared: bool) -> DataFrame:
        """Those ``rows`` of buckets that hold several components, with component and the bucket's largest one (``main``).

        After a bucket's components have been ``compared``, one with two
        documents has nothing left to compare.
        """
        rows = rows.select("band", "rep", "n").join(self.of.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", "n", F.coalesce("component", "rep").alias("component"))
        placed = written(rows, "placed")
        made = written(_mixed(placed, "band", 3 if compared else 2), "mixed")
        dropped(placed)
        return made

    def run(self) -> None:
        # First each document with the one document that heads most of its buckets.
        heads = self.members.where("hub < rep").groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("times"))
        best = heads.groupBy("rep").agg(F.max(F.struct("times", (-F.col("hub")).alias("hub"))).alias("s"))
        self.link(best.select((-F.col("s.hub")).alias("a"), F.col("rep").alias("b")))
        # Then, in each bucket, one document of every component with some of the
        # largest, others in each round, until a round joins nothing.
        rows = self.placed(self.members, False)
        for round_ in range(ROUNDS):
            found = not rows.isEmpty() and self.link(_tries(rows, round_))
            before, rows = rows, self.placed(rows, True)
            dropped(before)
            if not found:
                break
        if not rows.isEmpty():
            self.link(self.rest_pairs(rows))

    def rest_pairs(self, rows: DataFrame) -> DataFrame:
        """All pairs that can still be links between components.

        Looked at are the documents of buckets that hold several. An overlap
        must be t / (1 + t) of both sizes together; put both sets in one order,
        rarest shingles first, then the first shingle that they share has at
        least that many from it on in either (prefix filter). A shingle that
        one document alone has is in no overlap, and comes before all others.
        Documents that stay apart although they share buckets mostly do so for
        shingles of their own, and give no pairs.
        """
        t = self.percent
        apart = rows.groupBy("rep").agg(F.first("n").alias("n"), F.first("component").alias("component"))
        texts = self.texts.join(apart, "rep").select("rep", "n", "component", "text")
        each = written(texts.mapInArrow(_shingles(self.k), "rep long, n long, component long, shingle long"), "shingles")
        often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
        shared = each.join(written(often, "shingle-counts"), "shingle")
        of_set = Window.partitionBy("rep")
        # ``left``: shingles from this one on, in order; those of its own come first.
        left = F.count(F.lit(1)).over(of_set) - F.row_number().over(of_set.orderBy("times", "shingle")) + 1
        rarest = shared.withColumn("left", left).where(F.col("left") * 100 >= F.col("n") * t)
        rarest = written(_mixed(written(rarest.select("shingle", "rep", "n", "component", "left"), "rarest"), "shingle", 2), "rarest-mixed")
        x, y = rarest.where("component <> main").alias("x"), rarest.alias("y")
        near = (F.col("x.n") * 100 >= F.col("y.n") * t) & (F.col("y.n") * 100 >= F.col("x.n") * t)
        enough = F.least("x.left", "y.left") * (100 + t) >= (F.col("x.n") + F.col("y.n")) * t
        # Neither pairs inside a component, nor a pair of outsiders twice.
        once = (F.col("y.component") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))
        fits = (F.col("x.component") != F.col("y.component")) & near & enough & once
        few = F.col("size") <= SHORT
        pairs = x.where(few).join(y.where(few), (F.col("x.shingle") == F.col("y.shingle")) & fits)
        xs, ys = long_lists(rarest.where(~few), t)
        more = xs.alias("x").join(ys.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") == F.col("y.node")) & fits)
        ends = [F.col("x.rep").alias("a"), F.col("y.rep").alias("b")]
        return pairs.select(*ends).unionByName(more.select(*ends)).distinct()

    def rows(self) -> DataFrame:
        """(doc, t1, t2, n, component) of every row: the component is that of its set (null without shingles)."""
        sets = self.sets.select("h1", "h2", "rep").join(self.of.withColumnRenamed("node", "rep"), "rep", "left")
        sets = written(sets.select("h1", "h2", F.coalesce("component", "rep").alias("component")), "set-components")
        return self.sketches.select("doc", "t1", "t2", "n", "h1", "h2").join(sets, ["h1", "h2"], "left").drop("h1", "h2")


def with_text_hashes(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``t1`` and ``t2``, two hashes of the text: rows of one key with other texts are other rows."""
    return df.withColumn("t1", F.xxhash64(text_of(text))).withColumn("t2", F.xxhash64(F.lit(1), text_of(text)))


def _mixed(rows: DataFrame, by: str, least: int) -> DataFrame:
    """The rows of groups that hold several components and ``least`` rows, with the group's largest component as ``main`` and its ``size``."""
    counts = rows.groupBy(by, "component").agg(F.count(F.lit(1)).alias("times"))
    mixed = counts.groupBy(by).agg(F.max(F.struct("times", "component")).alias("s"), F.count(F.lit(1)).alias("several"), F.sum("times").alias("size"))
    return rows.join(mixed.where((F.col("several") > 1) & (F.col("size") >= least)).select(by, F.col("s.component").alias("main"), "size"), by)


def _tries(rows: DataFrame, round_: int) -> DataFrame:
    """(a, b): in each bucket one document of every component (b) with TRIES documents of the largest (a).

    They are drawn as the largest numbers after a change of bits, another one in each round.
    """
    masks = [F.lit(xxhash.xxh3_64_intdigest(f"{round_} {k}") >> 1) for k in range(TRIES)]
    drawn = lambda m: F.max(F.col("rep").bitwiseXOR(m)).bitwiseXOR(m)
    tops = rows.where("component = main").groupBy("band").agg(*[drawn(m).alias(f"top{k}") for k, m in enumerate(masks)])
    tops = tops.select("band", F.explode(F.array_distinct(F.array(*[f"top{k}" for k in range(TRIES)]))).alias("a"))
    others = rows.where("component <> main").groupBy("band", "component").agg(drawn(masks[0]).alias("b"))
    return others.join(tops, "band").select("a", "b").distinct()


def _links_of_keys(rows: DataFrame) -> DataFrame | None:
    """Links (a, b) between the components of keys that have rows in several, or None."""
    several = written(rows.groupBy("doc").agg(F.min("component").alias("a"), F.max("component").alias("last")).where("a < last"), "several")
    if not several.limit(1).count():
        return None
    return rows.join(several.select("doc", "a"), "doc").select("a", F.col("component").alias("b")).where("a <> b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept): documents linked at a Jaccard similarity of ``percent`` / 100 or more.

    Sets are the distinct ``k``-word shingles of whole texts (of fewer words,
    the one sequence). Candidates share a band of SetSketch registers; a link
    that just meets the threshold is missed with a chance of (1 - 0.85^5)^25 =
    4e-7. Pairs are weighed by the registers' joint likelihood, then confirmed
    on whole sets of words, as are different texts whose sets have one digest.
    No bucket gives all its pairs: documents are first compared with one other,
    then components with some documents of the bucket's largest; those that
    stay apart, through their rarest shingles.

    ``component_id`` is the smallest key reachable by links; its rows are
    ``kept``. Null and empty texts have no shingles and no links. Rows with a
    null key take no part: their sets have a size, their component is null and
    they are kept. Rows with one key are one node, whose links are those of all
    its texts. An empty table gives no rows; other columns are not looked at.
    """
    session(df)
    search = _Search(df, key, text, k, percent)
    search.run()
    rows = written(search.rows(), "row-components")
    links = _links_of_keys(rows)
    if links is not None:
        joined = components(links).select(F.col("node").alias("component"), F.col("component").alias("into"))
        rows = rows.join(written(joined, "key-components"), "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into")
        # A key's rows without shingles go with its others.
        own = rows.groupBy("doc").agg(F.max("component").alias("own"), F.min(F.coalesce("component", F.lit(-1))).alias("none")).where("own >= 0 AND none < 0").select("doc", "own")
        rows = rows.join(written(own, "keys-with-empty-rows"), "doc", "left").withColumn("component", F.coalesce("component", "own")).drop("own")
    first = written(rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc").alias("first")), "first-keys")
    named = rows.join(first, "component", "left")
    component: Column = F.coalesce("first", "doc")
    out = named.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc") == component).alias("kept"))
    void = df.where(F.col(f"`{key}`").isNull()).select(text_of(text).alias("text")).mapInArrow(_sizes(k), "n long")
    return out.unionByName(void.select(F.lit(None).cast("long").alias(key), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` without near-duplicates of a row with a smaller key: links are those of ``near_duplicates``.

    A row is known by its key and its text. Of rows that links join, the one
    with the smallest key stays (of one key's texts, the one whose hash is
    smallest); rows with the same key and text stay together. Rows without
    shingles and rows with a null key stay. An empty table gives no rows.
    """
    session(df)
    search = _Search(df, key, text, k, percent)
    search.run()
    rows = written(search.rows().where("component IS NOT NULL").drop("n"), "row-components")
    first = rows.groupBy("component").agg(F.min(F.struct("doc", "t1", "t2")).alias("f"), F.count(F.lit(1)).alias("size")).where("size > 1")
    named = rows.join(written(first.select("component", "f"), "first-rows"), "component")
    gone = written(named.where("doc <> f.doc OR t1 <> f.t1 OR t2 <> f.t2").select("doc", "t1", "t2").distinct(), "gone")
    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)], F.col(f"`{key}`").cast("long").alias("doc"), text_of(text).alias("text"))
    kept = with_text_hashes(own, "text").drop("text").join(gone, ["doc", "t1", "t2"], "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * c >= 85 * (n - c)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT t.b, r.c FROM r JOIN t ON r.doc_id = t.a)
SELECT s.doc_id, len(s.g) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""

QUERIES = {"op4_near_dedup": op4_near_dedup}
ORACLES = {"op4_near_dedup": ORACLE}
