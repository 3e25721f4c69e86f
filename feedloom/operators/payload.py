"""Exact neighbours by way of the published int8 vectors: integer products with a bound, then what it leaves."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import dot, l2_normalize, quantize
from ..llm.common import session
from ..sources.tables import materialize, vector_payload
from .neighbours import DECIMALS

LEVELS = 127
#: Vectors of a block, and queries, and components of them, that one task holds.
BLOCK, QUERIES_TOGETHER, _COMPONENTS = 2048, 65_536, 1 << 23
#: Queries multiplied with a block at a time, components of pairs looked at exactly at a time, and pairs kept until then.
_SLICE, _EXACT, _PAIRS = 512, 1 << 20, 1 << 17
#: Where one in so many of a slice's pairs reaches its bar, all are made exactly by one product.
_DENSE = 16
#: Tasks for each core, where there are blocks enough.
_TASKS = 3
#: Cosines equal after rounding may differ so much; and what sums in doubles may be off.
_SLACK = 2 * 10.0**-DECIMALS


def published(df: DataFrame, item: str = "id", vector: str = "vec") -> DataFrame:
    """(id, payload, rest) of vectors: int8 components of the normal vector times 127 as base64, and the length of what rounding lost.

    Ids are integers that tell rows apart. Rows without a vector are left out.
    """
    normal = df.where(F.size(vector) > 0).select(F.col(item).cast("long").alias("id"), l2_normalize(F.col(vector)).alias("v"))
    rows = normal.withColumn("q", quantize(F.col("v"), LEVELS))
    lost = F.zip_with("v", "q", lambda x, q: x - q.cast("double") / LEVELS)
    return rows.select("id", vector_payload(F.col("q")).alias("payload"), F.sqrt(dot(lost, lost)).alias("rest"))


def _blocks(payload: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, ids, vectors, rests, normals) of about BLOCK rows each, in order of id, the number of blocks, and that of components; the vectors ``v`` one after another, if there are any."""
    normal = F.col("v") if "v" in payload.columns else F.array().cast("array<float>")
    held = materialize(payload.select("id", F.unbase64("payload").alias("q"), "rest", normal.alias("v")))
    rows, dim = held.agg(F.count(F.lit(1)), F.max(F.octet_length("q"))).first()
    n = max(1, -(-rows // BLOCK))
    # By row, not by id: no block grows with an id that comes often.
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).alias("block")
    dealt = held.select(block, "id", "q", "rest", "v").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("id", "q", "rest", "v"))).alias("rows"))
    return materialize(dealt.select("block", F.col("rows.id").alias("ids"), F.col("rows.q").alias("vectors"), F.col("rows.rest").alias("rests"), F.flatten("rows.v").alias("normals"))), n, dim or 1


class _Vectors:
    """Rows of a block, or of many: ids, int8 components, what rounding lost, lengths of what it left, and the vectors themselves with their norms."""

    def __init__(self, *columns: np.ndarray):
        self.columns = columns
        self.ids, self.q, self.rests, self.lengths, self.v, self.norms = columns

    @classmethod
    def loaded(cls, b: pa.RecordBatch, row: int) -> _Vectors:
        ids, vectors, rests, normals = (b.column(c)[row].values for c in range(3, 7))
        q = np.frombuffer(b"".join(vectors.to_pylist()), np.int8).reshape(len(ids), -1)
        v = normals.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        norms = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        lengths = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) / LEVELS
        return cls(ids.to_numpy(), q, rests.to_numpy(), lengths, v, np.where(norms > 0, norms, 1.0))

    @classmethod
    def of(cls, parts: list[_Vectors]) -> _Vectors:
        return cls(*(np.concatenate(c) for c in zip(*(p.columns for p in parts))))

    def part(self, rows: slice) -> _Vectors:
        return _Vectors(*(c[rows] for c in self.columns))

    def factors(self) -> np.ndarray:
        """For items: whose products with ``asking`` are the bounds."""
        return np.column_stack([self.q.astype(np.float32) / LEVELS, self.lengths, self.rests]).astype(np.float32)

    def asking(self, sign: int) -> np.ndarray:
        """For queries: a = q/127 + rest, so the product of two is that of the integers, and the rests' part of it is bounded by lengths; 1 for upper bounds, -1 for lower ones."""
        return np.column_stack([self.q.astype(np.float32) / LEVELS, sign * self.rests, sign * (self.lengths + self.rests)]).astype(np.float32)


def _error(q: _Vectors, v: _Vectors, x, y) -> np.ndarray:
    return q.rests[x] * v.lengths[y] + q.lengths[x] * v.rests[y] + q.rests[x] * v.rests[y]


def _exactly(q: _Vectors, v: _Vectors, x: np.ndarray, y: np.ndarray, sign: int) -> np.ndarray:
    """In doubles, of the pairs of rows ``x`` and ``y``: cosines, or lower (sign -1) or upper (1) bounds."""
    a, b = (q.q, v.q) if sign else (q.v, v.v)
    step, out = max(1, _EXACT // max(1, a.shape[1])), np.empty(len(x))
    for at in range(0, len(x), step):
        i, j = x[at : at + step], y[at : at + step]
        product = np.einsum("ij,ij->i", a[i].astype(np.float64), b[j].astype(np.float64))
        out[at : at + step] = product / LEVELS**2 + sign * _error(q, v, i, j) if sign else product / (q.norms[i] * v.norms[j])
    return out


def _all_exactly(q: _Vectors, v: _Vectors, sign: int) -> np.ndarray:
    """The same of all pairs, a row for each query; -inf for a row and itself."""
    a, b = (q.q, v.q) if sign else (q.v, v.v)
    product = a.astype(np.float64) @ b.astype(np.float64).T
    rows, columns = np.arange(len(a))[:, None], np.arange(len(b))[None]
    out = product / LEVELS**2 + sign * _error(q, v, rows, columns) if sign else product / (q.norms[:, None] * v.norms)
    out[_own(q.ids, v.ids)] = -np.inf
    return out


def _own(asked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of one id; ``ids`` are in order."""
    first = np.searchsorted(ids, asked, "left")
    n = np.searchsorted(ids, asked, "right") - first
    return np.repeat(np.arange(len(asked)), n), np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)


def _firsts(key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each row's ``k`` largest, of equal ones the first (up to ``k`` of them that equal the last)."""
    last = np.partition(key, -k, axis=1)[:, -k, None] if key.shape[1] > k else np.full((len(key), 1), -np.inf)
    x, y = np.nonzero(key > last)
    tx, ty = np.nonzero((key == last) & (key > -np.inf))
    few = np.arange(len(tx)) - np.searchsorted(tx, tx, "left") < k
    return np.concatenate([x, tx[few]]), np.concatenate([y, ty[few]])


class _Task:
    """Queries of one task, with the best of what they have met: places (query, item) that reach a query's bar in single precision are made exactly.

    ``gives`` is what: the ``nearest``, the largest lower bounds (``lows``), or, once
    these are known, the ``pairs`` whose upper bound reaches them, or their ``counts``.
    """

    def __init__(self, queries: _Vectors, k: int, gives: str):
        self.q, self.k, self.gives = queries, k, gives
        #: Bounds that are compared, and those (or cosines, 0) that are made exactly.
        self.sign = {"nearest": 0, "lows": -1}.get(gives, 1)
        self.factors = queries.asking(self.sign or 1)
        n = len(queries.ids)
        self.value, self.item = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
        self.n = np.zeros(n, np.int64)
        # Sums of n products in any order are off by less than n roundings of the product of lengths (Cauchy-Schwarz); a factor of 2 covers the factors' own.
        self.off = (queries.lengths + queries.rests) * (queries.q.shape[1] + 8) * 2.0**-23

    def meet(self, v: _Vectors) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes a block of items; yields places of pairs, if these are asked for."""
        b, m = v.factors().T, len(v.ids)
        off = self.off * np.nanmax(v.lengths + v.rests)
        wide = -(-m // 64) * 64
        sums, reach = np.empty(_SLICE * m, np.float32), np.zeros((_SLICE, wide), bool)
        own, ids = _own(self.q.ids, v.ids)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        floor = self.value.min(axis=1) - _SLACK
        for at in range(0, len(self.q.ids), _SLICE):
            rows = slice(at, min(at + _SLICE, len(self.q.ids)))
            n = rows.stop - at
            s = np.matmul(self.factors[rows], b, out=sums[: n * m].reshape(n, m))
            mine = slice(*np.searchsorted(own, [at, rows.stop]))
            s[own[mine] - at, ids[mine]] = np.nan
            bar = floor[rows] - off[rows]
            if self.sign < 0 and m >= self.k and bar.min() == -np.inf:
                bar = np.maximum(bar, self.least(s) - 2 * off[rows])
            np.greater_equal(s, bar.astype(np.float32)[:, None], out=reach[:n, :m])
            # Most pairs don't reach their bar: 64 are looked at together, then eight.
            if self.sign <= 0 and np.count_nonzero(reach[:n]) * _DENSE > n * m:
                exact = _all_exactly(self.q.part(rows), v, self.sign)
                x, y = _firsts(self.key(np.where(np.isnan(exact), -np.inf, exact)), self.k)
                self.take(x + at, y, exact[x, y], v, floor)
                continue
            bits = np.packbits(reach[:n])
            some = np.flatnonzero(bits.view(np.uint64))
            some = (some[:, None] * 8 + np.arange(8)).ravel()
            some = some[bits[some] > 0]
            eight, one = np.nonzero(reach.reshape(-1, 8)[some])
            x, y = np.divmod(some[eight] * 8 + one, wide)
            if self.sign > 0:
                sure = s[x, y] >= (floor[rows] + off[rows]).astype(np.float32)[x]
                self.n[rows] += np.bincount(x[sure], minlength=n)
                if self.gives == "pairs":
                    yield x[sure] + at, y[sure]
                x, y = x[~sure], y[~sure]
                if len(x) * _DENSE > n * m:
                    reached = self.take(x + at, y, _all_exactly(self.q.part(rows), v, self.sign)[x, y], v, floor)
                    if self.gives == "pairs":
                        yield reached
                    continue
            kept.append((x + at, y))
            if sum(len(x) for x, _ in kept) > _PAIRS:
                yield from self.exactly(kept, v, floor)
        yield from self.exactly(kept, v, floor)

    def least(self, s: np.ndarray) -> np.ndarray:
        """The kth lower bound of a block's items, for queries that have no floor yet."""
        last = np.partition(np.where(np.isnan(s), -np.inf, s), -self.k, axis=1)[:, -self.k]
        return last - _SLACK

    def exactly(self, kept: list[tuple[np.ndarray, np.ndarray]], v: _Vectors, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes the places kept."""
        if not kept:
            return
        x, y = (np.concatenate(c) for c in zip(*kept))
        kept.clear()
        reached = self.take(x, y, _exactly(self.q, v, x, y, self.sign), v, floor)
        if self.gives == "pairs":
            yield reached

    def key(self, value: np.ndarray) -> np.ndarray:
        return np.round(value, DECIMALS) if self.gives == "nearest" else value

    def take(self, x: np.ndarray, y: np.ndarray, value: np.ndarray, v: _Vectors, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, or keeps, the pairs whose exact value reaches the floor; their places."""
        fits = (value >= floor[x]) & (value > -np.inf)
        if self.sign <= 0:
            # Of many copies of a query only those with smaller ids than its kth best go on.
            key, last = self.key(value), self.key(self.value[x, -1])
            fits &= (key > last) | ((key == last) & (v.ids[y] < self.item[x, -1]))
        x, y, value = x[fits], y[fits], value[fits]
        if self.sign > 0:
            self.n += np.bincount(x, minlength=len(self.n))
        elif len(x):
            self.keep(x, v.ids[y], value)
        return x, y

    def keep(self, x: np.ndarray, item: np.ndarray, value: np.ndarray) -> None:
        """Of the best so far and these the ``k`` of each query that come first: of equal ones those with the smaller id."""
        changed = np.unique(x)
        place = np.concatenate([np.repeat(changed, self.k), x])
        item = np.concatenate([self.item[changed].ravel(), item])
        value = np.concatenate([self.value[changed].ravel(), value])
        order = np.lexsort((item, -self.key(value), place))
        first = np.searchsorted(place[order], changed)
        best = order[first[:, None] + np.arange(self.k)]
        self.item[changed], self.value[changed] = item[best], value[best]


def _met(k: int, gives: str):
    """Rows (task, kind, block, ids, vectors, rests, normals, lows) in order: of a task the queries' blocks (kind 0), what is known of their lower bounds (1), the items' blocks (2)."""

    def made(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[c.split(" ")[0] for c in _GIVES[gives].split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, asked, task = None, {}, None

        def begun() -> _Task:
            return task or _Task(_Vectors.of([*asked.values()]), k, gives)

        def rows_of(block: int) -> slice:
            before = sum(len(asked[b].ids) for b in asked if b < block)
            return slice(before, before + len(asked[block].ids))

        def ended() -> Iterator[pa.RecordBatch]:
            if not asked:
                return
            t = begun()
            if gives == "lows":
                for b in asked:
                    yield made([b], pa.array([t.value[rows_of(b)].ravel()]))
            elif gives == "counts":
                yield made(t.q.ids[t.n > 0], t.n[t.n > 0])
            elif gives == "nearest":
                x, rank = np.nonzero(t.value > -np.inf)
                yield made(t.q.ids[x], t.item[x, rank], t.value[x, rank])

        for b in batches:
            for row, (g, kind, block) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                if g != number:
                    yield from ended()
                    number, asked, task = g, {}, None
                if kind == 0:
                    asked[block] = _Vectors.loaded(b, row)
                    continue
                if not asked:
                    continue
                task = begun()
                if kind == 1:
                    rows = rows_of(block)
                    known = np.column_stack([task.value[rows], b.column(7)[row].values.to_numpy().reshape(-1, k)])
                    task.value[rows] = np.partition(known, -k, axis=1)[:, -k:]
                    continue
                items = _Vectors.loaded(b, row)
                for x, y in task.meet(items):
                    yield made(task.q.ids[x], items.ids[y])
        yield from ended()

    return run


#: What a task's queries give.
_GIVES = {"lows": "block long, lows array<double>", "pairs": "query_id long, neighbour_id long", "counts": "query_id long, n long", "nearest": "query_id long, neighbour_id long, cosine double"}


def _searched(payload: DataFrame, queries: DataFrame, k: int, gives: str) -> DataFrame:
    """What a ``_Task`` gives of every query, ``nearest`` of all its tasks together, with their rank.

    A task has some blocks of queries and some of items. There are as many groups of queries as
    tasks can hold, or the cores need, and as many of items as the cores need then: each
    block goes to as many tasks as there are groups of the other kind. Pairs are
    decided where they are met; only blocks and results travel.
    """
    cores = session(payload).sparkContext.defaultParallelism * _TASKS
    items, n, _ = _blocks(payload)
    asked, n_asked, dim = (items, n, _) if queries is payload else _blocks(queries)
    groups = max(-(-n_asked * BLOCK // max(BLOCK, min(QUERIES_TOGETHER, _COMPONENTS // dim))), min(n_asked, math.isqrt(cores)))
    parts = min(n, -(-cores // groups))

    def pairs(gives: str, *known: DataFrame) -> DataFrame:
        def rows(df: DataFrame, kind: int, group: Column, part: Column) -> DataFrame:
            have = lambda c, of: F.col(c) if c in df.columns else F.array().cast(of).alias(c)
            columns = [have("ids", "array<long>"), have("vectors", "array<binary>"), have("rests", "array<double>"), have("normals", items.schema["normals"].dataType), have("lows", "array<double>")]
            placed = df.select("*", group.alias("x_group")).select("*", part.alias("x_part"))
            return placed.select((F.col("x_group") * parts + F.col("x_part")).cast("int").alias("task"), F.lit(kind).alias("kind"), "block", *columns)

        of = lambda n: F.pmod("block", F.lit(n))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        met = rows(asked, 0, of(groups), each(parts)).unionByName(rows(items, 2, each(groups), of(parts)))
        for df in known:
            met = met.unionByName(rows(df, 1, of(groups), each(parts)))
        return met.repartitionById(groups * parts, "task").sortWithinPartitions("task", "kind", "block").mapInArrow(_met(k, gives), _GIVES[gives])

    if gives != "nearest":
        return pairs(gives, materialize(pairs("lows")))
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("cosine", DECIMALS)), "neighbour_id")
    return pairs(gives).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def candidates(payload: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, neighbour_id) of every pair that the int8 vectors don't rule out of the query's ``k`` nearest.

    Of the product of two normal vectors the integers give all but what the
    ``rest`` lengths bound, so that a query's kth largest lower bound is a floor
    for its ``k`` nearest: pairs whose upper bound lies under it are left out.
    """
    return _searched(payload, queries, k, "pairs")


def n_candidates(payload: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, n_left): how many ``candidates`` each query has, counted where they are met."""
    return _searched(payload, queries, k, "counts").groupBy("query_id").agg(F.sum("n").alias("n_left"))


def k_nearest_published(payload: DataFrame, exact: DataFrame, queries: DataFrame | None = None, k: int = 5, item: str = "id", vector: str = "vec") -> DataFrame:
    """(query_id, rank, neighbour_id, cosine): the ``k`` nearest of all items to each of the ``queries`` (all items, if none are given).

    ``payload`` and ``queries`` are as ``published`` gives them; ``exact`` has
    the vectors themselves, from which the candidates' cosines are made: the
    result is that of ``k_nearest``, ties to the smaller id included.
    """
    # Single precision travels as it is; its norm is taken in doubles where it is met.
    single = exact.schema[vector].dataType == T.ArrayType(T.FloatType(), exact.schema[vector].dataType.containsNull)
    v = F.col(vector) if single else l2_normalize(F.col(vector)).cast("array<double>")
    normal = exact.where(F.size(vector) > 0).select(F.col(item).cast("long").alias("id"), v.alias("v"))
    items = payload.join(normal, "id")
    found = _searched(items, items if queries is None else queries.join(normal, "id"), k, "nearest")
    return found.select("query_id", "rank", "neighbour_id", "cosine")
