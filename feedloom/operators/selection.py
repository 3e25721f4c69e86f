"""Which rows stay: first ones, capped ones, interleaved ones."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import blank, brand_key, brand_keys, strip
from ..sources.tables import materialize


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("x_first", first).where("x_first = 1").drop("x_first")


def keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return keep_first(df, keys, [F.desc(c) for c in order])


def name_repeats_removed(df: DataFrame, order: Sequence[str | Column], brand: str = "brand", name: str = "name") -> DataFrame:
    """The first of the rows that share brand and name, but for case and white space at the ends."""
    return keep_first(df, [F.lower(strip(blank(F.col(brand)))), F.lower(strip(blank(F.col(name))))], order)


def effective_cap(brand: Column, per_brand: Column | int = rules.PER_BRAND) -> Column:
    per_brand = F.lit(per_brand) if isinstance(per_brand, int) else per_brand
    return F.when(brand_key(brand).isin(brand_keys(rules.MAINSTREAM_BRANDS)), F.lit(rules.MAINSTREAM_CAP)).otherwise(per_brand)


def is_excluded(brand: Column) -> Column:
    return brand_key(brand).isin(brand_keys(rules.EXCLUDED_BRANDS))


def capped(df: DataFrame, store: str, base: str, cap: Column, order: Sequence[str | Column], per_base: int = rules.VARIANTS_PER_BASE, most: int | None = None) -> DataFrame:
    """In each store at most ``per_base`` rows of a base name, then at most ``cap`` rows, in order.

    Each rank is cut by Spark's window group limit before its exchange: rows
    beyond ``per_base`` before they are dealt by base name, and, if a bound
    ``most`` of all caps is given, rows beyond it before a store meets in one task.
    """
    by_base = F.row_number().over(Window.partitionBy(store, base).orderBy(*order))
    dealt = df.withColumn("x_base", by_base).where(F.col("x_base") <= per_base)
    by_store = F.row_number().over(Window.partitionBy(store).orderBy(*order))
    ranked = dealt.withColumn("x_store", by_store)
    if most is not None:
        ranked = ranked.where(F.col("x_store") <= most)
    return ranked.where(F.col("x_store") <= cap).drop("x_base", "x_store")


def select_products(df: DataFrame, store: str = "store_order", pos: str = "pos", item: str = "id", base: str = "base", cap: str = "cap", most: int | None = None) -> DataFrame:
    """Walks stores in order and keeps what is new, within both caps.

    An id counts as taken once a row with it is *kept*, in any store before. If
    no id repeats this is ``capped``. Otherwise rows are decided round by round,
    each of which has only the rows that are open yet (see ``decided``); the
    caps and a store's rows are known by ``store`` and ``pos``.
    """
    # Rows read through the rounds, by an id that occurs twice.
    repeated = df.groupBy(item).count().where("count > 1").select(item)
    if repeated.limit(1).count() == 0:
        return capped(df, store, base, F.col(cap), [store, pos], most=most)
    df, kept = materialize(df), None
    narrow = df.select(F.col(store).alias("store"), F.col(pos).alias("pos"), F.col(item).alias("item"), F.col(base).alias("base"), F.col(cap).alias("cap"))
    for found, _ in decided(narrow, most):
        kept = found if kept is None else kept.unionByName(found)
    keys = kept.select(F.col("store").alias(store), F.col("pos").alias(pos))
    return df.join(keys, [store, pos], "left_semi")


def decided(rows: DataFrame, most: int | None = None, per_base: int = rules.VARIANTS_PER_BASE) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Round after round (rows kept for sure, rows still open) of the rows (store, pos, item, base, cap) of a selection.

    A round takes out the rows whose id an earlier row has that the round before
    kept, and applies the caps to the others. A row depends on earlier rows only:
    if the stores before the first one that this changes are as they were, they
    are so for good. Their rows, and later rows with an id that they keep, don't
    travel any further. At least one store is decided in a round, mostly many.
    """
    at = F.struct("store", "pos")
    left, kept = rows, materialize(capped(rows, "store", "base", F.col("cap"), ["pos"], per_base, most).select(*rows.columns))
    while True:
        # Of one id the first, as a minimum: rows of a frequent id don't meet in one task.
        first = kept.groupBy("item").agg(F.min(at).alias("x_taken"))
        free = left.join(first, "item", "left").where(F.col("x_taken").isNull() | (at <= F.col("x_taken"))).drop("x_taken")
        again = materialize(capped(free, "store", "base", F.col("cap"), ["pos"], per_base, most).select(*rows.columns))
        both = kept.select("store", "pos", F.lit(1).alias("x_n")).unionByName(again.select("store", "pos", F.lit(2).alias("x_n")))
        changed = both.groupBy("store", "pos").agg(F.sum("x_n").alias("x_n")).where("x_n <> 3").agg(F.min("store")).first()[0]
        if changed is None:
            yield again, left.limit(0)
            return
        sure = again.where(F.col("store") < changed)
        left = materialize(left.where(F.col("store") >= changed).join(sure.select("item"), "item", "left_anti").select(*rows.columns))
        kept = again.where(F.col("store") >= changed)
        yield sure, left


def interleave(df: DataFrame, store: str, item: str, seed: str) -> DataFrame:
    """Rows with their ``round`` and ``turn``: ordered by both, one row of every store comes before the next of any.

    A shuffle that can be repeated: rows in a store, and stores in a round, are
    in order of a seeded hash. Sort by the two only where a file needs it.
    """
    within = Window.partitionBy(store).orderBy(F.md5(F.concat(F.lit(seed), F.col(item).cast("string"))), item)
    ranked = df.withColumn("round", F.row_number().over(within))
    return ranked.withColumn("turn", F.md5(F.concat_ws("|", F.lit(seed), F.col(store).cast("string"), F.col("round").cast("string"))))


def row_numbers(df: DataFrame, *order: str) -> DataFrame:
    """Rows with their number ``row`` in this order, from 0, without sorting all of them in one task.

    Rows are dealt by ranges and written; the sizes of the ranges, one row a
    partition, give where each begins. Rows that are equal in ``order`` are
    numbered as they come, so that it should tell all rows apart.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialize(ranged.withColumns({"x_part": F.shiftright(place, 33), "x_place": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = dealt.groupBy("x_part").agg(F.count(F.lit(1)).alias("x_n"))
    before = F.coalesce(F.sum("x_n").over(Window.orderBy("x_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("x_part", before.alias("x_before"))
    return dealt.join(F.broadcast(starts), "x_part").withColumn("row", F.col("x_before") + F.col("x_place")).drop("x_part", "x_place", "x_before")


def batch_numbers(df: DataFrame, key: str, size: int = rules.PUSH_BATCH) -> DataFrame:
    """Rows with ``batch_no`` from 0: in order of a key that tells them apart, ``size`` rows to a batch, the last one less."""
    return row_numbers(df, key).withColumn("batch_no", F.floor(F.col("row") / size)).drop("row")
