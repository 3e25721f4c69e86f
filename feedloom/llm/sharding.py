"""Shuffled sharding: a Feistel permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import session, table, text_of, written
from .near_dedup import with_text_hashes

#: Keys of the Feistel rounds come from this seed.
SEED = 2024
ROUNDS = 6

_LOCAL_BITS = 33  # monotonically_increasing_id: partition << 33 | row in partition


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finalizer (splitmix64), as the round function."""
    with np.errstate(over="ignore"):
        z = x + np.uint64(key)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def round_keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), seed)]


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The places of row ``numbers`` (0 to n - 1) in a seeded permutation of 0 to n - 1.

    A balanced Feistel network permutes 0 to 4^b - 1, the least such power
    that is n or more; numbers that it takes outside are sent through it again
    until they fall inside (cycle walking; under four turns on average).
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    keys = round_keys(seed)
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        x = (left << shift) | right
        out[todo] = x
        todo = todo[x >= np.uint64(n)]
    return out.astype(np.int64)


def global_rows(df: DataFrame, order: list[str], partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``row_no``, 0 to n - 1 in the order of the columns, and n.

    Rows are sorted by range, written, and numbered by a prefix sum over the
    partitions' counts: no task sees more than its own range. Rows that are
    equal in all of ``order`` are split between ranges and get any of their
    numbers. The result does not depend on the input's partitions.
    """
    spark = session(df)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("x_tie", F.monotonically_increasing_id())
    by = [*order, "x_tie"]
    ranged = tied.repartitionByRange(n_parts, *by).sortWithinPartitions(*by).drop("x_tie")
    placed = written(ranged.withColumn("x_at", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("x_at", _LOCAL_BITS)
    # One number a partition comes to the driver, not one a row.
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())
    starts, n = [], 0
    for p, c in counts:
        starts.append((p, n))
        n += c
    offsets = spark.createDataFrame(starts, T.StructType([T.StructField("x_part", T.LongType()), T.StructField("x_start", T.LongType())]))
    numbered = placed.withColumn("x_part", part).join(F.broadcast(offsets), "x_part", "left")
    row = F.col("x_start") + F.col("x_at").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return numbered.withColumn("row_no", row).drop("x_part", "x_start", "x_at"), n


def shard(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(key, size, text_crc32, row_no, position, shard, slot) for every row.

    Law ``rows``: shard counts differ by one at most. ``position`` is the row's
    place in the shuffled order; shard = position mod shards, slot = position
    div shards, so any place can be computed from the row number alone, and
    slots of a shard have no gaps. Rows are numbered by key, then size and
    checksum; the result is the same for any partitioning of the input.

    Size is the text's UTF-8 bytes plus 8. A null text has no bytes (checksum
    0); null keys come first; repeated rows get different places; an empty
    table gives no rows. Other input columns are not looked at.
    """
    rows = df.select(
        F.col(f"`{key}`").alias("x_key"),
        (F.octet_length(text_of(text)) + 8).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
    )
    numbered, n = global_rows(rows, ["x_key", "size", "text_crc32"])

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    placed = numbered.withColumn("position", place("row_no"))
    return placed.select(
        F.col("x_key").alias(key), "size", "text_crc32", "row_no", "position",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"),
    )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their partition, and the sum of the last column over the partition's rows before each."""
    part, total = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.column(b.num_columns - 1).to_numpy()
        after = total + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(n), part)), pa.array(after - n)], names=[*b.schema.names, "x_part", "before"])
        total = int(after[-1]) if len(n) else total


def _running(groups: DataFrame, by: str) -> tuple[DataFrame, int]:
    """``groups`` (first, place, n) with ``before``, the sum of n over those with a smaller ``by``, and the sum over all."""
    spark = groups.sparkSession
    ranged = groups.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), by).sortWithinPartitions(by)
    summed = written(ranged.mapInArrow(_sums, "t1 long, t2 long, first long, place long, n long, x_part long, before long"), "groups")
    starts, total = [], 0
    for part, n in sorted((r[0], r[1]) for r in summed.groupBy("x_part").agg(F.sum("n")).collect()):
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "x_part long, x_start long")
    return summed.join(F.broadcast(offsets), "x_part").withColumn("before", F.col("before") + F.col("x_start")).drop("x_part", "x_start"), total


def shard_groups(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(key, size, text_crc32, shard, slot) for every row: law ``rows``, and rows with equal texts lie in one shard.

    Rows are numbered in order of two hashes of the text, then of the key. A
    group's place is its first row's in the Feistel permutation of all numbers;
    groups of several rows, in order of place, are cut into runs of about equal
    rows, one a shard. All other rows are permuted among themselves and fill
    the shards up to counts that differ by one at most; slots are permuted
    within each shard. The result is the same for any partitioning of the input.

    Both can't always be had: rows of a group for which its shard has no place
    left are dealt like single ones. Only the last group of a shard can be so,
    and only if it has more rows than there are single ones for a shard: a group
    that is larger than a shard is always split.

    Null texts count as empty, with size 8 and checksum 0; null keys come first
    in a group; repeated rows get different slots; an empty table gives no rows.
    Other input columns are not looked at.
    """
    own = df.select(F.col(f"`{key}`").alias("x_key"), text_of(text).alias("x_text"))
    rows = with_text_hashes(own, "x_text").select("t1", "t2", "x_key", (F.octet_length("x_text") + 8).cast("long").alias("size"), F.crc32(F.col("x_text").cast("binary")).alias("text_crc32"))
    numbered, n = global_rows(rows, ["t1", "t2", "x_key", "size", "text_crc32"])

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    groups = numbered.groupBy("t1", "t2").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups, several = _running(groups.select("t1", "t2", "first", place("first").alias("place"), "n"), "place")
    groups = groups.withColumn("shard", F.expr(f"CAST(before * {shards}L DIV {max(several, 1)}L AS INT)")).drop("place")

    # One row a shard: where its run of groups begins, the rows it gets, and those its groups take.
    base, used = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
    counts = np.array([n // shards + (s < n % shards) for s in range(shards)], np.int64)
    for s, first, end in groups.groupBy("shard").agg(F.min("before"), F.max(F.col("before") + F.col("n"))).collect():
        base[s], used[s] = first, min(end - first, counts[s])
    free = np.concatenate([[0], np.cumsum(counts - used)])
    runs = df.sparkSession.createDataFrame(pd.DataFrame({"shard": np.arange(shards, dtype=np.int32), "base": base, "most": counts}))

    found = numbered.join(groups.drop("n").join(F.broadcast(runs), "shard"), ["t1", "t2"], "left")
    at = F.col("before") - F.col("base") + F.col("row_no") - F.col("first")
    found = written(found.select("x_key", "size", "text_crc32", "row_no", "shard", F.when(at < F.col("most"), at).alias("at")), "grouped")
    loose, n_loose = global_rows(found.where("at IS NULL").select("x_key", "size", "text_crc32", F.col("row_no").alias("x_row")), ["x_row"])

    @F.pandas_udf("shard int, at long")
    def fill(row: pd.Series) -> pd.DataFrame:
        p = permute(row.to_numpy(), n_loose, seed)
        s = np.searchsorted(free, p, side="right") - 1
        return pd.DataFrame({"shard": s.astype(np.int32), "at": used[s] + p - free[s]})

    @F.pandas_udf("long")
    def slot(shard: pd.Series, at: pd.Series) -> pd.Series:
        most, raw = counts[shard.to_numpy()], at.to_numpy()
        out = np.zeros(len(raw), np.int64)
        for m in np.unique(most):
            out[most == m] = permute(raw[most == m], int(m), seed)
        return pd.Series(out)

    filled = loose.withColumn("f", fill("row_no")).select("x_key", "size", "text_crc32", "f.shard", "f.at")
    every = found.where("at IS NOT NULL").select("x_key", "size", "text_crc32", "shard", "at").unionByName(filled)
    return every.select(F.col("x_key").alias(key), "size", "text_crc32", "shard", slot("shard", "at").alias("slot"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_groups(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op9_sharding": op9_sharding}
ORACLES: dict[str, str] = {}
