"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut by bytes as well as by rows, so that a run of very
#: long texts doesn't make one huge batch.
ARROW_BATCH_BYTES = "16m"
#: A bit set is made in chunks of so many bits.
_CHUNK_BITS = 17
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def session(df: DataFrame) -> SparkSession:
    """The DataFrame's session, with Arrow batches bounded in bytes unless the user set a bound."""
    spark = df.sparkSession
    if not spark.conf.isModifiable(_BATCH) or spark.conf.get(_BATCH) != _BATCH_DEFAULT:
        return spark
    spark.conf.set(_BATCH, ARROW_BATCH_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session (tests) that has none gets a temporary one; on a
    cluster each executor would write to its own disk, which is an error.
    """
    held = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_feedloom_dir", None)
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        held = "file://" + tempfile.mkdtemp(prefix="feedloom-")
        spark._feedloom_dir = held
    return held.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read back.

    Cuts the lineage: a lost executor costs only the tasks it ran, and the
    rows (with any generated ids in them) stay as they were first made.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/feedloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes tables made by ``written`` that nothing reads any more: what came of them is written itself."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def bit_set(spark: SparkSession, bit: DataFrame, bits: int) -> Broadcast:
    """A bit set of 2^bits bits with those of ``bit`` (column ``bit``): made in chunks on the executors, 2^bits / 8 bytes in all."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            at = np.unique(b.column(0).to_numpy())
            parts, starts = np.unique(at >> _CHUNK_BITS, return_index=True)
            for part, own in zip(parts, np.split(at & ((1 << _CHUNK_BITS) - 1), starts[1:])):
                row = held.setdefault(int(part), np.zeros(1 << (_CHUNK_BITS - 3), np.uint8))
                np.bitwise_or.at(row, own >> 3, (1 << (own & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([r.tobytes() for r in held.values()], pa.binary())], names=["part", "bits"])

    out = np.zeros(1 << (bits - 3), np.uint8).reshape(-1, 1 << (_CHUNK_BITS - 3))
    # All bits of a chunk lie in one task: each chunk comes to the driver once.
    dealt = bit.select("bit").repartition(F.shiftright("bit", _CHUNK_BITS))
    for r in dealt.mapInArrow(chunk, "part long, bits binary").collect():
        out[r["part"]] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


def bit_of(hashed: Column, bits: int) -> Column:
    """The bit of a 64-bit hash in a bit set of 2^bits bits."""
    return F.shiftrightunsigned(hashed, 64 - bits)


def has_bit(at: np.ndarray, held: Broadcast) -> np.ndarray:
    """Whether each bit is set."""
    bits = np.frombuffer(held.value, np.uint8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def where_set(df: DataFrame, bit: Column, held: Broadcast) -> DataFrame:
    """The rows of ``df`` whose bit is set: all that the set was made of, and few others, for an exact join after it.

    Rows that surely meet nothing needn't be shuffled to find that out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = b.num_columns - 1
            yield pa.RecordBatch.from_arrays(b.columns[:last], names=b.schema.names[:last]).filter(pa.array(has_bit(b.column(last).to_numpy(), held)))

    return df.select("*", bit.alias("_bit")).mapInArrow(run, df.schema)


_model: dict[str, object] = {}
T = TypeVar("T")


def held_model(name: str, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept in the Python worker until a model of another name is asked for.

    Workers live on: without this they would hold the models of every query, or stage, that they have run.
    """
    if name not in _model:
        _model.clear()  # before the next one is made, so that there are never two
        _model[name] = make()
    return _model[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def is_train(key: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, mod 3, is not 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % 3 != 1


def mapped(df: DataFrame, inputs: list[Column], run, results: str) -> DataFrame:
    """Every row of ``df`` with the ``results`` ("name type, ...") that ``run`` (of Arrow batches) puts in the place of ``inputs``.

    ``run`` gets the columns of ``df`` by position, whatever their names, and
    the inputs after them. Columns named like a result are replaced.
    """
    made = [r.split(" ", 1)[0] for r in re.split(r", (?=\w+ \w)", results)]
    names = [c for c in df.columns if c.lower() not in made]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], *[x.alias(f"i{i}") for i, x in enumerate(inputs)])
    held = "".join(f"c{i} {rows.schema[i].dataType.simpleString()}, " for i in range(len(names)))
    return rows.mapInArrow(run, held + results).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *made)


def most_frequent(counts: DataFrame, key: str, n: str, k: int) -> DataFrame:
    """The ``k`` rows of largest ``n``, ties in order of ``key``.

    A histogram of the counts' logarithms first gives a bound that about ``k``
    rows pass; only these are sorted, so that neither a task nor the driver
    gets ``k`` rows from every partition. ``counts`` should be persisted.
    """
    level = F.floor(F.log2(F.col(n).cast("double")) * 16)
    lowest, above = 0, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -(r["level"] or 0)):
        lowest, above = r["level"] or 0, above + r["count"]
        if above >= k:
            break
    return counts.where(level >= lowest).orderBy(F.desc(n), key).limit(k)


def join_hot(rows: DataFrame, facts: DataFrame, by: str, total: int, part: float = 0.001) -> DataFrame:
    """``rows`` with the one row of ``facts`` that has their key ``by``.

    ``facts`` says in ``n`` how many rows have the key. The facts of keys that
    more than ``part`` of all ``total`` rows have, fewer than 1 / ``part`` of
    them, are broadcast, so that no task gets all rows of such a key.
    """
    hot = facts.where(F.col("n") > total * part).drop("n")
    cold = rows.join(F.broadcast(hot.select(by)), by, "left_anti").join(facts.where(F.col("n") <= total * part).drop("n"), by)
    return cold.unionByName(rows.join(F.broadcast(hot), by))
