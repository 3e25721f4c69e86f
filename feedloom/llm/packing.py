"""Harmonic packing of token sequences."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_model, session, table, text_of, written

#: Remainders up to this many tokens are left in one piece.
WHOLE_BELOW = 32

_LEFT_OVER = 1 << 62
_SCHEMA = "doc_id long, start long, length int, token_ids binary, doc_tokens long, class int, part int, bin long, at int, offset int"


def byte_bpe(path: str):
    """The byte-level BPE vocabulary at ``path`` (tokenizers' JSON, or ranks) as a fast encoder.

    tiktoken with the same ranks gives the ids of the tokenizers library, four
    times as fast; tests hold them against it. Its added tokens are those of
    the JSON; ``encode_whole`` finds them in a text, as the library does.
    """
    import public_tokenizers
    import tiktoken

    def made() -> tiktoken.Encoding:
        ranks_file = path.removesuffix(".json").removesuffix(".tiktoken") + ".tiktoken"
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path))

    return held_model(f"byte_bpe {path}", made)


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the vocabulary at ``path``, with their ids."""
    with open(path.removesuffix(".tiktoken").removesuffix(".json") + ".json") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that take white space, or stand alone, are not supported")
    return {t["content"]: t["id"] for t in added}


def encode_whole(path: str):
    """Text to ids, as the tokenizers library gives them with add_special_tokens=False: strings of added tokens are these tokens."""
    made = byte_bpe(path)
    return lambda text: made.encode(text, allowed_special="all")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` tokens.

    Class j holds pieces of capacity // j tokens, so that j of them fill a bin.
    Whole bins come first; what remains gives, again and again, its largest
    piece of a class; a remainder of WHOLE_BELOW or less stays one piece, in
    the class of as many as fit.
    """
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest > WHOLE_BELOW:
        j = -(-capacity // rest)
        out.append((capacity // j, j))
        rest -= capacity // j
    if rest:
        out.append((rest, capacity // rest))
    return out


def first_fit(pieces: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each length, longest first as given."""
    used: list[int] = []
    out = []
    for length in pieces:
        k = next((k for k, u in enumerate(used) if u + length <= capacity), len(used))
        if k == len(used):
            used.append(0)
        out.append((k, used[k]))
        used[k] += length
    return out


def _fill(capacity: int, path: str, end_id: int):
    """Encodes, cuts and fills bins class by class in one partition, alone.

    Held back are only the pieces of each class's open bin: less than
    ``capacity`` tokens a class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_whole(path)
        part = TaskContext.get().partitionId()
        open_bins: dict[tuple[int, int], list[list]] = {}
        made = 0
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("token_ids", pa.binary()), ("doc_tokens", pa.int64()), ("class", pa.int32()), ("part", pa.int32()), ("bin", pa.int64()), ("at", pa.int32()), ("offset", pa.int32())])

        def batch(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        out: list[list] = []
        held = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py())
                ids.append(end_id)
                raw = np.array(ids, dtype="<u4").tobytes()
                start = 0
                for length, j in cut(len(ids), capacity):
                    row = [doc, start, length, raw[4 * start : 4 * (start + length)], len(ids), j, part, None, None, None]
                    start += length
                    mates = open_bins.setdefault((j, length), [])
                    mates.append(row)
                    if len(mates) == j:
                        for k, r in enumerate(mates):
                            r[7], r[9] = made, k * length
                        made += 1
                        out += mates
                        open_bins[j, length] = []
                held += len(raw)
                if held > 4 << 20:
                    if out:
                        yield batch(out)
                    out, held = [], 0
        for mates in open_bins.values():
            for k, r in enumerate(mates):
                r[8] = k
            out += mates
        if out:
            yield batch(out)

    return run


def pack(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packs every document into sequences of at most ``capacity`` tokens.

    One row a piece: (key, start, length, token_ids as little-endian unsigned
    32-bit bytes, doc_tokens, sequence_id, offset). A document is its ids and
    ``end_id``. Documents are cut into lengths of the reciprocal classes
    capacity // j, and j pieces of class j make a sequence: each task fills
    bins from its own documents. What it can't complete (less than one bin a
    class) is numbered over all tasks by prefix sums and filled the same way;
    the last open bin of each class, a number of pieces that depends on
    ``capacity`` alone, is filled first-fit.

    A null text is empty and gives one piece (the end id); an empty table gives
    no rows; repeated rows are packed as often as they come; null keys are kept.
    Other columns are not looked at.
    """
    spark = session(df)
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    pieces = written(docs.mapInArrow(_fill(capacity, tokenizer, end_id), _SCHEMA), "pieces")

    full = pieces.where(F.col("bin").isNotNull()).withColumn("sequence_id", F.shiftleft(F.col("part").cast("long"), 32) + F.col("bin")).drop("at")

    left = pieces.where(F.col("bin").isNull()).drop("offset")
    counts = left.groupBy("class", "length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.expr("sum(n) OVER (PARTITION BY class, length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    numbered = left.join(before.drop("n"), ["class", "length", "part"]).withColumn("g", F.coalesce("before", F.lit(0)) + F.col("at"))

    totals = sorted(((r["length"], r["class"], r["n"]) for r in counts.groupBy("class", "length").agg(F.sum("n").alias("n")).collect()), reverse=True)
    tail = [(j, length, n - n % j + k) for length, j, n in totals for k in range(n % j)]
    bins = first_fit([length for _, length, _ in tail], capacity)
    kinds = pa.schema([("class", pa.int32()), ("length", pa.int32()), ("g", pa.int64()), ("tail_bin", pa.int64()), ("tail_offset", pa.int32())])
    last = spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, (*p, *b))) for p, b in zip(tail, bins)], kinds))
    # The bins of each class and length are numbered after those of the tail, and after one another.
    first, firsts = len({b for b, _ in bins}), []
    for length, j, n in totals:
        firsts.append({"class": j, "length": length, "first": first})
        first += n // j
    firsts = spark.createDataFrame(pa.Table.from_pylist(firsts, pa.schema([("class", pa.int32()), ("length", pa.int32()), ("first", pa.int64())])))
    rest = numbered.join(F.broadcast(firsts), ["class", "length"]).join(F.broadcast(last), ["class", "length", "g"], "left")
    rest = rest.withColumn("sequence_id", F.lit(_LEFT_OVER) + F.coalesce(F.col("tail_bin"), F.col("first") + F.floor(F.col("g") / F.col("class"))))
    rest = rest.withColumn("offset", F.coalesce(F.col("tail_offset"), (F.col("g") % F.col("class") * F.col("length")).cast("int")))

    out = [F.col("doc_id").alias(key), "start", F.col("length").cast("long").alias("length"), "token_ids", "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset")]
    return full.select(*out).unionByName(rest.select(*out))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
