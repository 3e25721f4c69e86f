"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import session, table, text_of

#: Encoded words that a worker remembers, before it starts anew.
CACHE_WORDS = 700_000
#: Texts encoded and checked together.
CHUNK = 512

_SPACE = "▁"
_SEGMENT = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")


class Pieces:
    """A merge-type vocabulary with byte fallback and identity normalization.

    ``model`` is the library's processor; only its vocabulary is used here.
    """

    def __init__(self, model):
        n = model.get_piece_size()
        self.eos = model.eos_id()
        self.cost: dict[str, float] = {}  # negative score: the agenda gives the smallest first
        self.ids: dict[str, int] = {}
        self.byte_ids = [-1] * 256
        self.raw: list[bytes] = []  # what an id is in a decoded text
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            elif model.is_unused(i):
                raise ValueError("vocabularies with unused pieces aren't supported")
            else:
                self.cost[piece] = -model.get_score(i)
                self.ids[piece] = i
                self.raw.append(piece.replace(_SPACE, " ").encode())
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte fallback")
        probe = " A½ ﬁ  é\t　x "
        if model.normalize(probe) != _SPACE + probe.replace(" ", _SPACE):
            raise ValueError("the vocabulary's normalization isn't the identity with a space before the text")
        if any(_SPACE in p.lstrip(_SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character")
        # Characters that stand side by side in no piece are never merged.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}

    def merge(self, unit: str) -> list[str]:
        """The pieces of ``unit``: adjacent symbols merged best score first, leftmost first of equal scores."""
        cost = self.cost
        symbols: list[str | None] = list(unit)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = unit[i : i + 2]
            if pair in cost:
                agenda.append((cost[pair], i, pair))
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            left, j = symbols[i], after[i]
            if left is None or j >= n or left + symbols[j] != pair:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, None
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                longer = pair + symbols[j]
                if longer in cost:
                    heappush(agenda, (cost[longer], i, longer))
            h = before[i]
            if h >= 0:
                longer = symbols[h] + pair
                if longer in cost:
                    heappush(agenda, (cost[longer], h, longer))
        return [s for s in symbols if s is not None]

    def units(self, segment: str) -> Iterator[str]:
        """``segment`` cut between characters that no piece joins."""
        joined, start = self.joined, 0
        for k in range(1, len(segment)):
            if segment[k - 1 : k + 1] not in joined:
                yield segment[start:k]
                start = k
        yield segment[start:]

    def encode_unit(self, unit: str) -> bytes:
        ids, out = self.ids, []
        for piece in self.merge(unit) if len(unit) > 1 else unit:
            if piece in ids:
                out.append(ids[piece])
            else:
                out += [self.byte_ids[b] for b in piece.encode()]
        return _pack(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: without the space put before it; bytes that aren't UTF-8 are replaced."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")


def _pack(ids: list[int]) -> bytes:
    """Ids as 32-bit integers: they are put together faster than lists, and Arrow takes them as they are."""
    return array("i", ids).tobytes()


class Encoder(dict):
    """Remembers segments' and units' ids; ``fresh`` has segments not yet checked against the library."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.fresh = pieces, []
        self.units: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        # Keys are what follows the space mark that begins every segment.
        units, parts = self.units, []
        for unit in self.pieces.units(_SPACE + segment):
            ids = units.get(unit)
            if ids is None:
                ids = units[unit] = self.pieces.encode_unit(unit)
            parts.append(ids)
        made = self[segment] = b"".join(parts)
        self.fresh.append((segment, made))
        return made

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        words = text.split(" ")
        if "" in words or _SPACE in text:  # runs of spaces stay together
            words = [s[1:] for s in _SEGMENT.findall(_SPACE + text.replace(" ", _SPACE))]
        return b"".join(map(self.__getitem__, words))

    def check(self, model) -> None:
        """Encodes the fresh segments with the library; an error if any differs."""
        if self.fresh:
            theirs = model.encode([s.replace(_SPACE, " ") for s, _ in self.fresh], num_threads=1)
            for (segment, ids), other in zip(self.fresh, theirs):
                if segment and ids != _pack(other):
                    raise ValueError(f"{segment!r} has the ids {list(array('i', ids))}; the sentencepiece library gives {other}")
            self.fresh.clear()
        if len(self) > CACHE_WORDS:
            self.clear()
        if len(self.units) > CACHE_WORDS:
            self.units.clear()


@lru_cache(maxsize=2)
def load(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, Encoder(Pieces(model))


def _encode(path: str, add_eos: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder = load(path)
        decode, end = encoder.pieces.decode, _pack([encoder.pieces.eos]) * add_eos
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                b = whole.slice(at, CHUNK)
                packed = [encoder.encode(t) + end for t in b.column(1).to_pylist()]
                encoder.check(model)
                ids = [array("i", x).tolist() for x in packed]
                texts = [decode(x) for x in ids]
                if texts != model.decode(ids):
                    raise ValueError("a decoded text differs from the sentencepiece library's")
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.frombuffer(b"".join(packed), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def encode_pieces(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", add_eos: bool = True) -> DataFrame:
    """(key, ids, decoded): every text's piece ids, and the text that they decode to.

    Texts are cut at spaces and between characters that no piece joins, and
    each unit is merged by an agenda of adjacent pairs in order of score. In
    each Arrow batch the ids of segments new to the worker, and all decoded
    texts, are compared with the sentencepiece library's; a difference fails
    the task. ``model`` is a path that every executor has.

    Null texts are empty and give the end id alone (or nothing); null keys and
    repeated rows stay as they are; an empty table gives no rows; one very long
    word costs n log n. Other columns are not looked at.
    """
    session(df)
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    return docs.mapInArrow(_encode(model, add_eos), "doc_id long, ids array<int>, decoded string").withColumnRenamed("doc_id", key)


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op6_sentence_pieces": op6_sentence_pieces}
ORACLES: dict[str, str] = {}
