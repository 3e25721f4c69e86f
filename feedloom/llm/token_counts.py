"""Token counts that follow edits: a tree of pre-token counts for each document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, session, table, text_of, written

#: Pre-tokens in a leaf when the tree is built; a leaf of SPLIT times as many is divided anew.
LEAF, SPLIT = 32, 8
#: A match of the pre-token pattern depends on so many characters after it at
#: most: on the one that ends it, and (white space before a word; an apostrophe
#: before a suffix) on the next.
LOOKAHEAD = 2
#: Characters read beyond an edit at first, to find where old and new pre-tokens agree again.
WINDOW = 48

_CACHE = 400_000


class PreTokens(dict):
    """Token counts of pre-tokens: added tokens, and the pattern's matches between them, which no token crosses."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        from .packing import added_tokens, encode_whole

        added = sorted(added_tokens(path), key=len, reverse=True)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        #: Whether an added token begins where a match ends shows so many characters later.
        self.lookahead = LOOKAHEAD + max(map(len, added), default=0)
        self.encode = encode_whole(path)

    def split(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return self.find(text)
        return [p for k, part in enumerate(self.added.split(text)) for p in ([part] if k % 2 else self.find(part))]

    def __missing__(self, piece: str) -> int:
        if len(self) > _CACHE:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n


class CountTree:
    """A document as leaves of pre-tokens, under a binary tree of their characters and tokens.

    An edit finds its leaf from the top, encodes the pre-tokens from just
    before it to where the old ones hold again, and changes sums on the way up.
    A tree that was kept is known by the characters and tokens of its leaves:
    of its text only the leaves that edits touch are read.
    """

    def __init__(self, text: str, counts: PreTokens, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.counts, self.original = counts, text
        self.encoded = 0  # characters encoded by edits
        self.leaves: list[list[str] | None]
        if chars is None or tokens is None:
            self.leaves = self._dealt(counts.split(text))
            self.starts = [0] * len(self.leaves)
            self._sum([sum(map(len, leaf)) for leaf in self.leaves], [sum(map(counts.__getitem__, leaf)) for leaf in self.leaves])
        else:
            self.leaves = [None] * len(chars)
            self.starts = list(accumulate(chars, initial=0))[:-1]
            self._sum(chars, tokens)

    @staticmethod
    def _dealt(pieces: list[str]) -> list[list[str]]:
        return [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)] or [[]]

    def _sum(self, chars: list[int], tokens: list[int]) -> None:
        self.size = 1 << (len(chars) - 1).bit_length()
        pad = [0] * (self.size - len(chars))
        self.chars = [0] * self.size + list(chars) + pad
        self.tokens = [0] * self.size + list(tokens) + pad
        for sums in (self.chars, self.tokens):
            for k in range(self.size - 1, 0, -1):
                sums[k] = sums[2 * k] + sums[2 * k + 1]

    def _leaf(self, k: int) -> list[str]:
        """The leaf's pre-tokens; those of a leaf that no edit has changed are split from its part of the text."""
        made = self.leaves[k]
        if made is None:
            n, start, at = self.chars[k + self.size], self.starts[k], 0
            made = self.leaves[k] = []
            for piece in self.counts.split(self.original[start : start + n + self.counts.lookahead]):
                if at >= n:
                    break
                made.append(piece)
                at += len(piece)
        return made

    def kept(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves."""
        return tuple(sums[self.size : self.size + len(self.leaves)] for sums in (self.chars, self.tokens))

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.original[self.starts[k] : self.starts[k] + self.chars[k + self.size]] if leaf is None else "".join(leaf) for k, leaf in enumerate(self.leaves))

    def _set(self, k: int, pieces: list[str]) -> None:
        self.leaves[k] = pieces
        at = k + self.size
        self.chars[at] = sum(map(len, pieces))
        self.tokens[at] = sum(map(self.counts.__getitem__, pieces))
        while at > 1:
            at //= 2
            self.chars[at] = self.chars[2 * at] + self.chars[2 * at + 1]
            self.tokens[at] = self.tokens[2 * at] + self.tokens[2 * at + 1]

    def _find(self, char: int) -> tuple[int, int, int]:
        """(leaf, pre-token in it, its first character) of the pre-token with this character."""
        at, start = 1, 0
        while at < self.size:
            at *= 2
            if char - start >= self.chars[at] and self.chars[at + 1]:
                start += self.chars[at]
                at += 1
        leaf = self._leaf(at - self.size)
        for i, piece in enumerate(leaf):
            if char - start < len(piece) or i == len(leaf) - 1:
                return at - self.size, i, start
            start += len(piece)
        return at - self.size, 0, start

    def edit(self, position: int, n_deleted: int, inserted: str) -> None:
        """Puts ``inserted`` in the place of ``n_deleted`` characters; ranges beyond the text are cut to it."""
        position = min(max(position, 0), self.n_chars)
        n_deleted = min(max(n_deleted, 0), self.n_chars - position)
        if not n_deleted and not inserted:
            return
        first, i, start = self._find(max(0, position - self.counts.lookahead))
        shift = len(inserted) - n_deleted
        old: list[str] = []  # pre-tokens from the first that may change
        end, leaf, j, ahead = start, first, i, WINDOW
        while True:
            while end < position + n_deleted + ahead and leaf < len(self.leaves):
                pieces = self._leaf(leaf)
                while j < len(pieces) and end < position + n_deleted + ahead:
                    old.append(pieces[j])
                    end += len(pieces[j])
                    j += 1
                if j == len(pieces):
                    leaf, j = leaf + 1, 0
            was = "".join(old)
            cut = position - start
            new = self.counts.split(was[:cut] + inserted + was[cut + n_deleted :])
            last = leaf >= len(self.leaves) or end >= self.n_chars
            bounds = {b: k + 1 for k, b in enumerate(accumulate(map(len, old[1:]), initial=start + len(old[0])))} if old else {}
            p, agree = start, None
            for k, piece in enumerate(new):
                p += len(piece)
                if not last and p > end + shift - self.counts.lookahead:
                    break
                if p >= position + len(inserted) and p - shift in bounds:
                    agree = k + 1, bounds[p - shift]
                    break
            if agree is None and last:
                agree = len(new), len(old)
            if agree:
                break
            ahead *= 2
        n_new, n_old = agree
        self.encoded += sum(map(len, new[:n_new]))
        self._replace(first, i, n_old, new[:n_new])

    def _replace(self, leaf: int, i: int, n_old: int, new: list[str]) -> None:
        pieces = self._leaf(leaf)
        first, left = leaf, n_old - (len(pieces) - i)
        head, tail = pieces[:i], pieces[i + n_old :] if left < 0 else []
        while left > 0:
            leaf += 1
            pieces = self._leaf(leaf)
            self._set(leaf, pieces[left:])
            left -= len(pieces)
        self._set(first, head + new + tail)
        if len(self.leaves[first]) > LEAF * SPLIT:
            parts = self._dealt(self.leaves[first])
            chars, tokens = self.kept()
            chars[first : first + 1] = [sum(map(len, p)) for p in parts]
            tokens[first : first + 1] = [sum(map(self.counts.__getitem__, p)) for p in parts]
            self.leaves[first : first + 1] = parts
            self.starts[first : first + 1] = [0] * len(parts)
            self._sum(chars, tokens)


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


_INTS = pa.list_(pa.int32())


def _build(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = pre_tokens(path)
        for b in batches:
            last = b.num_columns - 1
            trees = [CountTree(text.as_py(), counts) for text in b.column(last)]
            kept = [t.kept() for t in trees]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array([t.n_tokens for t in trees], pa.int64()), *[pa.array([k[m] for k in kept], _INTS) for m in (0, 1)]], names=[*b.schema.names[:last], "n_tokens", "tree_chars", "tree_tokens"])

    return run


_OWN = "n_tokens long, n_tokens_edited long, n_chars_edited long, n_edits long, encoded_chars long, text_edited string, tree_chars array<int>, tree_tokens array<int>"


def _follow(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = pre_tokens(path)
        names = [c.split(" ")[0] for c in _OWN.split(", ")]
        for b in batches:
            last = b.num_columns - 4
            made = []
            for text, chars, tokens, edits in zip(*(b.column(last + m) for m in range(4))):
                tree = CountTree(text.as_py(), counts, chars.as_py(), tokens.as_py())
                before, edits = tree.n_tokens, edits.as_py()
                for e in edits:
                    tree.edit(e["position"], e["n_deleted"], e["inserted"])
                made.append((before, tree.n_tokens, tree.n_chars, len(edits), tree.encoded, tree.text(), *tree.kept()))
            types = [*[pa.int64()] * 5, pa.string(), _INTS, _INTS]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], *[pa.array([m[k] for m in made], t) for k, t in enumerate(types)]], names=[*b.schema.names[:last], *names])

    return run


def build_trees(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row of ``df`` with ``n_tokens`` and its tree: ``tree_chars`` and ``tree_tokens`` of the leaves.

    To be kept with the texts. Null texts are empty (one empty leaf); very long
    texts are counted whole; repeated rows get the same trees; input columns
    named like a result are replaced; an empty table gives no rows.
    """
    session(df)
    return mapped(df, [text_of(text)], _build(tokenizer), "n_tokens long, tree_chars array<int>, tree_tokens array<int>")


def apply_edits(trees: DataFrame, edits: Column, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row of ``trees`` with its token counts before and after its edits, and its new text and tree.

    ``edits`` is an array of (position, n_deleted, inserted), applied in order;
    positions are in characters of the text as the earlier edits left it. Only
    leaves that edits touch are split and encoded again. Added are ``n_tokens``,
    ``n_tokens_edited``, ``n_chars_edited``, ``n_edits``, ``encoded_chars`` (the
    characters that edits made it encode again), ``text_edited``, and the
    changed ``tree_chars`` and ``tree_tokens``, for the next edits.

    Null texts are empty; null arrays and null edits change nothing (a null
    field counts as 0 or ""); ranges outside the text are cut to it; a row
    without a tree gets one; repeated rows get the same counts; input columns
    named like a result are replaced; an empty table gives no rows.
    """
    session(trees)
    fine = F.transform(
        F.filter(F.coalesce(edits, F.array()), lambda e: e.isNotNull()),
        lambda e: F.struct(F.coalesce(e["position"], F.lit(0)).cast("long").alias("position"), F.coalesce(e["n_deleted"], F.lit(0)).cast("long").alias("n_deleted"), F.coalesce(e["inserted"], F.lit("")).alias("inserted")),
    )
    return mapped(trees, [text_of(text), F.col("tree_chars"), F.col("tree_tokens"), fine], _follow(tokenizer), _OWN)


def revisions(key: Column, text: Column) -> Column:
    """Three edits of each text, placed by a checksum of its key: a word replaced, a stretch cut, a sentence added."""
    at = lambda k: F.crc32(F.concat_ws("-", key.cast("string"), F.lit(k)).cast("binary")) % (F.char_length(text) + 1)
    edit = lambda k, n, s: F.struct(at(k).cast("long").alias("position"), F.lit(n).cast("long").alias("n_deleted"), F.lit(s).alias("inserted"))
    return F.array(edit(0, 12, "revised "), edit(1, 40, ""), edit(2, 0, " A sentence that wasn't there.\n"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    trees = written(build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), path), "trees")
    edited = apply_edits(trees, revisions(F.col("doc_id"), text_of("text")), path)
    return edited.select("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "encoded_chars")


QUERIES = {"op10_token_counts": op10_token_counts}
ORACLES: dict[str, str] = {}
