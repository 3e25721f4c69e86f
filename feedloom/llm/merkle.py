"""A Merkle manifest of a dataset: digests of rows, of groups and of all, with a proof for each row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import session, table, written

#: Children of a node.
ARITY = 3
#: A task's block has ARITY ** HEIGHT nodes at most: what one call of the traversal holds.
HEIGHT = 6
BLOCK = ARITY**HEIGHT

_PATH = "array<struct<before: binary, after: binary>>"
_STEP = pa.struct([("before", pa.binary()), ("after", pa.binary())])


def digest_of(columns: Sequence[str | Column]) -> Column:
    """Hex SHA-256 of values: each ``-`` if null, else its UTF-8 byte count, ``:`` and itself (numbers in decimal)."""
    parts = []
    for c in columns:
        value = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _join(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def traverse(leaves: Sequence[bytes], low: int, high: int, height: int, paths: list[list]) -> bytes:
    """The digest of the subtree of ``height`` over leaves ``low`` to ``high``, postorder.

    While it unwinds, each child's siblings are appended to the paths of the
    leaves inside that child.
    """
    if not height:
        return leaves[low]
    width = ARITY ** (height - 1)
    starts = range(low, high, width)
    children = [traverse(leaves, at, min(at + width, high), height - 1, paths) for at in starts]
    for k, at in enumerate(starts):
        step = {"before": b"".join(children[:k]), "after": b"".join(children[k + 1 :])}
        for leaf in range(at, min(at + width, high)):
            paths[leaf].append(step)
    return _join(children)


def height_of(nodes: int) -> int:
    """Levels above so many nodes until one remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, pos, n, digest) in order, n nodes in their group: each whole block's rows with path and top."""
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        groups, places, sizes, digests = zip(*held)
        paths: list[list] = [[] for _ in held]
        top = traverse(digests, 0, len(held), min(HEIGHT, height_of(sizes[0])), paths)
        return pa.RecordBatch.from_arrays([pa.array(groups), pa.array(places, pa.int64()), pa.array(paths, pa.list_(_STEP)), pa.array([top] * len(held), pa.binary())], names=["g", "pos", "path", "top"])

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and (row[0] != held[-1][0] or row[1] // BLOCK != held[-1][1] // BLOCK):
                yield made()
                held = []
            held.append(row)
    if held:
        yield made()


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in ``order`` inside each group ``g``) and ``n`` (rows of the group).

    Dealt by ranges of (g, order) and written; what each range has of a group
    gives where the next one begins. No task sees more than its range, whatever
    the groups' sizes.
    """
    by = ["g", *order, "x_tie"]
    ranged = rows.withColumn("x_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("x_tie")
    placed = written(ranged.withColumn("x_at", F.monotonically_increasing_id()), "merkle-rows")
    part = F.shiftright("x_at", 33)
    counts = placed.groupBy("g", part.alias("x_part")).agg(F.count(F.lit(1)).alias("c"), F.min("x_at").alias("x_first"))
    # One row for each range that a group lies in.
    ranges = Window.partitionBy("g").orderBy("x_part")
    before = F.coalesce(F.sum("c").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("g", "x_part", (before - F.col("x_first")).alias("x_shift"), F.sum("c").over(Window.partitionBy("g")).alias("n"))
    starts = written(starts, "merkle-starts")
    return placed.withColumn("x_part", part).join(starts, ["g", "x_part"]).withColumn("pos", F.col("x_at") + F.col("x_shift")).drop("x_at", "x_part", "x_shift")


def _level(nodes: DataFrame) -> DataFrame:
    """(g, pos, path, top) of nodes (g, pos, n, digest): their steps inside their block, and the block's top."""
    block = F.floor(F.col("pos") / BLOCK)
    dealt = nodes.select("g", "pos", "n", "digest").repartition("g", block).sortWithinPartitions("g", "pos")
    return written(dealt.mapInArrow(_blocks, f"g string, pos long, path {_PATH}, top binary"), "merkle-level")


def trees(nodes: DataFrame) -> DataFrame:
    """(g, pos, path, root) of nodes (g, pos, n, digest): for each its steps up to the root of its group, bottom up.

    Aligned blocks are traversed where they lie; their tops are the nodes of
    the next traversal, BLOCK times fewer, until every group has one top.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = [_level(nodes)]
    sizes = nodes.select("g", "n").groupBy("g").agg(F.first("n").alias("n"))
    while most > BLOCK:
        most = -(-most // BLOCK)
        sizes = sizes.withColumn("n", F.ceil(F.col("n") / BLOCK))
        tops = levels[-1].where(F.col("pos") % BLOCK == 0).select("g", F.floor(F.col("pos") / BLOCK).alias("pos"), F.col("top").alias("digest"))
        levels.append(_level(tops.join(sizes, "g")))
    above = levels[-1].withColumnRenamed("top", "root")
    for level in levels[-2::-1]:
        upper = above.select("g", F.col("pos").alias("x_block"), F.col("path").alias("x_path"), "root")
        joined = level.withColumn("x_block", F.floor(F.col("pos") / BLOCK)).join(upper, ["g", "x_block"])
        above = joined.select("g", "pos", F.concat("path", "x_path").alias("path"), "root")
    return above


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def manifest(df: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source", more: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """(key, leaf, subroot, root, path, and ``more``) for every row of ``df``.

    In each ``group`` leaves ascend by ``key`` (null first, then by digest);
    while several nodes remain, every 3 consecutive ones, of the last run fewer,
    become the digest of their hex digests one after the other. What remains is
    the group's ``subroot``; subroots in order of the group (null first, bytes of
    UTF-8) make ``root`` in the same way. ``path`` has, bottom up through the
    subroot to the root, the siblings before and after each node on the way.

    Repeated rows are leaves of their own, alike in digest and order. A null key
    or group is a value of its own. A lone leaf is its subroot, a lone subroot
    the root. An empty table gives no rows. Only what ``leaf``, ``key``,
    ``group`` and ``more`` name is read; texts stay where they are hashed.
    """
    session(df)
    named = F.col(f"`{group}`").cast("string")
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("g"), F.col(f"`{key}`").alias("key"), F.unhex(leaf).alias("digest"),
        *[c.alias(f"more{i}") for i, (_, c) in enumerate(more)],
    )
    extra = [f"more{i}" for i in range(len(more))]
    # Written before they are dealt by ranges, which reads its input twice: texts are hashed once.
    leaves = written(_numbered(written(rows, "merkle-digests"), ["key", "digest", *extra]), "merkle-leaves")
    if leaves.isEmpty():
        return leaves.select(F.col("key").alias(key), _text("digest").alias("leaf"), F.lit("").alias("subroot"), F.lit("").alias("root"), F.array().cast(_PATH).alias("path"), *[F.col(e).alias(name) for e, (name, _) in zip(extra, more)])
    inside = trees(leaves)
    # One row a group: the leaf at 0 knows its subroot.
    subroots = inside.where("pos = 0").select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("root").alias("digest"))
    ordered = written(_numbered(subroots, ["of"]), "merkle-subroots")
    tops = ordered.join(trees(ordered).drop("g"), "pos").select(F.col("of").alias("g"), F.col("path").alias("x_path"), F.col("root").alias("x_root"))
    out = leaves.drop("n").join(inside, ["g", "pos"]).join(tops, "g")
    return out.select(
        F.col("key").alias(key), _text("digest").alias("leaf"), _text("root").alias("subroot"), _text("x_root").alias("root"),
        F.concat("path", "x_path").alias("path"), *[F.col(e).alias(name) for e, (name, _) in zip(extra, more)],
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hex digest gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(_text(step["before"]), at, _text(step["after"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(_text(step["before"]), _text(step["after"]))), "").cast("binary"), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = digest_of([*fields, F.when(changed, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))])
    made = manifest(docs, digest_of([*fields, "text"]), more=[("shown", F.unhex(tampered))])
    out = made.withColumn("folded_root", folded(_text("shown"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    parts = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({parts})"


#: The tree of each group as nodes (g, level, pos, h); the group of subroots is ``top``.
def _sql_tree(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT g, 0 AS level, pos, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL SELECT g, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY g, level, pos // 3
)"""


ORACLE = f"""
WITH RECURSIVE bits AS (
  SELECT doc_id, text, source, lang, n_chars, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS inverted FROM documents
), docs AS (
  SELECT doc_id, source AS g, {_sql_leaf("text")} AS h, {_sql_leaf("CASE WHEN inverted % 2 = 1 THEN replace(text, chr(10), '') ELSE text END")} AS shown FROM bits
), leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos FROM docs),
{_sql_tree("tree", "leaves")},
subroots AS (SELECT 'top' AS g, g AS of, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1),
{_sql_tree("toptree", "subroots")},
nodes AS (SELECT 1 AS part, g, level, pos, h, n FROM tree UNION ALL SELECT 2, g, level, pos, h, n FROM toptree),
walks AS (
  SELECT doc_id, shown, g AS own, 1 AS part, g, pos FROM leaves
  UNION ALL SELECT doc_id, shown, l.g, 2, 'top', s.pos FROM leaves l JOIN subroots s ON s.of IS NOT DISTINCT FROM l.g
), steps AS (
  SELECT w.doc_id, n.part, n.level, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < w.pos // pow(3, n.level)::BIGINT), '') AS before,
    coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > w.pos // pow(3, n.level)::BIGINT), '') AS after
  FROM walks w JOIN nodes n ON n.part = w.part AND n.g IS NOT DISTINCT FROM w.g AND n.n > 1 AND n.pos // 3 = w.pos // pow(3, n.level + 1)::BIGINT GROUP BY ALL
), paths AS (SELECT doc_id, before, after, row_number() OVER (PARTITION BY doc_id ORDER BY part, level) AS k FROM steps),
fold AS (
  SELECT doc_id, shown AS h, 0 AS k FROM docs
  UNION ALL SELECT f.doc_id, sha256(p.before || f.h || p.after), p.k FROM fold f JOIN paths p ON p.doc_id = f.doc_id AND p.k = f.k + 1
)
SELECT d.doc_id, d.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(q.siblings, '')) AS proof_sha256, f.folded_root, f.folded_root = r.h AS verified
FROM docs d JOIN subroots s ON s.of IS NOT DISTINCT FROM d.g, (SELECT h FROM toptree WHERE n = 1) r,
  LATERAL (SELECT string_agg(before || after, '' ORDER BY k) AS siblings FROM paths WHERE paths.doc_id = d.doc_id) q,
  LATERAL (SELECT max_by(h, k) AS folded_root FROM fold WHERE fold.doc_id = d.doc_id) f
"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLES = {"op12_merkle_manifest": ORACLE}
