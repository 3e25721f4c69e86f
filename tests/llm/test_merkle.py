import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle

from .cases import awkward, empty


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, path of (before, after) for each node), a level at a time."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            run = k // 3 * 3
            paths[leaf].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + 3])))
        nodes = [sha("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)]
        at = [k // 3 for k in at]
    return nodes[0], paths


def brute(rows, text=lambda r: r.text):
    """What the query gives, in plain Python: rows with doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r.doc_id, r.source, r.lang, r.n_chars, r.text), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    root, above = tree([trees[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        subroot, paths = trees[s]
        for (_, _, leaf, r), path in zip(sorted(groups[s], key=lambda x: x[:3]), paths):
            path = path + above[k]
            changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.doc_id is not None and r.text is not None
            at = leaf_of(r.doc_id, r.source, r.lang, r.n_chars, r.text.replace("\n", "")) if changed else leaf
            for before, after in path:
                at = sha(before + at + after)
            out.append((r.doc_id, leaf, subroot, root, sha("".join(b + a for b, a in path)), at, at == root))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    got = merkle.op12_merkle_manifest(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert sorted(map(tuple, rows), key=repr) == brute(spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert {r.verified for r in rows} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 81, 82])
def test_traversal(n):
    leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
    paths = [[] for _ in leaves]
    top = merkle.traverse(leaves, 0, n, merkle.height_of(n), paths)
    root, want = tree([x.hex() for x in leaves])
    assert top.hex() == root and [[(s["before"].hex(), s["after"].hex()) for s in p] for p in paths] == want


def made(frame):
    leaf = merkle.digest_of(["doc_id", "source", "lang", "n_chars", "text"])
    rows = merkle.manifest(frame, leaf, more=[("shown", leaf)])
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"), merkle.folded(F.col("shown"), F.col("path")).alias("folded"))


@pytest.mark.parametrize("sizes", [(2000, 1), (729, 730), (2187, 3, 1)])
def test_groups_of_several_blocks(spark, sizes):
    frame = spark.range(sum(sizes)).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.lit(None).cast("string").alias("source"))
    at = 0
    for k, size in enumerate(sizes):
        frame = frame.withColumn("source", F.when(F.col("doc_id") >= at, f"s{k}" if k else None).otherwise(F.col("source")))
        at += size
    rows = made(frame.repartition(7)).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == [x[:5] for x in brute(frame.collect())]
    assert all(r.folded == r.root for r in rows)


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = made(frame).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == [x[:5] for x in brute(frame.collect())]
    assert all(r.folded == r.root for r in rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, made(frame.repartition(5)).collect()), key=repr)
    assert made(empty(spark)).count() == 0


def test_any_change_shows(spark):
    frame = awkward(spark)
    other = frame.withColumn("text", F.when(F.col("doc_id") == 7, F.concat("text", F.lit(" "))).otherwise(F.col("text")))
    roots = [made(f).first().root for f in (frame, other, frame.where("doc_id <> 7"), frame.withColumn("n_chars", F.lit(None).cast("long")))]
    assert len(set(roots)) == 4
