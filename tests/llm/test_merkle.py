"""Trees, proofs and folds against a plain recursion."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tickspark.llm import merkle as M
from tickspark.llm import queries as Q


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def levels_of(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path(levels, i, fanout):
    """(left, right) for each level."""
    out = []
    for level in levels[:-1]:
        first = i // fanout * fanout
        run = level[first : first + fanout]
        out.append(("".join(run[: i - first]), "".join(run[i - first + 1 :])))
        i //= fanout
    return out


def proved(rows, fanout):
    """(group, id, leaf) -> (subroot, root, steps)"""
    trees = defaultdict(list)
    for g, i, leaf in rows:
        trees[g].append((-1 if i is None else i, leaf))
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: levels_of([leaf for _, leaf in sorted(trees[g])], fanout) for g in names}
    top = levels_of([low[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for n, (i, leaf) in enumerate(sorted(trees[g])):
            out.append((g, None if i == -1 else i, leaf, low[g][-1][0], top[-1][0], path(low[g], n, fanout) + path(top, k, fanout)))
    return out


@pytest.mark.parametrize("fanout,block_levels", [(2, 1), (2, 3), (2, 10), (3, 2)])
def test_against_recursion(spark, fanout, block_levels):
    rng = random.Random(fanout * 100 + block_levels)
    rows = [(g, i, sha(f"{g}{i}")) for g, n in ((None, 1), ("", 2), ("a", 37), ("A", 9), ("é", 8), ("zz", 16)) for i in range(n)]
    rows += [("a", 5, sha("other")), ("a", None, sha("x")), ("a", 7, sha("a7")), ("a", 7, sha("a7"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").repartition(3)
    got = M.proofs(df, fanout=fanout, block_levels=block_levels).withColumn("folded", M.folded(F.col("leaf"), F.col("steps"))).collect()
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[5])
    have = sorted(((r.lang, r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.steps]) for r in got), key=key)
    assert have == sorted(proved(rows, fanout), key=key)
    assert all(r.folded == r.root for r in got)


def test_small_and_empty_tables(spark):
    one = spark.createDataFrame([(None, 3, sha("x"))], "lang string, doc_id long, leaf string")
    (r,) = M.proofs(one).collect()
    assert (r.subroot, r.root, r.steps) == (sha("x"), sha("x"), [])
    assert M.proofs(one.limit(0)).count() == 0


def test_rows_of_all_kinds(spark, make_docs, as_table):
    texts = [None, "", "é😀", "x" * 200_000, "same", "same", "b"]
    docs = make_docs(texts, ids=[1, 2, None, 4, 5, 5, 7]).withColumns({"leaf": F.lit(1), "tree": F.lit(2), "hash": F.lit(3), "row": F.lit(4), "ROOT": F.lit(5), "number": F.lit(6)})
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") != 4, F.col("n_chars"))).withColumn("lang", F.when(F.col("doc_id") != 7, F.col("lang")))
    sf = as_table(docs)
    got = Q.op12_merkle_manifest(spark, sf).collect()
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    rows, claims = [], {}
    for d in docs.collect():
        leaf = lambda n, d=d: sha("".join(map(value, (d.doc_id, d.source, d.lang, n, d.text))))
        rows.append((d.lang, d.doc_id, leaf(d.n_chars)))
        hit = d.doc_id is not None and d.n_chars is not None and zlib.crc32(str(d.doc_id).encode()) % 7 == 0
        claims[leaf(d.n_chars)] = leaf(d.n_chars + 1) if hit else leaf(d.n_chars)
    want = []
    for _, i, leaf, subroot, root, steps in proved(rows, 2):
        h = claims[leaf]
        for a, z in steps:
            h = sha(a + h + z)
        want.append((str(i), leaf, subroot, root, sha("".join(a + z for a, z in steps)), h, h == root))
    have = [(str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got]
    assert sorted(have) == sorted(want)


def test_leaf_in_whatever_column_names(spark):
    df = spark.createDataFrame([("a.b", None, 3)], "`x.y` string, t string, n int")
    assert df.select(M.leaf_of(["x.y", "t", "n"])).first()[0] == sha("3:a.b-1:3")


def test_tampering_is_found(spark):
    got = Q.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert {zlib.crc32(str(r.doc_id).encode()) % 7 == 0 for r in got if not r.verified} == {True}
    assert sum(not r.verified for r in got) > 5
