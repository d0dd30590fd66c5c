import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickspark.llm import minhash as M
from tickspark.llm import queries as Q
from tickspark.llm.graph import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(texts, k, percent=80):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").encode().lower())
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    of = {}
    for i, s in enumerate(sets):
        for x in s:
            of.setdefault(x, []).append(i)
    links = []
    for i, s in enumerate(sets):
        near = {j for x in s for j in of[x] if j > i}
        links += [(i, j) for j in near if 100 * len(s & sets[j]) >= percent * len(s | sets[j])]
    return [len(s) for s in sets], classes(len(texts), links)


def agree(rows, texts, k):
    n, comp = brute(texts, k)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (n[r.doc_id], comp[r.doc_id], comp[r.doc_id] == r.doc_id), r


def test_on_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = Q.op4_minhash_dedup(spark, d).collect()
    assert len(rows) == len(texts) and sum(not r.kept for r in rows) > 50
    agree(rows, [texts[i] for i in range(len(texts))], 2)


def edited(pick, n):
    base = [f"w{pick.randint(0, 500)}" for _ in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(pick.randint(0, 5)):
            w[pick.randrange(60)] = f"x{pick.randint(0, 10_000)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small, block, k", [(4, 4, 2), (16, 8, 5), (64, 256, 5)])
def test_large_class_in_blocks(spark, make_docs, monkeypatch, small, block, k):
    monkeypatch.setattr(M, "SMALL_DOCS", small)
    monkeypatch.setattr(M, "BLOCK_DOCS", block)
    pick = random.Random(5)
    texts = edited(pick, 150) + edited(pick, 40) + ["same words here"] * 30
    pick.shuffle(texts)
    agree(M.near_duplicates(make_docs(texts), k).collect(), texts, k)


def test_large_class_with_few_links(spark, make_docs, monkeypatch):
    """One class of candidates by a common half; some are linked, most are not, and they differ in length."""
    monkeypatch.setattr(M, "SMALL_DOCS", 8)
    monkeypatch.setattr(M, "BLOCK_DOCS", 4)
    pick = random.Random(6)
    common = " ".join(f"c{i}" for i in range(40))
    texts = [common + " " + " ".join(f"x{pick.randint(0, 10**6)}" for _ in range(pick.randint(5, 40))) for _ in range(90)]
    texts += [texts[i] + " tail" for i in range(0, 90, 9)] + [texts[i] + " tail end" for i in range(0, 90, 18)]
    pick.shuffle(texts)
    _, comp = brute(texts, 2)
    assert 20 < len(set(comp)) < len(texts)
    for percent in (80, 50):
        n, comp = brute(texts, 2, percent)
        got = {r.doc_id: r.component_id for r in M.near_duplicates(make_docs(texts), 2, percent).collect()}
        wrong = [i for i in got if got[i] != comp[i]]
        assert not wrong or percent == 50  # bands are made for links of 80 % and more


def test_long_text(spark, make_docs):
    pick = random.Random(7)
    long = " ".join(f"w{pick.randint(0, 50_000)}" for _ in range(400_000))
    rows = M.near_duplicates(make_docs([long, "x " + long, "short one", None]), 5).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 0, 2: 2, 3: 3}


def test_edges(spark, make_docs):
    texts = [None, "", " \t\n", "one", "ONE", "one ", "a b", "b a", "é É", "x " * 50_000, "x x", "a b c d e f g h i j k", "a b c d e f g h i j z", "a b c", "A\vB\fC"]
    docs = make_docs(texts).withColumn("component_id", F.lit("clash")).withColumn("rep", F.lit(1)).withColumn("set_key", F.lit(1))
    rows = M.near_duplicates(docs.union(docs), 2).collect()
    assert len(rows) == 2 * len(texts)
    agree(rows, texts, 2)
    kept = M.drop_near_duplicates(docs.union(docs), 2)
    assert kept.columns == docs.columns
    _, comp = brute(texts, 2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp))
    assert M.near_duplicates(docs.limit(0)).count() == 0
    none = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert M.drop_near_duplicates(docs.union(none).union(none), 2).filter("doc_id is null").count() == 6
    assert all(r.kept for r in M.near_duplicates(docs.union(none), 2).filter("doc_id is null").collect())


def test_one_id_with_several_texts(spark, make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = lambda t: t + " more"
    # 5: a copy of 3 and a text of its own; 7: two texts of its own, one with a near copy in 8; 9: two near copies of each other.
    d, e, f = (" ".join(f"{x}{i}" for i in range(40)) for x in "def")
    given = [(3, a), (5, a), (5, b), (7, c), (7, d), (8, near(d)), (9, e), (9, near(e)), (10, ""), (10, f), (10, f), (11, near(b))]
    docs = make_docs([t for _, t in given], ids=[i for i, _ in given])
    rows = M.near_duplicates(docs, 5).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == sorted(zip((i for i, _ in given), (3, 3, 5, 7, 7, 7, 9, 9, 10, 10, 10, 5), strict=True))
    left = [(r.doc_id, r.text) for r in M.drop_near_duplicates(docs, 5).collect()]
    assert sorted(x for x in left if x[0] != 9) == sorted([(3, a), (5, b), (7, c), (7, d), (10, ""), (10, f)])
    # The class' set of the least hash, whatever way the rows are dealt.
    assert [x for x in left if x[0] == 9] == [(r.doc_id, r.text) for r in M.drop_near_duplicates(docs.repartition(3), 5).filter("doc_id = 9").collect()]
    assert len([x for x in left if x[0] == 9]) == 1


def test_one_permutation_shifted():
    pick = np.random.default_rng(1)
    a = np.unique(pick.integers(0, 1 << 63, 400, np.uint64))
    b = np.unique(np.concatenate([a[:360], pick.integers(0, 1 << 63, 40, np.uint64)]))
    same = (M.signature(a, 2000) == M.signature(b, 2000)).mean()
    assert abs(same - 360 / 440) < 0.06


def test_components(spark):
    pick = random.Random(2)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes(500, edges)
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_are_compared_as_they_stream():
    pick = np.random.default_rng(3)
    sets, groups, nodes = [], [], []
    for g in range(40):
        base = np.unique(pick.integers(0, 1 << 40, 30))
        for _ in range(int(pick.integers(1, 5))):
            sets.append(base[: len(base) - int(pick.integers(0, 3))])
            groups.append(f"{g}/0")
            nodes.append(len(nodes))
    table = pa.table({"group": groups, "node": pa.array(nodes, pa.int64()), "set": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
    held = []
    real, whole = M._links, None
    for rows in (1, 3, 1000):
        found = []
        try:
            M._links = lambda t, p: held.append(t.num_rows) or real(t, p)
            for out in M._streamed(iter(table.to_batches(max_chunksize=rows)), 80):
                found += list(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
        finally:
            M._links = real
        whole = whole or sorted(found)
        assert sorted(found) == whole and whole
    assert max(held) <= 4 and len(held) == 3 * 40  # one group at a time
    assert [b.num_rows for b in M._streamed(iter([]), 80)] == [0]
