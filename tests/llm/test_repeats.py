import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm import queries as Q
from tickspark.llm import repeats as R
from tickspark.llm import substring_dedup as W
from tickspark.llm import suffix_dedup as S


def brute_bytes(texts, window):
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        mark = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - window + 1):
            w = data[i : i + window]
            if w in seen:
                mark[i : i + window] = 1
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], mark])) == 1).sum())
        kept = bytes(b for b, m in zip(data, mark, strict=False) if not m)
        out.append((len(data), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(texts, window):
    docs = [(t or "").encode().split() for t in texts]
    count = {}
    for w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            count[k] = count.get(k, 0) + 1
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def check_bytes(rows, texts, window=100):
    want = brute_bytes(texts, window)
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


def check_words(rows, texts, window=35):
    want = brute_words(texts, window)
    for r in rows:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id


def mosaic(n, alphabet, seed):
    """Texts of shared passages of all lengths with edits between them."""
    pick = random.Random(seed)
    pool = ["".join(pick.choice(alphabet) for _ in range(pick.randint(30, 400))) for _ in range(12)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randint(0, 6)):
            p = pick.choice(pool)
            a = pick.randint(0, len(p) - 1)
            parts.append(p[a : a + pick.randint(1, 400)])
            if pick.random() < 0.5:
                parts.append("".join(pick.choice(alphabet) for _ in range(pick.randint(1, 20))))
        out.append("".join(parts))
    return out


def word_mosaic(n, seed):
    chars = mosaic(n, "abcdefghij", seed)
    return [" ".join(t) for t in chars]


EDGES = [None, "", "x", "a" * 99, "b" * 100, "b" * 101, "c" * 5000, "é" * 300, "ab" * 400, ("same text " * 30), ("same text " * 30), "w " * 34, "v " * 35, "v " * 36, "u " * 4000, " \t\n"]


@pytest.fixture(params=[False, True])
def small_parts(request, monkeypatch):
    """Whole batches, or many segments, buffers and shards: how large the latter are."""
    if request.param:
        monkeypatch.setattr(R, "SEGMENT", 700)
        monkeypatch.setattr(R, "RUNS_AT_ONCE", 20)
    return {"shard": 900} if request.param else {}


def solo(task, texts):
    """The engine's steps without Spark, over two partitions: what is removed, and how many places by which step."""
    import pyarrow as pa

    order = [(c, "ascending") for c in R.ORDER]
    covered, share = [set() for _ in texts], {"buffer": 0, "solver": 0, "windows": 0}

    def remove(table, name):
        for d, a, b in zip(*(table[c].to_pylist() for c in ("doc", "begin", "end")), strict=True):
            share[name] += len(set(range(a, b)) - covered[d])
            covered[d].update(range(a, b))

    def lists(rows):
        """(doc, base, text, rows of it), as two batches."""
        by_doc = {}
        for r in rows.to_pylist():
            by_doc.setdefault(r["doc"], []).append({k: r[k] for k in ("h", "begin", "info")})
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("h", "begin", "info")]))
        ids = sorted(by_doc)
        whole = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int64()), pa.array([texts[i] for i in ids], pa.string()), pa.array([by_doc[i] for i in ids], kind)], ["doc", "base", "text", "asked"])
        return iter([whole.slice(0, 9), whole.slice(9)])

    def resolve(found, hot_rows, name):
        met = pa.Table.from_batches(list(R._meet(iter(found.sort_by(order).to_batches(max_chunksize=7)), hot_rows)), schema=R._FOUND)
        kind = met["info"].to_numpy() & 3
        gone = {c: met[c].to_numpy()[kind == R.REMOVED] for c in ("doc", "begin", "info")}
        remove(pa.table({"doc": gone["doc"], "begin": gone["begin"], "end": gone["begin"] + (gone["info"] >> 16)}), "buffer")
        regions = pa.Table.from_batches(list(R._gather(lists(met.filter(pa.array(kind == R.ASKED))), task)), schema=R._TEXT).sort_by(order)
        for b in R._solve(iter(regions.to_batches(max_chunksize=5)), task):
            remove(pa.Table.from_batches([b]), name)
        return met.filter(pa.array(kind == R.HOT))

    def deal(ids):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int64()), pa.array([texts[i] for i in ids], pa.string())], ["doc", "base", "text"])

    halves = [list(range(0, len(texts), 2)), list(range(1, len(texts), 2))]
    found = pa.Table.from_batches([b for ids in halves for b in R._find(iter([deal(ids)]), task)], schema=R._FOUND)
    hot = resolve(found, task.hot_rows, "solver")
    if hot.num_rows:
        found = pa.Table.from_batches([b for part in lists(hot) for b in R._windows(iter([part]), task)], schema=R._FOUND)
        assert not resolve(found, None, "windows").num_rows
    return covered, share


@pytest.mark.parametrize("seed", range(4))
def test_engine_bytes(small_parts, seed):
    texts = mosaic(60, "ab" if seed % 2 else "abcdefgh", seed) + EDGES
    want = brute_bytes(texts, 100)
    got, _ = solo(S.byte_task(**small_parts), texts)
    assert [len(c) for c in got] == [w[1] for w in want]


@pytest.mark.parametrize("seed", range(4))
def test_engine_words(small_parts, seed):
    texts = word_mosaic(50, seed) + EDGES
    want = brute_words(texts, 35)
    got, _ = solo(W.word_task(**small_parts), texts)
    assert [len(c) for c in got] == [w[1] for w in want]


@pytest.mark.parametrize("rows, here", [(1, 1 << 30), (3, 1 << 30), (1 << 30, 1), (1 << 30, 3), (2, 2), (1 << 30, 1 << 30)])
def test_hot_anchors_are_taken_apart(small_parts, rows, here):
    """With few rows allowed around an anchor, after the exchange or before, most are compared as single windows."""
    pick = random.Random(8)
    common = "".join(pick.choice("abcdef") for _ in range(180))
    hot = min(rows, here) < 1 << 30
    texts = mosaic(40, "abcdefgh", 6) + [f"{i} x{i} {common}{i * 7} y{i}" for i in range(40)] + EDGES
    got, share = solo(S.byte_task(hot_rows=rows, hot_here=here, **small_parts), texts)
    assert [len(c) for c in got] == [w[1] for w in brute_bytes(texts, 100)]
    assert (share["windows"] > 0) == hot or here < 1 << 30
    texts = word_mosaic(40, 5) + [" ".join(f"{i} {common[:60]} {i}") for i in range(40)] + EDGES
    got, share = solo(W.word_task(hot_rows=rows, hot_here=here, **small_parts), texts)
    assert [len(c) for c in got] == [w[1] for w in brute_words(texts, 35)]
    assert (share["windows"] > 0) == hot or here < 1 << 30


def test_one_anchor_larger_than_a_shard():
    """All texts share an anchor and differ around it; copies of each come in several parts."""
    core = "".join(random.Random(2).choices("abcdef", k=120))
    texts = [f"{i % 7:03d}{core}{i % 7:05d}" for i in range(60)]
    for rows in (1, 1 << 30):
        assert [len(c) for c in solo(S.byte_task(hot_rows=rows, shard=1000), texts)[0]] == [w[1] for w in brute_bytes(texts, 100)]
        words = [" ".join(t) for t in texts]
        assert [len(c) for c in solo(W.word_task(hot_rows=rows, shard=1000), words)[0]] == [w[1] for w in brute_words(words, 35)]


@pytest.mark.parametrize("rows, here", [(1 << 30, 1 << 30), (2, 2)])
def test_colliding_hashes_remove_nothing(monkeypatch, rows, here):
    """With hashes of places that say nothing, all that is removed has been compared."""
    real = R.mix
    monkeypatch.setattr(R, "mix", lambda x: real(x) & np.uint64(3))
    texts = mosaic(14, "abcd", 3) + EDGES[:9]
    assert [len(c) for c in solo(S.byte_task(hot_rows=rows, hot_here=here), texts)[0]] == [w[1] for w in brute_bytes(texts, 100)]
    texts = word_mosaic(14, 3) + EDGES
    assert [len(c) for c in solo(W.word_task(hot_rows=rows, hot_here=here), texts)[0]] == [w[1] for w in brute_words(texts, 35)]


def test_collisions_are_found(monkeypatch):
    """With a hash that always collides the bytes decide."""
    monkeypatch.setattr(R, "span_hashes", lambda prefix, start, length: np.zeros(len(start), np.uint64))
    part, begin, end = S.later_windows(5)([b"abcde", b"abcdf", b"abcde"], np.array([5, 5, 5]), np.zeros((2, 3), np.int64))
    assert (part.tolist(), begin.tolist(), end.tolist()) == ([2], [0], [5])


def test_fm_index_counts():
    pick = np.random.default_rng(3)
    symbols = pick.integers(0, 4, 300).astype(np.uint64)
    start, length = np.array([0, 100, 180]), np.array([100, 80, 120])
    index = W.FMIndex(symbols, start, length)
    pieces = [symbols[a : a + n].tolist() for a, n in zip(start, length, strict=True)]
    for _ in range(50):
        k = int(pick.integers(1, 6))
        p = pick.integers(0, 4, k)
        low, high = np.array([0]), np.array([len(index.text)])
        for c in p[::-1]:
            low, high = index.extend(np.array([c + 1]), low, high)
        want = sum(x[i : i + k] == p.tolist() for x in pieces for i in range(len(x) - k + 1))
        assert int(high[0] - low[0]) == want


@pytest.mark.parametrize("seed", range(5))
def test_fm_solver_against_counting(seed):
    pick = random.Random(seed)
    pool = [[pick.choice("abcde") for _ in range(pick.randint(3, 30))] for _ in range(4)]
    parts = []
    for _ in range(40):
        p = pick.choice(pool)
        a = pick.randrange(len(p))
        parts.append(p[a : a + pick.randint(1, 30)] + [pick.choice("xyz") for _ in range(pick.randint(0, 3))])
    count = {}
    for p in parts:
        for i in range(len(p) - 5):
            count[tuple(p[i : i + 6])] = count.get(tuple(p[i : i + 6]), 0) + 1
    got = [set() for _ in parts]
    regions = [" ".join(p).encode() for p in parts]
    for i, a, b in zip(*W.repeated_windows(6)(regions, np.array([len(p) for p in parts]), np.zeros((2, len(parts)), np.int64)), strict=True):
        got[i].update(range(a, b))
    for p, g in zip(parts, got, strict=True):
        assert g == {j for i in range(len(p) - 5) if count[tuple(p[i : i + 6])] > 1 for j in range(i, i + 6)}


@pytest.mark.parametrize("words, most", [(False, 24), (True, 12)])
def test_windows_of_hot_anchors_travel_in_runs(spark, make_docs, monkeypatch, words, most):
    """A passage at whose edges every document goes on in its own way: no pass makes a row for each window of a hot anchor."""
    pick = random.Random(12)
    common, n = "".join(pick.choices("abcdef", k=260)), 150
    texts = ["".join(pick.choices("ghij", k=150)) + common[i % 3 :] + "".join(pick.choices("klmn", k=150)) for i in range(n)] + mosaic(20, "abcd", 4)
    texts = [" ".join(t) for t in texts] if words else texts
    made, real = [], R._meeting_of
    monkeypatch.setattr(R, "_meeting_of", lambda found, hot_rows: made.append(found.count()) or real(found, hot_rows))
    task = (W.word_task if words else S.byte_task)(hot_rows=40)
    covered = [set() for _ in texts]
    for r in R.repeated_ranges(R.texts_of(make_docs(texts, parts=3), id_col="doc_id", text_col="text"), task).collect():
        covered[r.doc].update(range(r.begin, r.end))
    want = brute_words(texts, 35) if words else brute_bytes(texts, 100)
    assert [len(c) for c in covered] == [w[1] for w in want]
    assert len(made) > 1 and max(made[1:]) < most * n, made


def test_bytes_on_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = Q.op9_suffix_dedup(spark, d).collect()
    assert len(rows) == len(texts) and sum(r.n_removed for r in rows) > 0
    check_bytes(rows, [texts[i] for i in range(len(texts))])


def test_words_on_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = Q.op10_substring_dedup(spark, d).collect()
    assert len(rows) == len(texts) and sum(r.n_removed for r in rows) > 0
    check_words(rows, [texts[i] for i in range(len(texts))])


def test_edges(spark, make_docs, as_table):
    texts = EDGES + mosaic(30, "abcd", 9)
    docs = make_docs(texts)
    d = as_table(docs.union(docs).withColumnRenamed("source", "begin"))
    rows = Q.op9_suffix_dedup(spark, d).collect()
    assert len(rows) == 2 * len(texts)
    check_bytes(rows, texts)
    check_words(Q.op10_substring_dedup(spark, d).collect(), texts)
    nothing = as_table(docs.limit(0))
    assert Q.op9_suffix_dedup(spark, nothing).count() == 0 and Q.op10_substring_dedup(spark, nothing).count() == 0
    no_id = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert all(not r.removed for r in S.remove_repeated_bytes(no_id).collect())


def test_cut_texts_keep_columns(spark, make_docs):
    words = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([f"one\n{words} tail", f"two {words}", "left\nas it is", None])
    out = W.without_repeated_passages(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: "one tail", 1: "two", 2: "left\nas it is", 3: None}


def test_one_id_for_different_texts(spark, make_docs):
    """Texts of one id are documents of their own, in order of their md5."""
    body = "".join(random.Random(4).choices("abcdef", k=300))
    texts = ["a" + body, "unlike " * 3 + "".join(random.Random(5).choices("ghij", k=400)), "b " + body, "c " + body, None]
    ids = [1, 1, 1, 2, 1]
    docs = make_docs(texts, ids=ids)
    order = sorted(range(5), key=lambda i: (ids[i], hashlib.md5((texts[i] or "").encode()).hexdigest()))
    want = {texts[i]: b for i, b in zip(order, brute_bytes([texts[i] for i in order], 100), strict=True)}
    got = S.remove_repeated_bytes(docs.union(docs)).collect()
    assert sorted((r.doc_id, r.n_bytes, len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(2 * [(i, want[t][0], want[t][2], want[t][3]) for i, t in zip(ids, texts, strict=True)])
    words = [t and " ".join(t) for t in texts]
    docs = make_docs(words, ids=ids)
    count = {t: n for t, (_, n, _) in zip(words, brute_words(words, 35), strict=True)}
    left = W.without_repeated_passages(docs)
    assert sorted(len((r.text or "").split()) for r in left.collect()) == sorted(len((t or "").split()) - count[t] for t in words)


def test_long_text_with_clashing_columns(spark, make_docs):
    long = "".join(random.Random(6).choices("abcdefgh ", k=3_000_000))
    docs = make_docs([long, "x" + long[1_500_000:1_500_400], "y z"], parts=3)
    for clash in ("ranges", "removed", "base", "doc", "info", "kept", "_ranges", "h"):
        docs = docs.withColumn(clash, docs.source)
    got = {r.doc_id: r for r in S.remove_repeated_bytes(docs).collect()}
    assert [(s.begin, s.end) for s in got[1].removed] == [(1, 401)] and got[0].removed == [] and bytes(got[2].kept) == b"y z"
    cut = W.without_repeated_passages(docs)
    assert cut.columns == docs.columns and cut.count() == 3
    got = {r.doc_id: r for r in W.remove_repeated_passages(docs).collect()}
    assert got[0].n_words == len(long.split())
