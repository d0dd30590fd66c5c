"""Runs against their definition; the query against its contract by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm import periodic_runs as P
from tickspark.llm import queries as Q


def runs_of(w, min_words=6, min_periods=4):
    """Maximal stretches of each period, those whose smallest period it is."""
    n, out = len(w), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            z = i + q
            if z - a >= max(min_words, min_periods * q) and not any(w[a : z - p] == w[a + p : z] for p in range(1, q)):
                out.append((a, z - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_by_definition():
    rng = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randrange(rng.choice([1, 2, 3, 5, 50])) for _ in range(rng.choice([0, 3, 6, 30, 80]))]
            if len(w) > 20 and rng.random() < 0.7:
                a = rng.randrange(len(w))
                p = 1 + (len(w) - a) // rng.randint(3, 10)
                w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
            docs.append(w)
        keys = np.array([x * 2654435761 + 12345 for w in docs for x in w], np.uint64)
        first = np.cumsum([0, *map(len, docs)])
        got = P.find_runs(keys, np.repeat(np.arange(len(docs)), [len(w) for w in docs]))
        assert [tuple(r) for r in got.tolist()] == [(a + int(first[k]), n, q) for k, w in enumerate(docs) for a, n, q in runs_of(w)]


def test_long_runs_and_pairs_in_blocks(monkeypatch):
    monkeypatch.setattr(P, "_PAIRS", 50)
    assert P.find_runs(np.zeros(5000, np.uint64), np.zeros(5000, np.int64)).tolist() == [[0, 5000, 1]]
    keys = np.tile(np.arange(700, dtype=np.uint64), 20)
    assert P.find_runs(keys, np.zeros(len(keys), np.int64)).tolist() == [[0, 14_000, 700]]


def test_colliding_keys_are_found_out(monkeypatch):
    monkeypatch.setattr(P, "keys_of", lambda words: np.array([len(w) for w in words], np.uint64))
    text = P.Text("a b c d e f g ha ha ha ha ha ha ha i")
    runs = P.find_runs(text.keys, np.zeros(len(text.keys), np.int64))
    assert runs.tolist() == [[0, 7, 1], [7, 7, 1]]
    assert P._verified(text, runs, 6, 4).tolist() == [[7, 7, 1]]


def test_rows_of_all_kinds(spark, make_docs, monkeypatch):
    texts = [None, "", " \t\n", "x x x x x", "x  x  x  x  x  x ", "a b a b a b a b", "q a b  a b\na b a b c c c c c c c", "q a b  a b\na b a b c c c c c c c", "w " * 100_000, "z" * 50_000]
    docs = make_docs(texts, ids=[1, 2, 3, 4, 5, 6, 7, 7, None, 9]).withColumns({"runs": F.lit("mine"), "row": F.lit(3), "found": F.lit(4), "starts": F.lit(5)})
    got = P.collapse_runs(docs).collect()
    assert len(got) == len(texts) and {(r.row, r.found, r.starts) for r in got} == {(3, 4, 5)}
    by = {}
    for r in got:
        by.setdefault(r.text, []).append(r)
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = [(0, 100_000, 1)] if len(w) > 1000 else runs_of(w)
        for r in by[t]:
            assert [tuple(x) for x in r.runs] == want
            assert r.collapsed == ("w" if len(w) > 1000 else collapsed(w, want))
    empty = P.collapse_runs(docs.limit(0))
    assert empty.count() == 0 and empty.columns[-2:] == ["runs", "collapsed"]
    with pytest.raises(ValueError):
        P.collapse_runs(docs, 3, 2)


def test_pieces_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(P, "_PIECE", 7)
    text = P.Text(" aa bb  cccccccccccc\td e ")
    assert text.data == b"aa bb cccccccccccc d e" and len(text.keys) == 5 and text.words(1, 3) == b"bb cccccccccccc"


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = Q.op11_periodic_runs(spark, sf).collect()
    assert len(got) == len(texts)
    some = 0
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_of(w)
        some += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)) and r.collapsed_sha256 == sha(collapsed(w, runs))
    assert some > 10
