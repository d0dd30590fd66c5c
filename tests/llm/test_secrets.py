import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tickspark.llm import queries as Q
from tickspark.llm import secrets as S

KINDS = [
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(KINDS):
        for m in p.finditer(text or ""):
            if (len(m[2]) >= 6) if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def check(got, texts):
    for r in got:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), r
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(x.startswith(kind + ":") for x in want.split(","))


def test_base_spans_on_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = Q.op6_secret_scan(spark, d).collect()
    assert len(got) == len(texts)
    check(got, texts)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0


def test_edges(spark, make_docs, as_table):
    texts = [
        None, "", "secret: token: abcdefgh", "Password = 'hunter22' é token=abc API_KEY:xxxxxx", "AKIA" + "A" * 16, "AKIA" + "A" * 15,
        "0123456789abcdef01234567 " + "f" * 23, "é😀 passwd=" + "x" * 70_000, "token=abcdef " * 300, "ſecret=abcdefg toKen=abcdefg", "secret\n=abcdefg", "secret= \"'abcdefg",
    ]
    docs = make_docs(texts)
    check(Q.op6_secret_scan(spark, as_table(docs.union(docs))).collect(), texts)


def test_linking(spark, make_docs):
    weak = "aB3" + "xY7zQ9" * 6
    texts = [f"blob {weak}", f"user=alice blob {weak}", f"user=alice {'x ' * 400}{weak}", "user=alice", "https://h.example/x user=alice password=hunter22", "https://h.example/x only"]
    got = {r.doc_id: [s.kind for s in r.added] for r in S.scan_secrets(make_docs(texts)).collect()}
    assert got == {0: [], 1: ["weak_id", "weak_secret"], 2: [], 3: [], 4: ["endpoint", "weak_id"], 5: []}


def test_redact(spark, make_docs):
    weak = "aB3" + "xY7zQ9" * 6
    docs = make_docs(["a password=hunter22 b", None, "token=abc", f"é AKIA{'A' * 16} x {weak}.", "token=" + "0123456789abcdef" * 2, f"just {weak}"])
    out = S.redact_secrets(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: "a [SECRET] b", 1: None, 2: "token=abc", 3: "é [SECRET] x [SECRET].", 4: "[SECRET]", 5: f"just {weak}"}
    assert S.redact_secrets(docs.limit(0)).count() == 0


WEAK = {
    "weak_id": re.compile(r"""(?ai)(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{4,})"""),
    "weak_secret": re.compile(r"[A-Za-z0-9+/]{32,}={0,2}"),
    "endpoint": re.compile(r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9._~:/?#@%&=+-]+"""),
}
ORDER = ["assign", "access", "hex", *WEAK]


def naive_added(text, scope):
    """Every weak part against every part."""
    base = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in base_spans(text).split(",") if x)]
    found = {k: [(m.start(), m.end()) for m in p.finditer(text or "")] for k, p in WEAK.items()}
    found["weak_secret"] = [(a, b) for a, b in found["weak_secret"] if all(re.search(c, text[a:b]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
    for k in found:
        found[k] = [(a, b) for a, b in found[k] if not any(a < e and s < b for s, e, _ in base)]
    near = lambda x, parts: any(s < x[1] + scope and e > x[0] - scope for s, e in parts)
    ids = [(s, e) for s, e, k in base if k == "access"] + found["weak_id"]
    weak = [x for x in found["weak_secret"] if near(x, ids)]
    secret = [(s, e) for s, e, k in base if k == "assign"] + weak
    out = [(a, ORDER.index("weak_id"), b) for a, b in found["weak_id"] if near((a, b), secret)] + [(a, ORDER.index("weak_secret"), b) for a, b in weak]
    out += [(a, ORDER.index("endpoint"), b) for a, b in found["endpoint"] if near((a, b), secret) and near((a, b), ids)]
    return base, sorted(out)


def naive_masked(text, base, added):
    at, out = 0, ""
    for a, b in sorted([(s, e) for s, e, _ in base] + [(a, b) for a, k, b in added if ORDER[k] == "weak_secret"]):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def random_parts(pick, n):
    blob = lambda k: "".join(pick.choice("abcXYZ0189+/") for _ in range(k))
    part = [
        lambda: f"user={blob(6)}", lambda: f"client_id: {blob(9)}", lambda: blob(pick.randint(30, 50)), lambda: f"https://{blob(8)}.example/{blob(5)}", lambda: f"password={blob(pick.randint(3, 12))}",
        lambda: "AKIA" + "".join(pick.choice("ABC123") for _ in range(pick.randint(14, 20))), lambda: "".join(pick.choice("0123abcdef") for _ in range(pick.randint(20, 40))), lambda: "é😀 " * pick.randint(0, 20), lambda: "word " * pick.randint(0, 30),
        lambda: f"token={blob(4)}&secret=0123456789abcdef01234567{blob(3)}", lambda: f"https://u/password={blob(8)}",
    ]
    return pick.choice(["", " ", ""]).join(pick.choice(part)() + pick.choice([" ", "", ";"]) for _ in range(n))


@pytest.mark.parametrize("chunk, chars, scope", [(256, 4096, 300), (3, 50, 40), (1, 7, 0)])
def test_linked_spans_and_masks_against_naive_join(spark, make_docs, monkeypatch, chunk, chars, scope):
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "MASK_CHARS", chars)
    pick = random.Random(chunk)
    texts = [random_parts(pick, pick.randint(0, 40)) for _ in range(150)]
    docs = make_docs(texts)
    want = [naive_added(t, scope) for t in texts]
    assert sum(len(a) for _, a in want) > 20
    for r in S.scan_secrets(docs, scope_chars=scope).collect():
        assert [(s.start, ORDER.index(s.kind), s.end) for s in r.added] == want[r.doc_id][1], texts[r.doc_id]
    for r in S.redact_secrets(docs, scope_chars=scope).collect():
        assert r.text == naive_masked(texts[r.doc_id], *want[r.doc_id])


def test_five_megabytes_of_parts(spark, make_docs):
    pick = random.Random(9)
    some = random_parts(pick, 3000)
    text = " ".join([some] * (5_000_000 // len(some)))
    began = time.time()
    (r,) = S.redact_secrets(make_docs([text], parts=1)).collect()
    assert time.time() - began < 120
    base, added = naive_added(some, 300)
    assert r.text.count("[SECRET]") > 0.9 * (len(text) // len(some)) * naive_masked(some, base, added).count("[SECRET]")


def test_odd_tables(spark, make_docs, as_table):
    docs = make_docs(["token=abcdefgh", None, ""])
    for clash in ("spans", "base", "added", "_text", "assign", "_0", "masks"):
        docs = docs.withColumn(clash, F.lit("x"))
    check(Q.op6_secret_scan(spark, as_table(docs.union(docs))).collect(), ["token=abcdefgh", None, ""])
    out = S.redact_secrets(docs.union(docs))
    assert out.columns == docs.columns and sorted(str(r.text) for r in out.collect()) == ["", "", "None", "None", "[SECRET]", "[SECRET]"]
    assert Q.op6_secret_scan(spark, as_table(docs.limit(0))).count() == 0 and S.redact_secrets(docs.limit(0)).count() == 0
