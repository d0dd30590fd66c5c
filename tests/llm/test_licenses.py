"""Places of notices against edit distances of all stretches of words; the query's base against plain words."""

import random
import re

from pyspark.sql import functions as F

from tickspark.llm import licenses as L
from tickspark.llm import queries as Q


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def least_edits(words, wanted):
    """By notice, over all stretches of whole words within its bound."""
    out = {}
    for n in wanted:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                s = " ".join(words[i:j])
                if len(s) > len(n.text) + n.edits:
                    break
                if len(s) >= len(n.text) - n.edits and (d := distance(s, n.text)) <= min(n.edits, out.get(n.text, 99)):
                    out[n.text] = d
    return out


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def base_of(words):
    return [(i, label) for label, phrase in L.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]


def test_places_by_edit_distance():
    rng, wanted = random.Random(11), L.notices()
    search = L.Search(wanted)
    for _ in range(120):
        text = " ".join(rng.choice(["foo", "the", "license", "under", "ba", "éa", "x1"]) for _ in range(rng.randint(0, 6)))
        for _ in range(rng.randint(1, 2)):
            s = list(rng.choice(wanted).text)
            for _ in range(rng.randint(0, 5)):
                i = rng.randrange(len(s))
                s[i : i + rng.randint(0, 1)] = rng.choice(["", rng.choice("abceglnoé "), s[i]])
            text += " " + "".join(s) + " " + rng.choice(["foo", "the", ""])
        plain = " ".join(text.split())
        got = {}
        for a, z, k, e in search.places(plain):
            assert distance(plain[a:z], wanted[k].text) == e
            got[wanted[k].text] = min(got.get(wanted[k].text, 99), e)
        assert got == least_edits(plain.split(), wanted)


TEXTS = [
    None, "", "...", "Released UNDER the  MIT-License.", "cc_by.nc CC-BY-NC; cc by ncx", "Apache License, Version 2.0 and apache licence version 2",
    "ünder the mit license", "Éunder the mit license under the mit license", "undor the mit license", "All rights\nreserved", "under the mit license" * 3,
    "under the " * 40_000 + "mit license", "no " * 20_000, "İ under the mit license", "a b c d e f g",
]


def test_rows_of_all_kinds(spark, make_docs, as_table):
    docs = make_docs([*TEXTS, TEXTS[3]], ids=[*range(len(TEXTS)), 3]).withColumns({"places": F.lit("mine"), "row": F.lit(3), "Found": F.lit(4)})
    got = Q.op13_license_scan(spark, as_table(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        words = words_of(TEXTS[r.doc_id])
        base = base_of(words)
        at = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(base), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and (r.score == 1.0 or not base)
    by = {r.doc_id: r for r in got}
    assert by[8].labels == "mit" and by[8].n_base == 0 and abs(by[8].score - 20 / 21) < 1e-9
    assert by[9].labels == "proprietary" and by[14].labels == "" and by[14].score == 0.0
    places = {r.doc_id: r.places for r in L.scan_licenses(docs.filter("doc_id in (3, 7, 9)")).collect()}
    assert [TEXTS[3][p.start : p.end] for p in places[3]] == ["UNDER the  MIT-License"]
    assert [TEXTS[9][p.start : p.end] for p in places[9]] == ["All rights\nreserved"]
    assert "under the mit license" in [TEXTS[7][p.start : p.end] for p in places[7]]
    assert L.scan_licenses(docs.limit(0)).count() == 0


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op13_license_scan(spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_base for r in got) > 0
    wanted = L.notices()
    for r in got:
        words = words_of(texts[r.doc_id])
        base = base_of(words)
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(base), ",".join(sorted({label for _, label in base})))
        if r.labels or r.doc_id % 40 == 0:
            edits = least_edits(words[:400], wanted) if len(words) <= 400 else None
            if edits is not None:
                assert r.labels == ",".join(sorted({n.label for n in wanted if n.text in edits}))
