"""Periodic runs against trying every period, whole queries against the contract's own words."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from fractions import Fraction

import pytest

from terrafield.llm import periodic_runs as P


def brute(w, least, times):
    """Every period tried at every place."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, times * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, p) for (s, e), p in found.items())


def made(rng):
    """A sequence with repeats inside repeats."""
    n, letters, w = rng.randint(0, 140), rng.choice([1, 2, 2, 3, 5]), []
    while len(w) < n:
        if w and rng.random() < 0.5:
            s = rng.randrange(len(w))
            w += w[s : s + rng.randint(1, 20)] * rng.randint(1, 6)
        else:
            w += [rng.randrange(letters)] * rng.randint(1, 4)
    return w


def test_runs_equal_brute_force():
    rng, seen = random.Random(7), 0
    for _ in range(1500):
        w, (least, times) = made(rng), rng.choice([(1, 2), (4, 2), (6, 3), (24, 3), (10, 4)])
        want = brute(w, least, times)
        assert P.runs_of(w, least, times) == want
        assert P.word_runs([b"%d" % x for x in w], least, times) == want
        seen += len(want)
    assert seen > 1000


def test_factors_cover_and_are_longest():
    rng = random.Random(3)
    for _ in range(200):
        w = made(rng)
        at = 0
        for b, m, source in P.factors(w):
            assert b == at
            if source >= 0:
                assert source < b and w[source : source + m] == w[b : b + m]
            longest = max((k for s in range(b) for k in range(len(w) - b + 1) if w[s : s + k] == w[b : b + k]), default=0) if len(w) < 40 else None
            assert longest is None or m == max(longest, 1)
            at += m
        assert at == len(w)


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 24, 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_contract(spark, tmp_path):
    looping = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "road", "Ünï"]) for _ in range(rng.choice([0, 1, 5, 90, 300])))) for i in looping]
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "x " * 23), (1004, "x " * 24), (1005, "one two three " * 9 + "one"), (1006, "so so " * 30), (1007, "ab\x1fab\x0b" * 40)]
    rows += [(1008, "p q r s t u v w x " * 5 + "y " * 30 + "p q " * 40), (1008, "p q r s t u v w x " * 5 + "y " * 30 + "p q " * 40), (1009, "the long road " * 4000)]
    spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in rows], "doc_id bigint, text string, runs string, w bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in P.op12_periodic_runs(spark, str(tmp_path)).collect())
    short = [r for r in rows if len(r[1] or "") < 20000]
    assert [r for r in got if r[0] != 1009] == sorted(contract(*r) for r in short)
    long = next(r for r in got if r[0] == 1009)
    assert long[1:6] == (1, 0, 12000, 3, 4_000_000) or zlib.crc32(b"1009") % 10 == 0


def test_query_equals_contract_on_tables(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in P.op12_periodic_runs(spark, sf).collect()}
    assert all(got[d] == contract(d, t) for d, t in docs)


def test_odd_rows(spark, odd_docs, no_docs):
    assert P.periodic_runs(no_docs).count() == 0
    rows = P.periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r for r in rows}
    assert of[1].runs == [] and of[1].collapsed == "" and of[2].collapsed == "" and of[None].collapsed == "no id"
    assert [tuple(r) for r in of[7].runs] == [(0, 20000, 5)] and of[7].collapsed == "the long road of words"
    with pytest.raises(ValueError):
        P.periodic_runs(odd_docs, times=1)
