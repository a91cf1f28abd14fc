"""Alignments against whole texts encoded by the libraries and every pair of tokens compared."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import pytest

from terrafield.llm import alignment as A
from terrafield.llm.tokens import default_path

PATHS = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")


def spans(ids, names):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(names[i]), i))
        at += len(names[i])
    return out


def brute(texts):
    """Contract rows of whole texts."""
    pair, per = A.Pair(*PATHS), []
    for text in texts:
        a, b, same = pair.encode([text])[0] if text else ([], [], False)
        a, b = (spans(a, pair.bytes_a), spans(b, pair.bytes_b)) if same else ([], [])
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        of = lambda side, lo, hi: ",".join(str(i) for s, e, i in side if lo < e <= hi)
        groups = ";".join(f"{of(a, lo, hi)}|{of(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts))
        per.append((len(a), len(b), len(cuts), links, groups))
    count = Counter(x for p in per for x in p[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    return [(na, nb, ng, len(x), sum(count[y] == best[y[1]] for y in x), sum(count[y] for y in x), digest(g)) for na, nb, ng, x, g in per]


def made(rng):
    words = ["the", "long", "road", "Straße", "日本語", "naïve", "x" * 40, "don't", "12345", "a▁b", "<s>", "<|endoftext|>", "ﬁn", "😀😀", " ", "é", "zqxjkvb"]
    weights = [9, 9, 9, 3, 3, 3, 1, 3, 3, 0.1, 1, 1, 1, 2, 0.5, 1, 3]
    glue = [" ", " ", " ", " ", "  ", "\n", " \n ", "\t", "\x00 ", " 　", ""]
    return "".join(w + rng.choice(glue) for w in rng.choices(words, weights, k=rng.randint(0, 30)))


def test_stretches_are_cut_where_both_cut():
    rng, pair = random.Random(2), A.Pair(*PATHS)
    for _ in range(1500):
        text = made(rng)
        parts = A.stretches(text)
        assert " ".join(parts) == text
        if text:
            whole, cut = pair.encode([text])[0], pair.encode(parts)
            assert whole == ([i for a, _, _ in cut for i in a], [i for _, b, _ in cut for i in b], all(s for *_, s in cut))


@pytest.mark.parametrize(("frequent", "pairs"), [(A.FREQUENT, A.BROADCAST_PAIRS), (5, 0)])
def test_equals_brute_force(spark, make_docs, frequent, pairs):
    rng = random.Random(11)
    texts = [made(rng) for _ in range(150)] + [None, "", " ", "   ", "a▁b the road", "the", "the", " lead", "tail ", "\n"]
    docs = make_docs(enumerate(texts))
    found = {r.doc_id: r for r in A.align(docs, *PATHS, frequent=frequent, broadcast_pairs=pairs).documents.collect()}
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    for i, want in enumerate(brute(texts)):
        r = found[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, digest(r.groups)) == want, texts[i]


def test_odd_rows(spark, odd_docs, no_docs):
    empty = A.align(no_docs, *PATHS)
    assert empty.documents.count() == 0 and empty.pairs.count() == 0
    got = A.align(odd_docs, *PATHS).documents.collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert len(got) == odd_docs.count()
    of = {r.doc_id: r for r in got}
    assert (of[1].n_a, of[1].groups, of[2].n_b, of[2].groups) == (0, "", 0, "")
    pair = A.Pair(*PATHS)
    assert of[7].n_a == len(pair.encode([texts[7]])[0][0]) and of[7].groups.count(";") == of[7].n_groups - 1
    assert of[9].n_a == 0 and of[None].n_a > 0  # a U+2581 of its own does not come back


def test_query_equals_brute_force_on_tables(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 3000 or text is null").orderBy("doc_id")  # each pair of tokens is compared
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in A.op11_alignment(spark, str(tmp_path)).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(found) == len(rows) and [found[r.doc_id] for r in rows] == brute([r.text for r in rows])
