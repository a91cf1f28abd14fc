"""Packing: every id in one piece, no gaps, little padding, and a plan near the least."""

from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest

from terrafield.llm import packing as P
from terrafield.llm.tokens import byte_encoder, default_path, load_tokenizer

PATH = default_path("byte_bpe_50k.json")


def check(rows, texts, capacity=1024, end=0):
    """All that the contract says of pieces of (doc_id, text); gives the share of padding."""
    tokenizer = load_tokenizer(PATH)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    for i, t in texts:
        wanted[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [end])
    assert set(docs) == set(wanted)
    for i, pieces in docs.items():
        ids = wanted[i]
        assert all(p.doc_tokens in {len(x) for x in ids} for p in pieces)
        assert sorted((p.start, p.length, p.ids_crc32) for p in pieces) == sorted(
            (p.start, p.length, zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes())) for p, x in ((p, ids[0]) for p in pieces)
        ) or len(ids) > 1
        assert sum(p.length for p in pieces) == sum(map(len, ids))
        if len(ids) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.length > 0
                at += p.length
    total = full = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        full += int(P.padded(at, capacity))
    return full / max(total, 1) - 1


def test_pieces(spark, make_docs):
    rng = random.Random(1)
    texts = [(i, "word " * rng.choice([0, 1, 3, 40, 300, 700, 1023, 1024, 3000])) for i in range(120)] + [(200, None), (201, "<|endoftext|> in a text"), (202, "日本語 " * 900)]
    assert check(P.pack(make_docs(texts), PATH).collect(), texts) < 0.02


def test_odd_rows(spark, odd_docs, no_docs):
    assert P.pack(no_docs, PATH).count() == 0
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert check(P.pack(odd_docs, PATH).collect(), texts) < 0.02


def test_query_on_tables(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert check(P.op13_packing(spark, sf).collect(), texts) < 0.01


def test_encoder_equals_library():
    rng, tokenizer, encoder = random.Random(4), load_tokenizer(PATH), byte_encoder(PATH)
    parts = ["the", " road", "  ", "\n", "Straße", "日本", "don't", "12", "<|endoftext|>", "\x00", " \t ", "é", "😀", "_x", "...", "\x1c ", "ﬁ"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_batch(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_program_reaches_the_least():
    """The program's value against the linear program's bound over all patterns of a small capacity."""
    rng = random.Random(9)
    for _ in range(20):
        capacity, lengths = 16, sorted(rng.sample(range(3, 16), 4))
        demand = np.array([rng.randint(1, 40) for _ in lengths])
        program = P._Program(np.array(lengths), demand, capacity)
        program.solve(0, 5000)
        value = float(program.costs @ program.uses)
        prices = program.costs @ program.inverse
        every = [c for k in range(1, 6) for c in combinations_with_replacement(range(4), k) if sum(lengths[i] for i in c) <= capacity]
        assert all(sum(prices[i] for i in c) <= P.padded(sum(lengths[i] for i in c), capacity) + 1e-4 for c in every)  # no column is left that would help
        assert value == pytest.approx(float(prices @ demand))
        assert np.allclose(np.stack(program.columns, axis=1) @ program.uses, demand)


@pytest.mark.parametrize("sample", ["wide", "long", "hot"])
def test_places_hold_every_rest(sample):
    rng = np.random.default_rng(3)
    rests = {"wide": rng.integers(1, 1024, 4000), "long": rng.integers(500, 1024, 4000), "hot": np.concatenate([np.full(3000, 333), rng.integers(1, 1024, 3000)])}[sample]
    lengths, counts = np.unique(rests, return_counts=True)
    plan = P.places(dict(zip(lengths.tolist(), counts.tolist())))
    sequences = defaultdict(list)
    for n, c in zip(lengths.tolist(), counts.tolist()):
        for parts in plan.of(np.full(c, n), np.arange(c)):
            assert sum(p[1] for p in parts) == n
            for _, length, sequence, offset in parts:
                assert 0 <= sequence < plan.sequences
                sequences[sequence].append((offset, length))
    full = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        full += int(P.padded(at, 1024))
    assert full / rests.sum() < 1.016
