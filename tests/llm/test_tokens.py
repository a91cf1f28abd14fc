"""Token files, counts and SentencePiece against their libraries, brute force and round trips."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafield.llm import sentencepiece_nbest as sp
from terrafield.llm import simple8b, token_counts, tokens
from terrafield.llm.tokens import default_path

WORD, BYTE, PIECE = (default_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = st.text(st.one_of(st.sampled_from(" \n\t'ab1.İΣé<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=700))
def test_pack_round_trip(values):
    values = np.array(values, dtype=np.uint64)
    words, offsets, at, escaped = simple8b.pack(values, 256)
    out = simple8b.unpack(words)
    out[at.astype(int)] = escaped
    assert (out == values).all()
    assert len(offsets) == -(-len(values) // 256) + 1 and offsets[-1] == len(words)


def test_pack_takes_few_words():
    assert len(simple8b.pack(np.zeros(2400, np.uint64), 240)[0]) == 10
    assert len(simple8b.pack(np.full(600, 7, np.uint64), 600)[0]) == 30


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_cached_tokenizers_equal_the_library(text):
    words, counter = tokens.word_encoder(WORD), tokens.byte_counter(BYTE, {}, "t")
    assert words.encode_batch([text]) == [np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert counter.count_batch([text]) == [len(counter.tokenizer.encode(text, add_special_tokens=False).ids)]


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "a  b   c \n d  ", "IT'S ΣΑΣ İ", "a\x1cb \x85 c", " \n", "x " * 3])
def test_special_strings_and_white_space(text):
    test_cached_tokenizers_equal_the_library.hypothesis.inner_test(text)


def test_caches_stay_bounded():
    cache = tokens.RecentCache(10)
    for i in range(100):
        cache.turn()
        cache.new[i] = 1
        cache.new[-1] = cache.new.get(-1) or cache.lift(-1) or 7
    assert len(cache.new) + len(cache.old) <= 14 and cache.new[-1] == 7


def brute_ids(rows):
    library = tokens.load_tokenizer(WORD)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [tuple(r) for r in simple8b.token_ids(odd_docs, WORD, 2).collect()]
    key = lambda r: r[1]
    assert sorted(got, key=key) == brute_ids(rows)


def test_token_files_of_nothing(no_docs):
    assert simple8b.token_ids(no_docs, WORD, 2).collect() == []


def test_token_file_blocks(tmp_path):
    writer = simple8b.TokenFileWriter(f"file://{tmp_path}/a.s8b", 128)
    values = np.random.default_rng(1).integers(0, 49000, 1000).astype(np.uint64)
    values[500] = 2**62
    writer.add(1, values[:300])
    writer.add(None, values[300:])
    writer.close()
    reader = simple8b.TokenFileReader(f"file://{tmp_path}/a.s8b")
    assert (reader.blocks(3, 5) == values[384:640]).all()
    docs = [(d, np.concatenate(p)) for d, p in reader.documents()]
    assert [d for d, _ in docs] == [1, None] and (np.concatenate([v for _, v in docs]) == values).all()


def test_counts(odd_docs, no_docs):
    library = tokens.load_tokenizer(BYTE)
    got = sorted(map(tuple, token_counts.token_counts(odd_docs, BYTE, 10).collect()), key=repr)
    want = [(r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 10) for r in odd_docs.collect()]
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, BYTE).collect() == []


def test_frequent_chunks_are_of_all_rows(spark, monkeypatch):
    """the table is chosen by the counts of all rows, however many, and of every chunk of them."""
    rare = [f"word{i}" for i in range(300)]
    docs = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 100 = 7 THEN concat('a word', id DIV 100) ELSE 'a b b' END AS text")
    library = tokens.load_tokenizer(BYTE)
    want = {c: len(library.encode(c, add_special_tokens=False).ids) for c in ("a", " b", *(" " + w for w in rare))}
    assert token_counts.frequent_lengths(docs, BYTE) == want
    # Counts that tasks hand on in parts add up.
    monkeypatch.setattr(token_counts, "HELD", 2)
    assert token_counts.frequent_lengths(docs, BYTE) == want
    assert token_counts.frequent_lengths(docs, BYTE, 1) == {" b": want[" b"]}
    texts = [(0, "c " + "x" * 65), (1, None), (2, "a\x1c d"), (3, "c")]
    assert token_counts.frequent_lengths(spark.createDataFrame(texts, "doc_id int, text string"), BYTE) == {"c": 1, "": 0}


def brute_segmentations(text, n):
    model, out = sp.encoder(PIECE).model, []
    edges: dict = {}
    for end, into in enumerate(model.lattice(" " + text)[1]):
        for begin, ids, score in into:
            edges.setdefault(begin, []).append((end, ids, score))

    def go(at, score, ids):
        if at == len(text) + 1:
            out.append((score, ids))
            return
        for e in edges[at]:
            go(e[0], score + e[2], ids + e[1])

    go(0, 0, b"")
    return sorted(out, key=lambda x: -x[0])[:n]


@pytest.mark.parametrize("text", ["the cat", "a  b", "été.", "x².", " a", "日本x", "▁z", "a\n\nb", "then in", "tr!!", "\0a b", "of on"])
def test_n_best_is_exact(text):
    got = sp.encoder(PIECE).encode(text, 5)
    assert [s for s, _ in got] == [s for s, _ in brute_segmentations(text, 5)]
    assert len({i for _, i in got}) == len(got)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_pieces_round_trip(text):
    own = sp.encoder(PIECE)
    for _, ids in own.encode(text, 3):
        assert own.decode(np.frombuffer(ids, "<u4")) == text


def test_the_queue_knows_the_next_score():
    own = sp.encoder(PIECE)
    for unit in (" international", " thereof", "zzz", " a", "日"):
        lattice = own.model.lattice(unit)
        found, _ = sp.a_star(*lattice, 9)
        for count in range(1, len(found) + 1):
            some, following = sp.a_star(*lattice, count)
            assert some == found[:count] and (count == len(found) or following == found[count][0])
    assert sp.a_star(*own.model.lattice("日"), 1)[1] == -sp.NEVER


def test_very_long_word():
    own = sp.encoder(PIECE)
    text = "ab" * 60_000
    ((score, ids),) = own.encode(text, 1)
    assert own.decode(np.frombuffer(ids, "<u4")) == text and score < 0


def test_sentencepiece_tables(odd_docs, no_docs):
    encoded = sp.encode(odd_docs, PIECE, 3)
    rows = encoded.collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    own = sp.encoder(PIECE)
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for r in rows:
        best = own.encode(texts[r.doc_id], 3)
        assert [(round(s.score * 1e6), s.ids_crc32, np.array(s.ids, "<u4").tobytes()) for s in r.segmentations] == [(s, zlib.crc32(i), i) for s, i in best]
        assert (r.n_pieces, r.ids_crc32, round(r.score * 1e6)) == (len(best[0][1]) // 4, zlib.crc32(best[0][1]), best[0][0])
        assert r.gap == (pytest.approx((best[0][0] - best[1][0]) / 1e6) if len(best) > 1 else None)
    best = {r.doc_id: r.ids for r in sp.encode(odd_docs, PIECE, 3, ids="best").collect()}
    assert best == {r.doc_id: r.segmentations[0].ids for r in rows}
    encoded = encoded.selectExpr("doc_id", "segmentations[0].ids as ids")
    texts = sorted((r.doc_id or -1, r.text) for r in sp.decode(encoded, PIECE).collect())
    assert texts == sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert sp.encode(no_docs, PIECE).collect() == []
