"""Benchmark decontamination: windows of ten words of test items, looked for in training texts.

The normalised test windows travel as a broadcast hash set of bounded bytes. A benchmark that
needs more is dealt into several sets; each is broadcast for one pass over the documents and
dropped after it, and what the passes find is put together. A hit of hashes is verified word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _PLAIN, by_position, map_rows, materialise, plain_words, read_table

WINDOW = 10
#: Bytes of one broadcast set, as it is held by a worker: its arrays, and its words at ``WORD_BYTES`` each besides their letters.
SET_BYTES = 64 << 20
WORD_BYTES = 150

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` ids."""
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ ids[k : len(ids) - n + 1 + k]) * _MUL
            out ^= out >> np.uint64(29)
    return out


class WindowSet:
    """All windows of some items; finds where they occur in a text.

    For each window size: the distinct windows as rows of word numbers in order of their hash, and
    for each the items that have it, one row of windows after another.
    """

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = sorted({_item_key(item) for item, _ in items})
        number = {item: k for k, item in enumerate(self.items)}
        runs: dict[int, list[np.ndarray]] = {}
        holders: dict[int, list[np.ndarray]] = {}
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in plain_words(text)], dtype=np.uint32)
            if size := min(window, len(ids)):
                runs.setdefault(size, []).append(np.lib.stride_tricks.sliding_window_view(ids, size))
                holders.setdefault(size, []).append(np.full(len(ids) - size + 1, number[_item_key(item)], dtype=np.int64))
        self.sizes = []
        for size, parts in sorted(runs.items()):
            distinct, which = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
            hashes = _rolling(distinct.astype(np.uint64).ravel(), size)[::size]
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            pairs = np.unique(place[which.ravel()] * len(self.items) + np.concatenate(holders[size]))
            starts = np.searchsorted(pairs, np.arange(len(order) + 1) * len(self.items))
            self.sizes.append((size, hashes[order], distinct[order], starts, (pairs % len(self.items)).astype(np.uint32)))

    def nbytes(self) -> int:
        return sum(len(w) + WORD_BYTES for w in self.vocabulary) + sum(x.nbytes for _, *arrays in self.sizes for x in arrays)

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside an occurrence of a window, and the items with occurring windows."""
        hit, items = np.zeros(len(words), dtype=bool), set()
        if not words or not self.sizes:
            return hit, items
        get = self.vocabulary.get
        ids = np.fromiter([get(w, 0) for w in words], dtype=np.uint64, count=len(words))
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, hashes, distinct, first, holders in self.sizes:
            if size > len(ids):
                continue
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])  # runs of known words only
            if not len(starts):
                continue
            rows = np.zeros(len(starts), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for k in range(size):
                    rows = (rows ^ ids[starts + k]) * _MUL
                    rows ^= rows >> np.uint64(29)
            at = np.searchsorted(hashes, rows)
            while True:  # windows that share a hash follow each other
                same = at < len(hashes)
                same[same] = hashes[at[same]] == rows[same]
                starts, rows, at = starts[same], rows[same], at[same]
                if not len(starts):
                    break
                good = (distinct[at] == ids[starts[:, None] + np.arange(size)]).all(axis=1)  # verified word by word
                for s, w in zip(starts[good].tolist(), at[good].tolist()):
                    hit[s : s + size] = True
                    items.update(self.items[i] for i in holders[first[w] : first[w + 1]].tolist())
                starts, rows, at = starts[~good], rows[~good], at[~good] + 1
        return hit, items


def _item_key(item) -> str:
    return "" if item is None else str(item)


def window_sets(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text", set_bytes: int = SET_BYTES) -> Iterator[WindowSet]:
    """The items in sets of at most ``set_bytes`` (or of one item), streamed through the driver one set at a time; one empty set for none."""
    batch, size, words, made = [], 0, set(), False
    for row in benchmark.select(F.col(item_id), F.col(text)).toLocalIterator():
        own = plain_words(row[1])
        new = set(own) - words
        # A window takes its word numbers, a hash, a start and (at least) one holder.
        more = len(own) * (4 * window + 20) + sum(len(w) + WORD_BYTES for w in new)
        if batch and size + more > set_bytes:
            yield WindowSet(batch, window)
            batch, size, words, made = [], 0, set(), True
            more = len(own) * (4 * window + 20) + sum(len(w) + WORD_BYTES for w in set(own))
        batch.append((row[0], row[1]))
        size += more
        words.update(own)
    if batch or not made:
        yield WindowSet(batch, window)


SCHEMA = "n_words bigint, hits binary, items array<string>"
_NAMES = ["uid", "doc_id", "n_words", "hits", "items"]


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", set_bytes: int = SET_BYTES) -> DataFrame:
    """Every document with its words hit by benchmark windows.

    Returns doc_id, n_words, hits (a packed bit per word, empty if none) and items (item ids as
    strings, sorted). Null texts have no words; items without words have no windows; an empty benchmark
    hits nothing, and no documents give no rows. Texts of any length are scanned whole. Repeated
    documents are reported each, repeated items once; items with null ids count as one, named by
    the empty string. Columns are taken by name and others ignored, whatever they are called.
    Beyond one set of ``set_bytes`` the texts are written with a number a row, once, and that table is read
    once a set, so sets agree on the rows whatever Spark does between them.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sets = window_sets(benchmark, window, item_id, item_text, set_bytes)
    first, second = next(sets), next(sets, None)
    if second is not None:
        rows = materialise(rows, "numbered-texts")
    return _found(rows, chain([first], [second] if second is not None else [], sets)).drop("uid")


def _found(rows: DataFrame, sets: Iterable[WindowSet]) -> DataFrame:
    """Rows (uid, doc_id, text) with their hits; the same rows for each set if there are several."""
    spark, kind = rows.sparkSession, rows.schema["doc_id"].dataType.simpleString()
    schema, more, found, shared = f"uid bigint, doc_id {kind}, {SCHEMA}", None, None, None
    for windows in sets:
        if found is not None:  # another set: what was found with the one before is written, and that set dropped
            part = materialise(found, "windows")
            shared.destroy()
            more = [part] if more is None else [*more, part]
        shared = spark.sparkContext.broadcast(windows)
        found = rows.mapInArrow(_scanner(shared), schema)
        if more is not None:
            found = found.filter(F.size("items") > 0)
    if more is None:
        return found
    hits = found.select("uid", "hits", "items")
    for part in more[1:]:
        hits = hits.union(part.select("uid", "hits", "items"))
    by_row = hits.groupBy("uid").agg(F.collect_list("hits").alias("more_hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("more_items"))  # at most one a set
    joined = more[0].join(by_row, "uid", "left").select(*_NAMES, F.coalesce("more_hits", F.array()).alias("more_hits"), F.array_sort(F.array_union("items", F.coalesce("more_items", F.array().cast("array<string>")))).alias("all_items"))

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for own, others in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist()):
                marks.append(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in (own, *others) if x]).tobytes() if own or others else b"")
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(marks, pa.binary()), batch.column(6)], _NAMES)

    return joined.mapInArrow(together, schema)


def _scanner(shared):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        for batch in batches:
            n_words, marks, items = [], [], []
            for text in batch.column(2).to_pylist():
                words = plain_words(text)
                hit, found = windows.occurrences(words)
                n_words.append(len(words))
                marks.append(np.packbits(hit).tobytes() if found else b"")
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(marks, pa.binary()), pa.array(items, pa.list_(pa.string()))], _NAMES)

    return scan


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined), contaminated."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit = [int.from_bytes(h, "big").bit_count() for h in batch.column(2).to_pylist()]
            items = batch.column(3).to_pylist()
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests), pa.array([n > 0 for n in n_hit])],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.mapInArrow(count, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "documents", text: str = "text", item_id: str = "item_id", item_text: str = "text", set_bytes: int = SET_BYTES) -> DataFrame:
    """The documents without what benchmark windows hit, with their own columns.

    ``remove="documents"`` drops every document with a hit. ``remove="spans"`` keeps it and cuts
    each run of hit words (with what stands between them) out of its text. Null and empty texts are
    kept, an empty benchmark removes nothing, and repeated documents are judged each. Texts of any length are
    scanned whole. Other columns are handed on, whatever they are called.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    spark, at = docs.sparkSession, docs.columns.index(text)
    sets = window_sets(benchmark, window, item_id, item_text, set_bytes)
    windows = next(sets)
    following = next(sets, None)
    if following is not None and remove == "spans":  # all sets are looked for in the text as it was
        row, names = by_position(docs), docs.columns
        numbered = materialise(row.select(F.monotonically_increasing_id().alias("uid"), F.struct(*row.columns).alias("row")), "numbered-documents")
        texts = numbered.select("uid", F.lit(None).cast("bigint").alias("doc_id"), F.col("row")[row.columns[at]].alias("text"))
        found = _found(texts, chain([windows, following], sets)).filter(F.size("items") > 0).select("uid", "hits")
        joined = numbered.join(found, "uid", "left").select("hits", "row")

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = batch.column(1).flatten()
                texts = columns[at].to_pylist()
                for i, marks in enumerate(batch.column(0).to_pylist()):
                    if marks:
                        texts[i] = cut_spans(texts[i], np.unpackbits(np.frombuffer(marks, np.uint8), count=len(plain_words(texts[i]))).astype(bool))
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, [f"_{k}" for k in range(len(columns))])

        return joined.mapInArrow(cut, row.schema).toDF(*names)
    while True:
        shared = spark.sparkContext.broadcast(windows)
        docs = map_rows(docs, _remover(shared, at, remove))
        if following is None:
            return docs
        docs = materialise(docs, "decontaminated")
        shared.destroy()
        windows, following = following, next(sets, None)


def _remover(shared, at: int, remove: str):
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            hits: dict[int, np.ndarray] = {}
            for i, t in enumerate(texts):
                hit, items = windows.occurrences(plain_words(t))
                if items:
                    hits[i] = hit
            if remove == "documents":
                yield batch.filter(pa.array([i not in hits for i in range(len(texts))], pa.bool_()))
            else:
                for i, hit in hits.items():
                    texts[i] = cut_spans(texts[i], hit)
                yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return keep


def cut_spans(text: str, hit: np.ndarray) -> str:
    """The text without each run of hit words."""
    raw = text.encode("utf-8", "surrogatepass")
    blank = np.frombuffer(raw.translate(_PLAIN), dtype=np.uint8) == 32
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out, at = [], 0
    for a, b in zip(turn[0::2].tolist(), turn[1::2].tolist()):
        out.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_windows(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS run
       FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS run
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT dw.doc_id, dw.size, dw.i, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.run = bw.run),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       coalesce(items.h, sha256('')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
