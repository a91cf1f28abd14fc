"""Token counts of whole texts by a map-side look-up in two tiers.

Tier one is a broadcast table of the most frequent pre-token chunks (what stands between two spaces)
of all rows and their lengths in tokens; tier two is a worker's own cache, which the tokenizer fills.
To choose the table, tasks add up the chunks they read and hand on a count for each distinct one,
which are summed exactly; texts are counted in the task that reads them, and no occurrence of a chunk
is shuffled. Which chunks the table holds changes speed alone, never a count.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ZSTD, at_most, drop_scratch, materialise, pieces, read_table, settings
from .tokens import LONGEST_KEPT, ByteCounter, byte_counter, default_path

#: Entries of the broadcast table, and distinct chunks at which a task hands its counts on and starts anew.
FREQUENT = 20_000
HELD = 300_000


def _chunk_counts(tokenizer_path: str):
    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each chunk of at most 64 letters occurs in a task's texts, in one part or several; texts that go to the library whole look nothing up."""
        counter = ByteCounter(tokenizer_path)
        counts: Counter[str] = Counter()

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["chunk", "n"])

        for batch in batches:
            for _, texts in pieces(batch, 0):
                for text in texts:
                    counts.update([c for c in counter.chunks_of(text) or () if len(c) <= LONGEST_KEPT])
                if len(counts) >= HELD:
                    yield part()
                    counts.clear()
        if counts:
            yield part()

    return add_up


def _chunk_lengths(tokenizer_path: str):
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ByteCounter(tokenizer_path)
        for batch in batches:
            lengths = counter.count_batch(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["chunk", "length"])

    return measure


def frequent_lengths(docs: DataFrame, tokenizer_path: str, size: int = FREQUENT, text: str = "text") -> dict[str, int]:
    """The table of tier one: the most frequent chunks of all rows, at most ``size`` of at most 64 letters (a few MB)."""
    parts = docs.select(F.col(text)).mapInArrow(_chunk_counts(tokenizer_path), "chunk string, n bigint")
    with settings(docs.sparkSession, **ZSTD):
        counts = materialise(parts.groupBy("chunk").agg(F.sum("n").alias("n")), "chunk-counts")
    top = at_most(counts, "n", size).select("chunk").mapInArrow(_chunk_lengths(tokenizer_path), "chunk string, length bigint")
    table = {r.chunk: r.length for r in top.collect()}
    drop_scratch(counts)
    return table


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every row.

    Null counts as the empty text: no bytes, no tokens. Special strings inside texts are what
    the library makes of them. Texts of any length are counted whole; repeated rows are counted
    each; a null doc_id stays null; an empty table gives an empty one. Columns are taken by
    name and others ignored, whatever they are called.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer_path, text=text))
    key = uuid.uuid4().hex

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = byte_counter(tokenizer_path, table.value, key)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                n_tokens = counter.count_batch(texts)
                n_bytes = [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens])],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), 1024)
