"""Exact top-k by inner product, with MaxScore's bounds.

Each dimension of a query is a term; a shard's column for it, less the least contribution in
the shard, is that term's posting list of non-negative impacts, and its largest impact the
term's bound. Terms are taken in falling order of bound. Those whose bounds, put together,
could not lift a vector over the k-th best score so far are non-essential: essential postings
are traversed in full, and the others are probed only for vectors that can still compete.

So that terms are non-essential from the first shard on, each query starts with a floor: its
k-th best score among a bounded sample of the vectors, which no result can fall short of.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialise, read_table

#: Rows of a shard, and bytes of queries in one broadcast block.
SHARD_ROWS = 4096
BLOCK_BYTES = 32 << 20
#: Vectors that the first floors are taken from, chosen by the hash of their id; a larger sample changes speed alone.
SAMPLE_ROWS = 2048
#: Terms probed between two checks of what can still compete.
PROBE_STEP = 8


def _quantise(vectors: list, scale: float) -> np.ndarray:
    """floor(scale * x) of valid vectors of one length."""
    return np.floor(scale * np.array(vectors, dtype=np.float64))


def valid(vector) -> bool:
    return vector is not None and not any(x is None or x != x or x in (float("inf"), float("-inf")) for x in vector)


class Query:
    """A query's terms against one shard's bounds."""

    def __init__(self, weights: np.ndarray, low: np.ndarray, high: np.ndarray):
        least = np.minimum(weights * low, weights * high)
        bound = np.maximum(weights * low, weights * high) - least
        self.order = np.argsort(-bound, kind="stable")
        self.weights = weights[self.order]
        self.base = float(least.sum())
        #: Most that the terms from the i-th on can add, over their least.
        self.rest = np.append(np.cumsum(bound[self.order][::-1])[::-1], 0.0)
        self.least = least[self.order]

    def search(self, postings: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the shard whose score may reach ``floor``, and their exact scores."""
        n_terms = len(self.weights)
        essential = n_terms if floor == -np.inf else int(np.searchsorted(-(self.base + self.rest[:-1]), -floor, side="right"))
        #: Postings traversed or probed so far, for comparison with terms times rows.
        self.visited = essential * postings.shape[1]
        if essential == 0:
            return np.zeros(0, np.int64), np.zeros(0)
        scores = self.base + self.weights[:essential] @ postings[self.order[:essential]] - self.least[:essential].sum()
        rows = np.arange(postings.shape[1])
        at = essential
        while at < n_terms:
            stay = scores + self.rest[at] >= floor
            rows, scores = rows[stay], scores[stay]
            if not len(rows):
                break
            step = slice(at, min(at + PROBE_STEP, n_terms))
            self.visited += (step.stop - at) * len(rows)
            scores = scores + self.weights[step] @ postings[np.ix_(self.order[step], rows)] - self.least[step].sum()
            at = step.stop
        stay = scores >= floor
        return rows[stay], scores[stay]


def first_floors(ids: list[int], queries: list[np.ndarray], sample: list[tuple[int, np.ndarray]], k: int) -> list[float]:
    """Each query's k-th best score among the sample, without its own id; minus infinity if the sample has fewer."""
    floors = []
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in {len(x) for _, x in sample}:
        rows = [(v, x) for v, x in sample if len(x) == length]
        by_length[length] = np.array([v for v, _ in rows], dtype=np.int64), np.array([x for _, x in rows]).reshape(len(rows), length)
    for own, weights in zip(ids, queries):
        vec_ids, matrix = by_length.get(len(weights), (np.zeros(0, np.int64), np.zeros((0, len(weights)))))
        scores = (matrix @ weights)[vec_ids != own]
        floors.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf)
    return floors


def _searcher(block, k: int, scale: float):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, floors = block.value
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        pending: list[tuple[int, list]] = []

        def shard() -> None:
            by_length: dict[int, list] = {}
            for v, x in pending:
                by_length.setdefault(len(x), []).append((v, x))
            for length, rows in by_length.items():
                vec_ids = np.array([r[0] for r in rows], dtype=np.int64)
                matrix = _quantise([r[1] for r in rows], scale).reshape(len(rows), length)
                postings = np.ascontiguousarray(matrix.T)
                low = matrix.min(axis=0) if length else np.zeros(0)
                high = matrix.max(axis=0) if length else np.zeros(0)
                for q, (own, weights) in enumerate(zip(ids, queries)):
                    if len(weights) != length:
                        continue
                    floor = max(floors[q], -best[q][-1][0]) if len(best[q]) == k else floors[q]
                    if length:
                        at, scores = Query(weights, low, high).search(postings, floor)
                    else:
                        at, scores = np.arange(len(rows)), np.zeros(len(rows))
                    others = vec_ids[at] != own
                    at, scores = at[others], scores[others]
                    if len(at) > 4 * k:
                        last = np.partition(scores, len(scores) - k)[len(scores) - k]
                        at, scores = at[scores >= last], scores[scores >= last]
                    order = np.lexsort((vec_ids[at], -scores))[:k]
                    found = [(-float(scores[i]), int(vec_ids[at[i]])) for i in order]
                    best[q] = sorted(best[q] + found)[:k]
            pending.clear()

        for batch in batches:
            for v, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if v is not None and valid(x):
                    pending.append((v, x))
                    if len(pending) >= SHARD_ROWS:
                        shard()
        if pending:
            shard()
        rows = [(ids[q], v, int(-s)) for q, found in enumerate(best) for s, v in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` highest integer inner products.

    Components become floor(scale * x). Ties go to the smaller vec_id; rows with a query's own
    id are not its candidates; with fewer than ``k`` candidates all are returned. Vectors that
    are null, or hold null or non-finite components, and rows without an id take no part, and
    vectors meet only vectors of their own length. Repeated query rows count once, repeated vectors are
    a result each. Without vectors or queries the result is empty. Columns are taken by name
    and others ignored, whatever they are called. Queries are streamed in blocks of bounded size,
    each broadcast for one pass over the vectors and dropped after it.
    """
    spark = vectors.sparkSession
    table = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("x"))

    def blocks() -> Iterator[tuple[list[int], list[np.ndarray]]]:
        ids: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        for row in queries.select(F.col(vec_id).cast("bigint"), F.col(vector)).distinct().toLocalIterator():
            if row[0] is None or not valid(row[1]):
                continue
            ids.append(row[0])
            held.append(_quantise([row[1]], scale)[0])
            size += held[-1].nbytes + 64
            if size >= block_bytes:
                yield ids, held
                ids, held, size = [], [], 0
        if ids:
            yield ids, held

    n = table.count()
    # By the hash of the id about SAMPLE_ROWS of any number, of repeated rows one; the limit is for many rows of one id.
    chosen = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31)) < F.lit(int((1 << 31) * min(1.0, SAMPLE_ROWS / max(n, 1))))
    sample = [(r.vec_id, _quantise([r.x], scale)[0]) for r in table.filter(chosen).dropDuplicates(["vec_id"]).limit(2 * SAMPLE_ROWS).collect() if r.vec_id is not None and valid(r.x)]

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, last = None, None
    for ids, held in blocks():
        if last is not None:
            last[0].destroy()
        shared = spark.sparkContext.broadcast((ids, held, first_floors(ids, held, sample, k)))
        part = table.mapInArrow(_searcher(shared, k, scale), "query_id bigint, vec_id bigint, score bigint")
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        part = materialise(part, "top-k")
        found, last = part if found is None else found.union(part), (shared,)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return found


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


OP10_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
