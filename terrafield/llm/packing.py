"""Packing of documents into sequences of a fixed length, as a cutting-stock problem solved by column generation.

Documents are cut into whole sequences and a rest; how many rests there are of each length is all that the plan
needs. Patterns (which lengths share a sequence) are columns of a linear program that weighs them by padded length;
a knapsack over lengths, valued by the program's dual prices, finds the columns that improve it. Uses of patterns are
rounded down, and rests take their places by their rank among those of their length. Rests that rounding
leaves over, and those of patterns that would need much padding, are laid end to end and cut at the borders of sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, pieces, read_table
from .tokens import byte_encoder, default_path

CAPACITY = 1024
#: The program ends when the padded length is proven to be within this share of the least, or after so many exchanges of columns.
GAP = 0.002
MOST_PIVOTS = 5_000
#: Patterns that need more padding are not used; their rests are cut.
MOST_PADDING = 16
#: Columns that one knapsack hands over.
COLUMNS = 48
#: Columns that are held at once; those that help least go first, and are found again if they are missed.
POOL = 1_000


def padded(total: np.ndarray, capacity: int) -> np.ndarray:
    """The length of a sequence of so many tokens: as it is at a power of two, else the capacity."""
    total = np.asarray(total)
    return np.where(total & (total - 1) == 0, total, capacity)


class _Program:
    """Least padded length of patterns that hold each rest once, by the revised simplex method."""

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, capacity: int):
        self.lengths, self.demand, self.capacity = lengths, demand.astype(float), capacity
        self.columns, uses = self._first_columns()
        self.costs = padded(np.array([int(c @ lengths) for c in self.columns]), capacity).astype(float)
        self.inverse, self.uses = np.linalg.inv(np.stack(self.columns, axis=1)), np.array(uses)
        self.pool, self.pool_costs = np.zeros((len(lengths), 0)), np.zeros(0)
        self.pivots = 0

    def _first_columns(self) -> tuple[list[np.ndarray], list[float]]:
        """A pattern a length, each used until one of its lengths runs out.

        No later pattern has that length, so the columns are triangular in some order of rows, and independent.
        """
        left, columns, uses = self.demand.copy(), [None] * len(self.demand), [0.0] * len(self.demand)
        here = np.ones(len(left), bool)
        index = np.full(self.capacity + 1, -1)
        index[self.lengths] = np.arange(len(left))
        while here.any():
            column, room = np.zeros(len(left)), self.capacity
            while room and len(fits := np.flatnonzero(here[: np.searchsorted(self.lengths, room, "right")])):
                rest = index[room - self.lengths[fits]]  # what would fill the room beside each
                full = fits[(self.lengths[fits] == room) | ((rest >= 0) & here[rest])]
                k = int(fits[-1] if room == self.capacity or not len(full) else full[-1])
                column[k] += 1
                room -= int(self.lengths[k])
            has = np.flatnonzero(column)
            use = float((left[has] / column[has]).min())
            gone = has[left[has] / column[has] <= use]
            left[has] = left[has] - use * column[has]
            here[gone] = False
            columns[gone[0]], uses[gone[0]] = column, use
            for k in gone[1:]:  # ran out at once: a column of its own, unused
                columns[k] = np.zeros(len(left))
                columns[k][k] = 1
        return columns, uses

    def knapsack(self, prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each total up to the capacity the most that lengths adding up to it are worth, and the last one taken."""
        best, taken = np.full(self.capacity + 1, -np.inf), np.zeros(self.capacity + 1, np.int64)
        best[0] = 0
        for total, n in enumerate(np.searchsorted(self.lengths, np.arange(self.capacity + 1), "right")):
            if n and total:
                worth = prices[:n] + best[total - self.lengths[:n]]
                taken[total] = k = int(worth.argmax())
                best[total] = worth[k]
        return best, taken

    def _pattern(self, total: int, taken: np.ndarray) -> np.ndarray:
        column = np.zeros(len(self.lengths))
        while total:
            column[taken[total]] += 1
            total -= self.lengths[taken[total]]
        return column

    def _exchange(self, column: np.ndarray, cost: float) -> None:
        way = self.inverse @ column
        ratio = np.full(len(way), np.inf)
        ratio[way > 1e-9] = self.uses[way > 1e-9] / way[way > 1e-9]
        out = int(ratio.argmin())
        step = ratio[out]
        self.uses = np.maximum(self.uses - step * way, 0)
        self.uses[out] = step
        self.columns[out], self.costs[out] = column, cost
        self.pivots += 1
        if self.pivots % 500 == 0:
            self.inverse = np.linalg.inv(np.stack(self.columns, axis=1))
            self.uses = np.maximum(self.inverse @ self.demand, 0)
        else:
            row = self.inverse[out] / way[out]
            self.inverse -= np.outer(way, row)
            self.inverse[out] = row

    def solve(self, gap: float, most_pivots: int) -> None:
        totals = np.arange(self.capacity + 1)
        costs = padded(totals, self.capacity).astype(float)
        least, small = float(self.lengths @ self.demand), 1e-7 * self.capacity
        while self.pivots < most_pivots:
            prices = self.costs @ self.inverse
            gains = prices @ self.pool - self.pool_costs
            if len(gains) and gains.max() > small:
                k = int(gains.argmax())
                self._exchange(self.pool[:, k], self.pool_costs[k])
                continue
            best, taken = self.knapsack(prices)
            value, profit = float(self.costs @ self.uses), best[1:] - costs[1:]
            least = max(least, value / max(1.0, float((best[1:] / costs[1:]).max())))  # prices scaled down until no pattern is worth more than it costs
            if value <= least * (1 + gap) or profit.max() <= small:
                return
            order = np.argsort(-profit)[:COLUMNS]
            new = [self._pattern(int(t) + 1, taken) for t in order if profit[t] > small]
            if self.pool.shape[1] > POOL:
                kept = np.argsort(-gains)[: POOL // 2]
                self.pool, self.pool_costs = self.pool[:, kept], self.pool_costs[kept]
            self.pool = np.concatenate([self.pool, np.stack(new, axis=1)], axis=1)
            self.pool_costs = np.concatenate([self.pool_costs, costs[order[: len(new)] + 1]])


def patterns(demand: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, most_padding: int = MOST_PADDING, most_pivots: int = MOST_PIVOTS) -> list[tuple[dict[int, int], int]]:
    """(how often each length stands in a sequence, how many such sequences) for so many rests of each length, rounded down; none that needs more padding."""
    lengths = np.array(sorted(k for k, n in demand.items() if n > 0), np.int64)
    if not len(lengths):
        return []
    counts = np.array([demand[k] for k in lengths.tolist()], np.int64)
    program = _Program(lengths, counts, capacity)
    program.solve(gap, most_pivots)
    out, left = [], counts.copy()
    for k in np.argsort(-program.uses, kind="stable").tolist():
        column = np.rint(program.columns[k]).astype(np.int64)
        has = column > 0
        uses = min(int(program.uses[k] + 1e-6), int((left[has] // column[has]).min()))
        total = int(column @ lengths)
        if uses > 0 and padded(total, capacity) - total <= most_padding:
            left -= uses * column
            out.append(({int(n): int(c) for n, c in zip(lengths[has], column[has])}, uses))
    return out


@dataclass(frozen=True)
class Places:
    """Where the rests of each length go by their rank: blocks of ranks that share a pattern, and what is left over.

    Blocks are sorted by length and first rank. Their sizes are bounded by the capacity: as many patterns as lengths, a
    pattern having at most the square root of twice the capacity different lengths.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray  # of this length in a sequence; 0: left over
    sequence: np.ndarray  # the first one of the pattern
    offset: np.ndarray  # in the sequence; of what is left over, in the tokens laid end to end
    capacity: int
    tail: np.ndarray  # borders of the sequences that hold the end of what is left over
    base: int  # the first sequence of what is left over

    @property
    def sequences(self) -> int:
        return self.base + int(self.tail[0]) // self.capacity + len(self.tail) - 1

    def of(self, length: np.ndarray, rank: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """For each rest its parts: (start in the rest, length, sequence, offset); one, unless it was left over."""
        key = (self.length << 44) + self.first
        at = np.searchsorted(key, (length << 44) + rank, "right") - 1
        within, each = rank - self.first[at], self.each[at]
        sequence = self.sequence[at] + within // np.maximum(each, 1)
        offset = self.offset[at] + np.where(each > 0, within % np.maximum(each, 1), within) * length
        out = []
        for n, e, s, o in zip(length.tolist(), each.tolist(), sequence.tolist(), offset.tolist()):
            out.append([(0, n, s, o)] if e else self._cut(o, n))
        return out

    def _cut(self, position: int, length: int) -> list[tuple[int, int, int, int]]:
        parts, at = [], position
        whole = int(self.tail[0]) // self.capacity
        while at < position + length:
            k = at // self.capacity
            start, stop = k * self.capacity, (k + 1) * self.capacity
            if k >= whole:
                last = int(np.searchsorted(self.tail, at, "right")) - 1
                k, start, stop = whole + last, int(self.tail[last]), int(self.tail[last + 1])
            end = min(position + length, stop)
            parts.append((at - position, end - at, self.base + k, at - start))
            at = end
        return parts


def places(demand: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Places:
    """A place for each of so many rests of each length."""
    blocks, ranks, sequence = [], dict.fromkeys(demand, 0), 0
    for pattern, uses in patterns(demand, capacity, gap):
        offset = 0
        for n, c in pattern.items():
            blocks.append((n, ranks[n], c, sequence, offset))
            ranks[n] += c * uses
            offset += c * n
        sequence += uses
    position = 0
    for n in sorted(demand):
        if demand[n] > ranks[n]:
            blocks.append((n, ranks[n], 0, 0, position))
            position += (demand[n] - ranks[n]) * n
    whole, tail = divmod(position, capacity)
    powers = [1 << b for b in reversed(range(capacity.bit_length())) if tail >> b & 1]  # lengths that need no padding
    tail_borders = whole * capacity + np.concatenate([[0], np.cumsum(powers, dtype=np.int64)]).astype(np.int64)
    columns = np.array(sorted(blocks), np.int64).reshape(-1, 5).T
    return Places(*columns, capacity, tail_borders, sequence)


def _cutter(tokenizer_path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as checksums of whole sequences and a rest, numbered within the task."""
        encoder, task = byte_encoder(tokenizer_path), TaskContext.get().partitionId()
        ranks, sequences = np.zeros(capacity, np.int64), 0
        for batch in batches:
            for part, texts in pieces(batch, 2, 256):
                rows = []
                for ids in encoder.encode_batch(texts):
                    ids += end
                    whole, rest = divmod(len(ids) // 4, capacity)
                    tail = ids[4 * whole * capacity :]
                    rows.append((len(ids) // 4, [zlib.crc32(ids[4 * k * capacity : 4 * (k + 1) * capacity]) for k in range(whole)], rest, zlib.crc32(tail), tail, task, int(ranks[rest]), sequences))
                    ranks[rest] += 1
                    sequences += whole
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds)]], _CUT)

    return cut


_CUT = ["uid", "doc_id", "doc_tokens", "whole", "rest", "rest_crc", "rest_ids", "task", "local", "sequences"]


def _placer(shared):
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_of = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "sequence_id", "offset")]))
        for batch in batches:
            found = shared.value.of(batch.column("rest").to_numpy(), batch.column("rank").to_numpy())
            parts = [[dict(zip(("start", "length", "sequence_id", "offset"), p)) for p in row] for row in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, part_of)], [*batch.schema.names, "parts"])

    return place


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, gap: float = GAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row a piece of a document, sequences filled without gaps.

    A document is its ids and ``end_id``; sequences hold at most ``capacity`` ids and are padded to it, except at a power of two. Whole sequences of
    a document stand alone, its rest shares one. How near to the least padding the plan stops (``gap``) bounds its time, no document is left out.

    Null and empty texts are the end id alone. Texts of any length are packed whole; repeated rows are packed each; null ids stay
    null; an empty table gives an empty one. Columns are taken by name (names must differ beyond case), others ignored.
    """
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = f"uid bigint, doc_id {kind}, doc_tokens bigint, whole array<bigint>, rest bigint, rest_crc bigint, rest_ids binary, task bigint, local bigint, sequences bigint"
    cut = materialise(rows.mapInArrow(_cutter(tokenizer_path, end_id, capacity), schema), "cut-documents")

    counts = cut.filter("rest > 0").groupBy("task", "rest").agg(F.count("*").alias("n"))
    before = counts.select("task", "rest", "n", (F.sum("n").over(Window.partitionBy("rest").orderBy("task")) - F.col("n")).alias("before"))
    before = materialise(before, "ranks")
    demand = {r.rest: r.n for r in before.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # fewer than ``capacity`` rows
    plan = places(demand, capacity, gap)
    shared = spark.sparkContext.broadcast(plan)

    # A rest's rank is its number in its task behind those of the tasks before: no length is gathered anywhere.
    ranked = cut.filter("rest > 0").select("uid", "doc_id", "doc_tokens", "rest", "rest_crc", "task", "local").join(before.drop("n"), ["task", "rest"])
    ranked = ranked.select("uid", "doc_id", "doc_tokens", "rest", "rest_crc", (F.col("before") + F.col("local")).alias("rank"))
    parts = "array<struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>>"
    placed = materialise(ranked.mapInArrow(_placer(shared), f"uid bigint, doc_id {kind}, doc_tokens bigint, rest bigint, rest_crc bigint, rank bigint, parts {parts}"), "placed")

    at = (F.col("doc_tokens") - F.col("rest") + F.col("part.start")).alias("start")
    columns = ("doc_id", at, "part.length", "ids_crc32", "doc_tokens", "part.sequence_id", "part.offset")
    uncut = placed.filter(F.size("parts") == 1).select("doc_id", "doc_tokens", "rest", F.col("rest_crc").alias("ids_crc32"), F.col("parts")[0].alias("part")).select(*columns)
    # Rests that were cut: no more than two a sequence of what was left over.
    several = placed.filter(F.size("parts") > 1).select("uid", "doc_id", "doc_tokens", "rest", F.explode("parts").alias("part"))
    own = several.join(cut.select("uid", "rest_ids"), "uid").withColumn("ids_crc32", F.expr("crc32(substring(rest_ids, cast(4 * part.start + 1 as int), cast(4 * part.length as int)))"))
    alone = cut.select("doc_id", "doc_tokens", "task", "sequences", F.posexplode("whole").alias("k", "ids_crc32"))
    alone = alone.select("doc_id", (F.col("k").cast("bigint") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("length"), "ids_crc32", "doc_tokens", (F.shiftleft(F.col("task") + 1, 40) + F.col("sequences") + F.col("k") + plan.sequences).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return uncut.union(own.select(*columns)).union(alone)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), 0, CAPACITY)
