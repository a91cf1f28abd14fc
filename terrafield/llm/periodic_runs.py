"""Periodic runs of words: where a text says the same again and again, and the text with each repeat said once.

A run is a stretch of consecutive words with a smallest period q (words q apart are the same) that no
neighbouring word extends, of some words and some periods at least. Runs are found as Kolpakov and Kucherov do:
the text is cut into Lempel-Ziv factors, which a suffix automaton gives; runs that cross or touch the
border of a factor come from common extensions around that border (Main's algorithm); a run inside a
factor is a copy of one inside the factor's earlier occurrence.

All its n-grams of a certain length occur twice in a run, so only stretches made of such n-grams are
factored; that cut loses no run and spares texts that do not repeat themselves.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, read_table

LEAST_WORDS = 24
LEAST_TIMES = 3

_MUL = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """The automaton of all substrings of a sequence of numbers, with where each state's strings end first.

    Most states have one way on, which stands in arrays; further ways are in a dictionary a state,
    so a word takes some fifty bytes.
    """

    __slots__ = ("_more", "_only", "_to", "end", "link", "size")

    def __init__(self, letters: Iterable[int]):
        self.link, self.size, self.end = array("i", [-1]), array("i", [0]), array("i", [-1])
        self._only, self._to, self._more = array("i", [-1]), array("i", [-1]), {}
        last = 0
        for i, c in enumerate(letters):
            last = self._extend(last, c, i)

    def step(self, state: int, c: int) -> int:
        """The state behind ``c``, or -1."""
        if self._only[state] == c:
            return self._to[state]
        more = self._more.get(state)
        return more.get(c, -1) if more else -1

    def _lead(self, state: int, c: int, to: int) -> None:
        if self._only[state] in (-1, c):
            self._only[state], self._to[state] = c, to
        else:
            self._more.setdefault(state, {})[c] = to

    def _new(self, size: int, end: int, like: int = -1) -> int:
        self.size.append(size)
        self.end.append(end)
        self.link.append(self.link[like] if like >= 0 else -1)
        self._only.append(self._only[like] if like >= 0 else -1)
        self._to.append(self._to[like] if like >= 0 else -1)
        new = len(self.size) - 1
        if like in self._more:
            self._more[new] = dict(self._more[like])
        return new

    def _extend(self, last: int, c: int, i: int) -> int:
        new = self._new(self.size[last] + 1, i)
        p = last
        while p != -1 and (q := self.step(p, c)) == -1:
            self._lead(p, c, new)
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        elif self.size[p] + 1 == self.size[q]:
            self.link[new] = q
        else:
            copy = self._new(self.size[p] + 1, self.end[q], q)
            while p != -1 and self.step(p, c) == q:
                self._lead(p, c, copy)
                p = self.link[p]
            self.link[q] = self.link[new] = copy
        return new


def factors(letters: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, length, source) of the Lempel-Ziv factors: the longest string that began earlier too (it may overlap itself), or one new letter (source -1)."""
    automaton, n, i = SuffixAutomaton(letters), len(letters), 0
    step, end = automaton.step, automaton.end
    while i < n:
        state, length = 0, 0
        while i + length < n:
            following = step(state, letters[i + length])
            if end[following] - length >= i:  # its first occurrence is this one
                break
            state, length = following, length + 1
        if length:
            yield i, length, end[state] - length + 1
        else:
            yield i, 1, -1
        i += length or 1


def common_prefixes(letters: list[int], of: list[int]) -> list[int]:
    """For each place of ``letters``, how many letters from there on agree with the beginning of ``of``."""
    text = [*of, -1, *letters]  # -1 is no letter
    out, left, right = [0] * len(text), 0, 0
    for i in range(1, len(text)):
        z = min(out[i - left], right - i) if i < right else 0
        while i + z < len(text) and text[z] == text[i + z]:
            z += 1
        if i + z > right:
            left, right = i, i + z
        out[i] = z
    return out[len(of) + 1 :]


def runs_of(letters: list[int], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` letters and ``times`` (2 at least) periods, by start and period."""
    found: dict[tuple[int, int], int] = {}  # (start, end) to the smallest period
    at: dict[int, list[int]] = {}  # start to ends
    starts: list[int] = []
    n = len(letters)

    def keep(start: int, end: int, period: int) -> None:
        known = found.get((start, end))
        if known is None:
            if start not in at:
                insort(starts, start)
            at.setdefault(start, []).append(end)
        if known is None or period < known:
            found[start, end] = period

    def border(b: int, m: int, before: int) -> None:
        """Runs around the border ``b`` that end in the ``m`` letters behind it, or end at it and begin in the ``before`` letters ahead of it.

        Such a run begins less than its period ahead of the factor before, or that factor would have been
        longer; so it begins within m + 2 * before letters.
        """
        if 2 * (m + before) < least:
            return
        first = max(0, b - m - 2 * before)
        left, right = letters[first:b], letters[b : b + m + 1]
        mirrored = left[::-1]
        ahead = common_prefixes(left + right, right)  # at b - p - first: how far words p apart agree from b on
        behind = common_prefixes(mirrored, mirrored)  # at p: how far they agree back from b
        for p in range(1, min(len(left), (m + before) // (times - 1)) + 1):
            forth, back = ahead[len(left) - p], behind[p] if p < len(left) else 0
            start, end = b - p - back, b + forth
            if end - start >= max(least, times * p) and forth <= m and (start > first or first == 0) and (forth or start > b - before):
                keep(start, end, p)
        if m * times < least and m + 2 * before + m < least:
            return
        whole = (left + right[:m])[::-1]
        back_from = common_prefixes(whole, mirrored)  # at m - p: how far words p apart agree back from b and b + p
        for p in range(1, m):
            forth, back = ahead[len(left) + p], back_from[m - p]
            start, end = b - back, b + p + forth
            if end - start >= max(least, times * p) and end <= b + m and (start > first or first == 0):
                keep(start, end, p)

    before = 0
    for b, m, source in factors(letters):
        border(b, m, before)
        if source >= 0 and m > least:
            shift, k = b - source, bisect_right(starts, source)
            while k < len(starts) and starts[k] + least < source + m:
                s = starts[k]
                for e in [e for e in at[s] if e < source + m]:
                    keep(s + shift, e + shift, found[s, e])
                k += 1
        before = m
    border(n, 0, before)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def _gram(least: int, times: int) -> int:
    """The longest n for which each n-gram of any run occurs twice in it."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1)))


def stretches(words: list[bytes], least: int, times: int) -> list[tuple[int, int]]:
    """Where (start, end) runs can be: words whose n-grams all occur twice in the text."""
    n = _gram(least, times)
    count = len(words) - n + 1
    if len(words) < least or count < 1:
        return []
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            grams = (grams ^ each[k : k + count]) * _MUL
            grams ^= grams >> np.uint64(29)
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    place = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (twice[place] == grams).astype(np.int8), [0]])))
    return [(a, b + n - 1) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()) if b + n - 1 - a >= least]


def word_runs(words: list[bytes], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """The runs of a text's words."""
    out = []
    for a, b in stretches(words, least, times):
        numbers: dict[bytes, int] = {}
        out += [(a + s, length, p) for s, length, p in runs_of([numbers.setdefault(w, len(numbers)) for w in words[a:b]], least, times)]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by spaces, without those that stand in a run behind its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length and period, counted in words, by start) and collapsed (the text with each run's repeats left out) of every row.

    Words stand between white space (ASCII) and are compared as they are. Null and empty texts have no words, no runs
    and an empty ``collapsed``. Texts of any length are searched whole; repeated rows are returned
    each, null ids stay null, and an empty table gives an empty one. Columns are taken by name (which must
    differ beyond case) and others ignored, whatever they are called.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two periods and one word at least")
    kind = docs.schema[doc_id].dataType.simpleString()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 1):
                found, kept = [], []
                for t in texts:
                    words = t.encode("utf-8", "surrogatepass").split()
                    runs = word_runs(words, least, times)
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    kept.append(collapse(words, runs).decode("utf-8", "surrogatepass"))
                run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(run)), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(search, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text of all documents; those whose crc32(doc_id) ends in 0 say a part of themselves over and over, as the query's contract has it."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    g = F.expr("h div 10")
    rows = rows.withColumn("a", F.when(F.col("n") > 0, (g % F.col("n")).cast("int"))).withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(looped(read_table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("times"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length")))
    rows = found.withColumn("top", F.array_max(order))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
