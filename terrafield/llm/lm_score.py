"""Language-model scores from a log-frequency Bloom filter of quantised bigram counts.

One scan counts words and bigrams of all training texts, chunk by chunk, and one shuffle adds
them up by buckets of their hashes. Word counts are exact. Bigram counts, of all histories and
from ``LEAST_COUNT`` on, are quantised on a logarithmic scale, floor first, and a bigram of level
j is put into its bucket's segment of a Bloom filter as its first j (bigram, level) pairs; a
worker reads a count back by probing level after level until one is missing. The filter takes
``BITS_PER_ENTRY`` bits an entry, so it grows with the corpus: its segments are broadcast in parts of
bounded size, some parts a pass over the texts, and each token is scored in the pass that has its bigram.

The model interpolates by absolute discounting: P(w|h) = max(q(h,w) - D, 0) / c(h) + left(h) * P(w),
where left(h) is what the quantised bigrams leave of h's mass, and P(w) is the smoothed
unigram probability. Apart from the filter's false positives (under one in a hundred), it sums to one.
Counts and masses of the most frequent words (a table of bounded size) are broadcast; those of
the other words of a chunk of texts are joined to that chunk. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ZSTD, at_most, clear_shuffles, drop_scratch, materialise, read_table, settings, space_words
from .toxicity import held_out

#: Words whose exact counts and masses are broadcast (24 bytes each).
FREQUENT_WORDS = 1 << 19
#: The filter: bits an entry, probes, the least count of a bigram, bytes of a part (what a worker holds), parts of a pass.
BITS_PER_ENTRY = 12
PROBES = 5
LEAST_COUNT = 1
PART_BYTES = 32 << 20
PASS_PARTS = 16
DISCOUNT = 0.75
ALPHA = 0.1
#: The token that ends each text, and stands before its first word; no word holds a line break.
END = b"\n"
#: Letters of the texts that are counted together and share a dictionary; a longer text is a chunk by itself.
CHUNK_LETTERS = 8 << 20
#: Letters of texts that one bucket of hashes is made for, and tokens that are scored together.
BUCKET_LETTERS = 8 << 20
SCORED_TOKENS = 1 << 18
#: Words that a worker keeps numbered, some 150 bytes each.
KEPT_WORDS = 250_000

#: Counts at which a bigram reaches each level: 1, then 2 * 1.5**j, rounded up, as far as 64-bit counts of a corpus go.
LEVELS = np.unique(np.concatenate([[1.0], np.ceil(2 * 1.5 ** np.arange(0, 90))])).astype(np.int64)
_VALUES = np.concatenate([[0], LEVELS]).astype(np.float64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix64's finish)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 42)


#: Of a bigram's second word 48 bits of the hash are kept beside the 64 of its history.
_WORD_BITS = np.uint64((1 << 48) - 1)


def bigram_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit keys of (history, word) from the hashes of both."""
    with np.errstate(over="ignore"):
        return _mix((word & _WORD_BITS) ^ _mix(history + np.uint64(1)))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint32)


def _pair(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The two hashes of (key, level) that its probes are made of."""
    with np.errstate(over="ignore"):
        one = _mix(keys + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        return one, (one >> np.uint64(17)) * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)


def _position(one: np.ndarray, two: np.ndarray, probe: int, bits: np.ndarray | np.uint64) -> np.ndarray:
    """The bit within its segment (under 2**32 bits) that a probe falls on."""
    with np.errstate(over="ignore"):
        return ((one + np.uint64(probe) * two) >> np.uint64(32)) * bits >> np.uint64(32)


def filled(keys: np.ndarray, levels: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """The bytes of a segment that holds each key at its levels from 1 on; its size follows the entries."""
    size = np.uint64(max(64, -(-int(levels.sum()) * bits_per_entry // 8) * 8))
    bitmap = np.zeros(int(size) // 8, dtype=np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        one, two = _pair(keys[levels >= level], level)
        for probe in range(PROBES):
            p = _position(one, two, probe, size).astype(np.int64)
            np.bitwise_or.at(bitmap, p >> 3, np.left_shift(1, (p & 7).astype(np.uint8), dtype=np.uint8))
    return bitmap


@dataclass
class CountFilter:
    """Segments of the Bloom filter, of the buckets from ``first`` on, one after another."""

    first: int
    starts: np.ndarray  # first byte of each segment, and the end
    bitmap: np.ndarray
    buckets: int  # of the whole filter

    @classmethod
    def of(cls, first: int, segments: list[np.ndarray], buckets: int) -> CountFilter:
        return cls(first, np.concatenate([[0], np.cumsum([len(s) for s in segments])]).astype(np.int64), np.concatenate(segments), buckets)

    def holds(self, bucket: np.ndarray) -> np.ndarray:
        """Whether the keys of a bucket are in this part."""
        return (bucket >= self.first) & (bucket < self.first + len(self.starts) - 1)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key of this part's buckets: how many levels in a row the filter has; 0 for none."""
        found = np.zeros(len(keys), dtype=np.int64)
        at = np.arange(len(keys))
        segment = bucket_of(keys, self.buckets) - self.first
        start, bits = self.starts[segment], ((self.starts[segment + 1] - self.starts[segment]) * 8).astype(np.uint64)
        level = 0
        while len(at):
            level += 1
            one, two = _pair(keys[at], level)
            base, size = start[at], bits[at]
            for probe in range(PROBES):  # what one probe misses is not probed again
                p = _position(one, two, probe, size).astype(np.int64)
                stay = (self.bitmap[base + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1 == 1
                at, one, two, base, size = at[stay], one[stay], two[stay], base[stay], size[stay]
            found[at] = level
        return found


class Vocabulary(dict):
    """Words that a worker has met, numbered, with the hash of each; bounded by ``renew``."""

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros(1 << 12, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        if n == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self.hashes[n] = word_hash(word)
        return n

    def renew(self, most: int = KEPT_WORDS) -> bool:
        """Forgets all words if there are too many; numbers given before then no longer hold."""
        if len(self) <= most:
            return False
        self.clear()
        return True

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words and the end of each text, one text after another, and how many each has."""
        words: list[bytes] = []
        lengths = []
        for text in texts:
            before = len(words)
            words += space_words(text)
            words.append(END)
            lengths.append(len(words) - before)
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words)), np.array(lengths, dtype=np.int64)

    def before(self, ids: np.ndarray) -> np.ndarray:
        """The word before each: the end of the text before stands before a text's first word."""
        return np.concatenate([np.array([self[END]], dtype=np.int32), ids[:-1]])


@lru_cache(maxsize=1)
def vocabulary() -> Vocabulary:
    """This worker's vocabulary, which lives on from task to task."""
    return Vocabulary()


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[str | None]]]:
    """Slices of batches of (chunk, held_out, text), rows of a chunk following each other, with their chunk and texts."""
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            chunks, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(texts)]
            for begin, end in zip(edges, edges[1:]):
                if end > begin:
                    yield int(chunks[begin]), batch.slice(begin, end - begin), texts[begin:end]


def _small(counts: np.ndarray) -> bytes:
    """Counts in the smallest width that holds them all; ``_counts`` finds the width by the length."""
    top = int(counts.max(initial=0))
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else "<u1").astype(np.int64)


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


GATHERED = "bucket int, kind int, chunk bigint, hashes binary, counts binary, histories binary, runs binary"
WORDS, BIGRAMS = 0, 1


def _gather(buckets: int):
    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words (kind 0, those of held-out texts with count 0) and training bigrams (kind 1) of each chunk, a row a bucket."""
        voc, held, train, now = vocabulary(), [], [], -1

        def cut(kind: int, chunk: int, bucket: np.ndarray, columns) -> pa.RecordBatch:
            found, begins = np.unique(bucket, return_index=True)
            blobs = [columns(a, b) for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(bucket)])]
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, chunk, np.int64)), *(pa.array([b[k] for b in blobs], pa.binary()) for k in range(4))],
                ["bucket", "kind", "chunk", "hashes", "counts", "histories", "runs"],
            )

        def flush(chunk: int) -> Iterator[pa.RecordBatch]:
            ids, learned, hashes = np.concatenate(held), np.concatenate(train), voc.hashes
            seen = np.flatnonzero(np.bincount(ids))
            n = np.bincount(ids[learned], minlength=len(voc))[seen]
            words = hashes[seen]
            bucket = bucket_of(words, buckets)
            order = np.argsort(bucket, kind="stable")
            words, n = words[order], n[order]
            yield cut(WORDS, chunk, bucket[order], lambda a, b: (words[a:b].tobytes(), _small(n[a:b]), None, None))
            pairs, times = np.unique((voc.before(ids)[learned].astype(np.int64) << 32) | ids[learned], return_counts=True)
            held.clear()
            train.clear()
            if not len(pairs):
                return
            first, second = pairs >> 32, hashes[pairs & 0xFFFFFFFF]
            bucket = bucket_of(bigram_keys(hashes[first], second), buckets)
            order = np.argsort(bucket, kind="stable")
            first, second, times = first[order], second[order].view(np.uint8).reshape(-1, 8)[:, :6], times[order]

            def columns(a: int, b: int):
                begin = np.flatnonzero(np.concatenate([[True], first[a + 1 : b] != first[a : b - 1]]))
                return second[a:b].tobytes(), _small(times[a:b]), hashes[first[a:b][begin]].tobytes(), _small(np.diff(np.append(begin, b - a)))

            yield cut(BIGRAMS, chunk, bucket[order], columns)

        for chunk, part, texts in _runs(batches):
            if chunk != now:
                if held:
                    yield from flush(now)
                voc.renew()
                now = chunk
            out = np.array(part.column(1).to_pylist(), dtype=bool)
            ids, lengths = voc.tokens(texts)
            held.append(ids)
            train.append(np.repeat(~out, lengths))
        if held:
            yield from flush(now)

    return gather


MERGED = "bucket int, words binary, counts binary, chunks binary, sizes binary, asked binary, histories binary, masses binary, bits binary"


def _merge(bits_per_entry: int, least_count: int):
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a bucket: its words and counts, which chunks have them, masses taken of histories, and its segment of the filter.

        Rows come sorted by bucket; one bucket is held at a time.
        """
        held: list[tuple] = []
        now = -1

        def finish() -> pa.RecordBatch:
            words = [r for r in held if r[0] == WORDS]
            hashes = np.concatenate([np.zeros(0, np.uint64), *(_numbers(r[2]) for r in words)])
            n = np.concatenate([np.zeros(0, np.int64), *(_counts(r[3], len(r[2]) // 8) for r in words)])
            known, where = np.unique(hashes, return_inverse=True)
            total = np.bincount(where, n, len(known)).astype(np.int64)
            bigrams = [r for r in held if r[0] == BIGRAMS]
            second = np.concatenate([np.zeros((0, 8), np.uint8), *(np.pad(np.frombuffer(r[2], np.uint8).reshape(-1, 6), ((0, 0), (0, 2))) for r in bigrams)])
            second = np.ascontiguousarray(second).view("<u8").ravel()
            history = np.concatenate([np.zeros(0, np.uint64), *(np.repeat(_numbers(r[4]), _counts(r[5], len(r[4]) // 8)) for r in bigrams)])
            n = np.concatenate([np.zeros(0, np.int64), *(_counts(r[3], len(r[2]) // 6) for r in bigrams)])
            keys = bigram_keys(history, second)
            order = np.argsort(keys, kind="stable")
            keys, history = keys[order], history[order]
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            times = np.add.reduceat(n[order], begins) if len(begins) else np.zeros(0, np.int64)
            often = times >= least_count
            keys, history, times = keys[begins[often]], history[begins[often]], times[often]
            level = np.searchsorted(LEVELS, times, side="right")
            holders, of = np.unique(history, return_inverse=True)
            masses = np.bincount(of, LEVELS[level - 1] - DISCOUNT, len(holders)).astype("<f8")
            sizes = np.array([len(r[2]) // 8 for r in words], dtype="<u8")
            row = [
                now, known.tobytes(), total.astype("<u8").tobytes(), np.array([r[1] for r in words], dtype="<u8").tobytes(), sizes.tobytes(), where.astype("<u4").tobytes(),
                holders.tobytes(), masses.tobytes(), filled(keys, level, bits_per_entry).tobytes(),
            ]
            held.clear()
            names = ["bucket", "words", "counts", "chunks", "sizes", "asked", "histories", "masses", "bits"]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int32() if k == 0 else pa.binary()) for k, x in enumerate(row)], names)

        for batch in batches:
            for bucket, *rest in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if bucket != now and held:
                    yield finish()
                now = bucket
                held.append(tuple(rest))
        if held:
            yield finish()

    return merge


def _unpacked(kinds: dict[str, str]):
    """Rows of (hash, value) out of rows of two packed columns."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c, k)) for c, k in zip(columns, kinds.values())], list(kinds))

    return unpack


def _asked(least: int):
    """Rows (chunk, hash, c) of the words of each chunk that occur less often than ``least`` times in training."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts, chunks, sizes, asked in zip(*(c.to_pylist() for c in batch.columns)):
                counts, at = np.frombuffer(counts, "<i8"), np.frombuffer(asked, "<u4")
                rare = counts[at] < least
                chunk = np.repeat(np.frombuffer(chunks, "<i8"), _numbers(sizes).astype(np.int64))[rare]
                at = at[rare]
                yield pa.RecordBatch.from_arrays([pa.array(chunk), pa.array(np.frombuffer(words, "<i8")[at]), pa.array(counts[at])], ["chunk", "hash", "c"])

    return ask


@dataclass
class Model:
    """What is known of the corpus: totals, the frequent words (by hash: counts, masses taken), and tables of the rest."""

    n_tokens: int
    n_types: int
    hashes: np.ndarray
    counts: np.ndarray
    masses: np.ndarray
    least: int  # the count from which on a word is frequent
    buckets: int
    letters: int  # of all texts

    def __post_init__(self):
        self.denominator = self.n_tokens + ALPHA * (self.n_types + 1)


def learn(dealt: DataFrame, bits_per_entry: int = BITS_PER_ENTRY, least_count: int = LEAST_COUNT) -> tuple[Model, DataFrame, DataFrame]:
    """A model of those rows of ``deal``'s table that are not held out.

    Returns it with the table of merged buckets (the filter's segments among it) and the dictionary
    (chunk, hash, c, mass) of the words of each chunk, of any row, that are not in the model's own table.
    """
    spark = dealt.sparkSession
    letters = dealt.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * tasks, letters // BUCKET_LETTERS)
    gathered = dealt.select("chunk", "held_out", "text").mapInArrow(_gather(buckets), GATHERED)
    gathered = gathered.repartition(max(tasks, buckets // 8), "bucket").sortWithinPartitions("bucket", "kind")
    merged = materialise(gathered.mapInArrow(_merge(bits_per_entry, least_count), MERGED), "lm-merged")
    clear_shuffles(spark)
    counts = merged.select("words", "counts").mapInArrow(_unpacked({"hash": "<i8", "c": "<i8"}), "hash bigint, c bigint").filter("c > 0")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    taken = merged.select("histories", "masses").mapInArrow(_unpacked({"hash": "<i8", "mass": "<f8"}), "hash bigint, mass double")
    taken = taken.groupBy("hash").agg(F.sum("mass").alias("mass"))
    top = at_most(counts, "c", FREQUENT_WORDS)
    # At most FREQUENT_WORDS rows come to the driver here.
    top = top.join(taken, "hash", "left").select("hash", "c", F.coalesce("mass", F.lit(0.0)).alias("mass")).toArrow()
    hashes = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    found = top["c"].to_numpy()[order].astype(np.int64)
    model = Model(int(totals.n), int(totals.v), hashes[order], found, top["mass"].to_numpy()[order], int(found.min()) if len(found) else 1 << 62, buckets, int(letters))
    asked = merged.select("words", "counts", "chunks", "sizes", "asked").mapInArrow(_asked(model.least), "chunk bigint, hash bigint, c bigint")
    dictionary = asked.join(taken, "hash", "left").select("chunk", "hash", "c", F.coalesce("mass", F.lit(0.0)).alias("mass"))
    return model, merged, dictionary


def _passes(merged: DataFrame, buckets: int, part_bytes: int, pass_parts: int) -> Iterator[list]:
    """Broadcast parts of the filter, some at a time; a part holds the segments of buckets that follow each other."""
    spark = merged.sparkSession
    sizes = {r.bucket: r.size for r in merged.select("bucket", F.length("bits").alias("size")).collect()}  # one row a bucket
    bounds, size = [0], 0
    for bucket in range(buckets):
        size += sizes.get(bucket, 0)
        if size > part_bytes and bucket > bounds[-1]:
            bounds.append(bucket)
            size = sizes.get(bucket, 0)
    bounds.append(buckets)
    parts = list(zip(bounds, bounds[1:]))
    for k in range(0, len(parts), pass_parts):
        out = []
        for low, high in parts[k : k + pass_parts]:
            found = {r.bucket: np.frombuffer(r.bits, np.uint8) for r in merged.filter(F.col("bucket").between(low, high - 1)).select("bucket", "bits").collect()}
            empty = np.zeros(8, np.uint8)
            out.append(spark.sparkContext.broadcast(CountFilter.of(low, [found.get(b, empty) for b in range(low, high)], buckets)))
        yield out


SCORED = "held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(shared, parts: list):
    def score(key: tuple, texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        """Base scores of a chunk's rows, and what the tokens whose bigrams are in these parts add to the scores."""
        model: Model = shared.value
        voc = vocabulary()
        own = dictionary.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(own)
        own, own_c, own_mass = own[order], dictionary.column("c").to_numpy()[order], dictionary.column("mass").to_numpy()[order]

        def look_up(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            count, mass = np.zeros(len(hashes)), np.zeros(len(hashes))
            left = np.arange(len(hashes))
            for table, c, m in ((model.hashes, model.counts, model.masses), (own, own_c, own_mass)):
                at = np.searchsorted(table, hashes[left])
                hit = at < len(table)
                hit[hit] = table[at[hit]] == hashes[left[hit]]
                count[left[hit]], mass[left[hit]] = c[at[hit]], m[at[hit]]
                left = left[~hit]
            if len(left):
                raise RuntimeError("a word of the texts was not counted")
            return count, mass

        def piece(part: pa.Table) -> list:
            voc.renew()
            ids, lengths = voc.tokens(part.column("text").to_pylist())
            doc = np.repeat(np.arange(len(lengths)), lengths)
            used, token = np.unique(ids, return_inverse=True)
            count, mass = look_up(voc.hashes[used])
            single = (count + ALPHA) / model.denominator
            base = np.bincount(doc, np.log10(single)[token], len(lengths))
            known = np.bincount(doc, (count > 0)[token], len(lengths)).astype(np.int64)
            # Each bigram of the piece is looked up once.
            end = np.searchsorted(used, voc[END])
            pairs, place = np.unique(np.concatenate([[end], token[:-1]]) * len(used) + token, return_inverse=True)
            first, second = pairs // len(used), pairs % len(used)
            keys = bigram_keys(voc.hashes[used[first]], voc.hashes[used[second]])
            bucket, q, here = bucket_of(keys, model.buckets), np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
            for shared_part in parts:
                held: CountFilter = shared_part.value
                mine = np.flatnonzero(held.holds(bucket))
                q[mine], here[mine] = _VALUES[held.levels(keys[mine])], True
                if len(parts) > 1:
                    forget(shared_part)
            of = np.maximum(count[first], 1)
            left = np.maximum(0, 1 - mass[first] / of)
            # Where nothing is known of the history, no bigram is: what the filter says there is false.
            q[count[first] == 0] = 0
            log = np.where(here, np.log10(np.maximum(q - DISCOUNT, 0) / of + left * single[second]), 0.0)
            return [lengths, known, base, np.bincount(doc, log[place], len(lengths))]

        out, begin, size = [], 0, 0
        letters = [len(t) if t else 0 for t in texts.column("text").to_pylist()]
        for i, n in enumerate(letters):
            size += n
            if size >= 6 * SCORED_TOKENS or i + 1 == len(letters):
                out.append(piece(texts.slice(begin, i + 1 - begin)))
                begin, size = i + 1, 0
        columns = [pa.array(np.concatenate(c)) for c in zip(*out)] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.table([texts.column("uid"), texts.column("doc_id"), texts.column("held_out"), *columns], ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return score


def forget(shared) -> None:
    """Drops this worker's copy of a broadcast value; it is read again when it is asked for."""
    shared.__dict__.pop("_value", None)


def deal(docs: DataFrame, folds: int = 10, doc_id: str = "doc_id", text: str = "text", chunk_letters: int = CHUNK_LETTERS) -> DataFrame:
    """The rows as a table (chunk, uid, doc_id, held_out, text), written once: every pass reads the same chunks and numbers, however it is split.

    A chunk is rows of one task that follow each other, and ends with the row that fills it.
    """

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        chunk, uid, size = task << 24, task << 40, 0
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                part, chunks = whole.slice(start, 512), []
                for t in part.column(2).to_pylist():
                    chunks.append(chunk)
                    size += 64 + (len(t) if t else 0)
                    if size >= chunk_letters:
                        chunk, size = chunk + 1, 0
                yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(np.arange(uid, uid + part.num_rows)), *part.columns], ["chunk", "uid", "doc_id", "held_out", "text"])
                uid += part.num_rows

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, folds).alias("held_out"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(number, f"chunk bigint, uid bigint, doc_id {kind}, held_out boolean, text string"), "lm-texts")


def lm_scores(docs: DataFrame, folds: int = 10, doc_id: str = "doc_id", text: str = "text", bits_per_entry: int = BITS_PER_ENTRY, part_bytes: int = PART_BYTES, pass_parts: int = PASS_PARTS, chunk_letters: int = CHUNK_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """Scores of every row by a model of the rows that are not held out.

    Returns doc_id, held_out, n_tokens (with the end token), n_known (tokens that training texts
    have), train_tokens, base_score (smoothed unigrams) and score (log10 of the text's probability).
    Null texts are empty: their one token is the end. Rows without a doc_id are training rows.
    Repeated rows are learned from and scored each, equal texts get equal scores, and texts of any
    length are scored whole. Without training rows every token has probability one, and an empty table
    gives an empty one. Columns are taken by name and others ignored, whatever they are called.
    ``docs`` is read once and written with a number a row, so passes agree whatever Spark does between them.
    Bigrams that occur fewer than ``least_count`` times in training texts score as unseen.
    """
    with settings(docs.sparkSession, **ZSTD):
        return _lm_scores(docs, folds, doc_id, text, bits_per_entry, part_bytes, pass_parts, chunk_letters, least_count)


def _lm_scores(docs: DataFrame, folds: int, doc_id: str, text: str, bits_per_entry: int, part_bytes: int, pass_parts: int, chunk_letters: int, least_count: int) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    dealt = deal(docs, folds, doc_id, text, chunk_letters)
    model, merged, dictionary = learn(dealt, bits_per_entry, least_count)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Some tasks a chunk, so that few chunks share one.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 3 * (model.letters // chunk_letters + 1))
    dictionary = materialise(dictionary, "lm-dictionary")
    clear_shuffles(docs.sparkSession)
    dealt, dictionary = dealt.repartition(tasks, "chunk"), dictionary.repartition(tasks, "chunk")
    scored = None
    for parts in _passes(merged, model.buckets, part_bytes, pass_parts):
        found = dealt.groupBy("chunk").cogroup(dictionary.groupBy("chunk")).applyInArrow(_score(shared, parts), f"uid bigint, doc_id {kind}, {SCORED}")
        found = materialise(found, "lm-scored")
        clear_shuffles(docs.sparkSession)
        for part in parts:
            part.destroy()
        if scored is None:
            scored = found
        else:
            more = found.select("uid", F.col("score").alias("more"))
            before = scored
            scored = materialise(before.join(more, "uid").withColumn("score", F.col("score") + F.col("more")).drop("more"), "lm-sums")
            drop_scratch(before)
            drop_scratch(found)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"), 10)
