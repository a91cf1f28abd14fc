"""SimHash near-duplicates by generalised pigeonhole.

64 bits are grouped into partitions, correlated bits together; each partition gets its own
threshold, by dynamic programming on estimated candidate counts. If the thresholds sum to
(distance - partitions + 1), any two fingerprints within the distance agree to within the
threshold in at least one partition: so each fingerprint looks up, for every partition, all
keys within that partition's threshold, and what it finds is verified over all 64 bits.

Copies collapse into one fingerprint before anything is paired. Fingerprints at one bit's
distance are linked first, from keys that at most two of them can share, so that within a
dense ball of near copies the pigeonhole join need not repeat links already known.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_position, clear_shuffles, materialise, read_table, space_words
from .components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 3
#: What one looked-up key costs against the verification of one candidate, for the choice of partitions.
PROBE_COST = 40.0
#: Distinct fingerprints, chosen by their hash, that candidate counts are estimated from; the choice changes speed alone.
SAMPLE_PRINTS = 2048
#: Ids of documents to drop are broadcast up to this many (some 10 MB).
BROADCAST_IDS = 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles: a bit is 1 if over half the shingles' XXH64 have it; 0 without words."""
    import xxhash

    words = space_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    begin, end = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(begin), 1 << 16):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(begin[i : i + (1 << 16)], end[i : i + (1 << 16)])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, f"doc_id {kind}, fp bigint")


# ---------------------------------------------------------------- partitions and thresholds


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have both of any two bits set; 4,096 sums."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            cells = np.append(both.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    sums = distinct.select("fp").mapInArrow(partial, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS + 1)
    for row in sums.collect():
        both[row.cell] = row.n
    return int(both[-1]), both[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, partitions: int) -> list[list[int]]:
    """Partitions of nearly equal width, each grown from a seed bit by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    for k in range(partitions):
        width = len(left) // (partitions - k)
        seed = max(left, key=lambda b: (spread[b], -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            best = max(left, key=lambda b: (correlation[b, group].mean(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _near(p: np.ndarray, most: int) -> list[float]:
    """Chance that two fingerprints differ in at most t of these bits, for t up to ``most``, if the bits were independent."""
    chance = np.zeros(len(p) + 1)
    chance[0] = 1
    for differ in 2 * p * (1 - p):
        chance[1:] = chance[1:] * (1 - differ) + chance[:-1] * differ
        chance[0] *= 1 - differ
    return np.cumsum(chance)[: most + 1].tolist()


def _near_sampled(sample: np.ndarray, bits: list[int], most: int) -> list[float]:
    """The share of the pairs of sampled fingerprints that differ in at most t of these bits, for t up to ``most``."""
    own = sample & np.uint64(_mask(bits))
    counts = np.zeros(BITS + 1, dtype=np.int64)
    for i in range(1, len(own)):
        counts += np.bincount(np.bitwise_count(own[i:] ^ own[:-i]), minlength=BITS + 1)
    return (np.cumsum(counts)[: most + 1] / max(1, counts.sum())).tolist()


def allocate(n: int, p: np.ndarray, groups: list[list[int]], distance: int, probe_cost: float = PROBE_COST, sample: np.ndarray | None = None) -> tuple[float, list[int]]:
    """The cheapest thresholds (each -1 or more, their sum distance - partitions + 1), by dynamic programming.

    Candidate counts come from the sample's pairs, which see how bits go together, or from
    independent bits where those are more (chances too small for the sample).
    """
    total = distance - len(groups) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by the sum of (threshold + 1)
    for group in groups:
        near = _near(p[group], distance)
        if sample is not None and len(sample) > 1:
            near = np.maximum(near, _near_sampled(sample, group, distance)).tolist()
        cost = [0.0]
        for t in range(distance + 1):
            probes = sum(math.comb(len(group), k) for k in range(t + 1))
            cost.append(probes * probe_cost + n * near[t])
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t in range(-1, distance + 1):
                key, value = used + t + 1, so_far + cost[t + 1]
                if key <= total + len(groups) and (key not in step or value < step[key][0]):
                    step[key] = (value, [*chosen, t])
        best = step
    return best[total + len(groups)]


def plan(n: int, both: np.ndarray, distance: int = DISTANCE, sample: np.ndarray | None = None, probe_cost: float = PROBE_COST) -> list[tuple[list[int], int]]:
    """The partitions (their bits) and thresholds of least estimated cost."""
    p = np.diag(both) / max(n, 1)
    options = []
    for partitions in range(2, distance + 2):
        groups = group_bits(n, both, partitions)
        cost, thresholds = allocate(n, p, groups, distance, probe_cost, sample)
        options.append((cost, list(zip(groups, thresholds))))
    return min(options, key=lambda o: o[0])[1]


def sampled_prints(distinct: DataFrame, n: int) -> np.ndarray:
    """About ``SAMPLE_PRINTS`` of the ``n`` distinct fingerprints, by their hash."""
    share = int((1 << 31) * min(1.0, SAMPLE_PRINTS / max(n, 1)))
    some = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 31)) < F.lit(share)).select("fp").limit(2 * SAMPLE_PRINTS).collect()
    return np.array([r.fp for r in some], dtype=np.int64).view(np.uint64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(bits: Iterable[int]) -> int:
    return sum(1 << b for b in bits)


def _keys_of(part: int, key):
    return lambda flip: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(flip).alias("key"))


def candidate_links(distinct: DataFrame, parts: list[tuple[list[int], int]], distance: int = DISTANCE, node: str = "fp", sketch: Sequence[str] = (), sketch_distance: int = 0, labels: bool = False) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints are within ``distance`` and whose ``known`` labels differ.

    ``distinct`` has fp, known and the node (the fingerprint itself, or a column of its own). One row per partition is looked up in by one row
    per partition and key within its threshold; the join itself verifies, so no candidate leaves it unverified.
    With ``sketch`` (columns of 64 bits) those must differ in ``sketch_distance`` bits at most as well. ``labels`` gives links of the labels.
    """
    index, probe = [], []
    for k, (bits, threshold) in enumerate(parts):
        if threshold < 0:
            continue
        mask = _mask(bits)
        key = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        index.append(F.struct(F.lit(k).alias("part"), key.alias("key")))
        flips = [_mask(c) for t in range(threshold + 1) for c in combinations(bits, t)]
        probe.append(F.transform(F.array(*[F.lit(_signed(f)) for f in flips]), _keys_of(k, key)))

    def side(x: str, at) -> DataFrame:
        own = [] if node == "fp" else [F.col("fp").alias(f"fp_{x}")]
        named = [F.col(node).alias(x), F.col("known").alias(f"known_{x}"), *own, *[F.col(c).alias(f"{c}_{x}") for c in sketch]]
        return distinct.select(*named, F.explode(at).alias("at")).select("*", "at.part", "at.key").drop("at")

    fp = (lambda x: F.col(x)) if node == "fp" else (lambda x: F.col(f"fp_{x}"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(fp("a").bitwiseXOR(fp("b"))) <= distance) & (F.col("known_a") != F.col("known_b"))
    if sketch:
        near &= _sketches_near(sketch, sketch_distance)
    q, x = side("a", F.concat(*probe)).alias("q"), side("b", F.array(*index)).alias("x")
    found = q.hint("merge").join(x, (F.col("q.part") == F.col("x.part")) & (F.col("q.key") == F.col("x.key")) & near)
    return found.select(F.col("known_a").alias("a"), F.col("known_b").alias("b")) if labels else found.select("a", "b")


def _sketches_near(sketch: Sequence[str], most: int):
    """Whether the sketches of sides a and b differ in so many bits at most."""
    differ = F.lit(0)
    for c in sketch:
        differ = differ + F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    return differ <= most


def one_bit_links(distinct: DataFrame) -> DataFrame:
    """Links between fingerprints that differ in one bit: with that bit cleared both give one key, and nothing else does."""
    masks = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(_signed(((1 << 64) - 1) ^ (1 << b))).alias("mask")) for b in range(BITS)])
    # The 64 keys of each fingerprint are made in as many tasks as a shuffle has (a stated number, else few large
    # tasks would be planned), and are not combined before they move: nearly all are unique.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = distinct.repartition(tasks, "fp").select("fp", F.explode(masks).alias("m")).select("fp", F.col("m.bit").alias("bit"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))
    pairs = keys.repartition("bit", "key").groupBy("bit", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    return pairs.filter("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable) of every row.

    Null and empty texts have fingerprint zero and are linked like any other. Texts of fewer
    words than a shingle count as one shingle, and texts of any length count whole. Repeated rows
    share a component; an empty table gives an empty result. A component whose ids are all null
    has a null id. Columns are taken by name and others ignored, whatever they are called.
    """
    return link_prints(materialise(fingerprints(docs, doc_id, text, shingle), "fingerprints"), distance)


def link_prints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint and component_id of (doc_id, fp) rows, which are read several times."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    n, both = bit_statistics(distinct)
    close = connected_components(one_bit_links(distinct), "one-bit")
    known = distinct.join(close.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("known"))
    known = materialise(known, "known")
    links = materialise(candidate_links(known, plan(n, both, distance, sampled_prints(distinct, n)), distance), "links")
    # What one-bit links have joined already is one node from here on.
    a, b = known.select(F.col("fp").alias("a"), F.col("known").alias("ka")), known.select(F.col("fp").alias("b"), F.col("known").alias("kb"))
    merged = connected_components(links.join(a, "a").join(b, "b").select(F.col("ka").alias("a"), F.col("kb").alias("b")), "components")
    labels = known.join(merged.withColumnRenamed("node", "known"), "known", "left").select("fp", F.coalesce("label", "known").alias("label"))
    labels = materialise(labels.join(distinct, "fp"), "labels")
    least = labels.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = labels.select("fp", "label").join(least, "label").select("fp", "component_id")
    by_print = materialise(by_print, "component-of")
    out = prints.hint("merge").join(by_print, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- similar texts

#: Fingerprints of similar texts: words of a shingle, a seed each, and the bits that two may differ in. Pairs of words, since an edit changes fewer of them.
SIMILAR_SHINGLE = 2
SIMILAR_SEEDS = (42, 43)
SIMILAR_DISTANCE = 6
#: Distances that are linked before it, so that dense groups are few nodes by then; and the cost of a key there, whose row is wide.
NEARER = (3,)
SIMILAR_PROBE_COST = 200.0
#: The sketch that verifies: one bit each of so many least hashes of five-word shingles. Texts of similarity s differ in a share (1 - s) / 2 of them.
SKETCH_SHINGLE = 5
SKETCH = ("m0", "m1")
SIMILARITY = 0.8
#: Standard deviations of the sketch's bits that are allowed for.
SLACK = 1.0


def sketch_distance(similarity: float = SIMILARITY, slack: float = SLACK) -> int:
    """The bits in which the sketches of texts of this similarity differ, and as many standard deviations more."""
    share, n = (1 - similarity) / 2, BITS * len(SKETCH)
    return math.floor(n * share + slack * math.sqrt(n * share * (1 - share)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix64's finish)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _shingles(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each run of ``n`` word hashes, or of all of them if there are fewer."""
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, seed, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = _mixed((out + np.uint64(0x9E3779B97F4A7C15)) ^ words[k : k + len(out)])
    return out


_FACTORS = (_mixed(np.arange(1, 1 + BITS * len(SKETCH), dtype=np.uint64)) | np.uint64(1))[:, None]


def similar_prints(text: str | None) -> tuple[list[int], list[int]]:
    """The fingerprints of a text, one a seed, and its sketch; zeros without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = np.array([digest(w, SEED) for w in space_words(text)], np.uint64)
    if not len(words):
        return [0] * len(SIMILAR_SEEDS), [0] * len(SKETCH)
    prints = []
    for seed in SIMILAR_SEEDS:
        hashes, counts = _shingles(words, SIMILAR_SHINGLE, seed), np.zeros(BITS, np.int64)
        for i in range(0, len(hashes), 1 << 16):
            counts += np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
        prints.append(int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]))
    hashes, least = _shingles(words, SKETCH_SHINGLE, SEED), np.full(len(_FACTORS), (1 << 64) - 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 2048):
            least = np.minimum(least, (hashes[None, i : i + 2048] * _FACTORS).min(axis=1))
    bits = (_mixed(least) & np.uint64(1)).astype(np.uint8)
    return prints, np.packbits(bits, bitorder="little").view("<u8").tolist()


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, distance: int = SIMILAR_DISTANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and component_id (least doc_id reachable) of every row: texts of about this similarity on five-word shingles are linked.

    Two texts are linked if one of their fingerprints is within ``distance`` and their sketches agree. Both fingerprints go through the generalised
    pigeonhole by a plan of their own. Texts alike in all bits are copies and one node; equal and one-bit neighbours are verified and
    joined first, so a dense group of near copies is not paired out. Null and empty texts are alike; texts of any length count whole;
    a component whose ids are all null has a null id; an empty table gives an empty one.
    """
    names = [f"f{i}" for i in range(len(SIMILAR_SEEDS))]
    most = sketch_distance(similarity)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(*f, *m) for f, m in map(similar_prints, batch.column(1).to_pylist())]
            table = np.array(found, np.uint64).reshape(len(found), len(names) + len(SKETCH)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(table[:, k]) for k in range(table.shape[1])]], ["doc_id", *names, *SKETCH])

    kind = docs.schema[doc_id].dataType.simpleString()
    scanned = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(scan, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in (*names, *SKETCH)))
    prints = materialise(scanned.withColumn("node", F.xxhash64(*names, *SKETCH)), "similar-prints")
    nodes = materialise(prints.groupBy("node").agg(*[F.min(c).alias(c) for c in (*names, *SKETCH)], F.min("doc_id").alias("least")), "similar-nodes")

    def sides(pairs: DataFrame, by: str) -> DataFrame:
        """Pairs of fingerprints as pairs of their least nodes, verified."""
        least = nodes.groupBy(F.col(by).alias("fp")).agg(F.min_by(F.struct("node", *SKETCH), "node").alias("n"))
        of = lambda x: least.select(F.col("fp").alias(x), F.col("n.node").alias(f"n{x}"), *[F.col(f"n.{c}").alias(f"{c}_{x}") for c in SKETCH])
        return pairs.join(of("a"), "a").join(of("b"), "b").filter(_sketches_near(SKETCH, most)).select(F.col("na").alias("a"), F.col("nb").alias("b"))

    close = None
    for name in names:
        distinct = nodes.select(F.col(name).alias("fp")).distinct()
        least = nodes.groupBy(name).agg(F.min_by(F.struct("node", *SKETCH), "node").alias("n"))
        same = nodes.join(least, name).select(F.col("node").alias("a"), F.col("n.node").alias("b"), *[F.col(c).alias(f"{c}_a") for c in SKETCH], *[F.col(f"n.{c}").alias(f"{c}_b") for c in SKETCH])
        same = same.filter((F.col("a") != F.col("b")) & _sketches_near(SKETCH, most)).select("a", "b")
        both = same.union(sides(one_bit_links(distinct), name))
        close = both if close is None else close.union(both)
    joined = connected_components(materialise(close, "similar-close"), "similar-close")
    known = materialise(nodes.join(joined, "node", "left").select("node", *names, *SKETCH, F.coalesce("label", "node").alias("known")), "similar-known")
    clear_shuffles(docs.sparkSession)

    # Nearer ones first, one fingerprint after the other: what is joined already is not paired again.
    for most_bits in (*(d for d in NEARER if d < distance), distance):
        for name in names:
            own = known.select("node", F.col(name).alias("fp"), "known", *SKETCH)
            distinct = own.select("fp").distinct()
            n, both = bit_statistics(distinct)
            links = candidate_links(own, plan(n, both, most_bits, sampled_prints(distinct, n), SIMILAR_PROBE_COST), most_bits, "node", SKETCH, most, labels=True)
            merged = connected_components(links, "similar")
            known = known.join(merged.withColumnRenamed("node", "known"), "known", "left").select("node", *names, *SKETCH, F.coalesce("label", "known").alias("known"))
            known = materialise(known, "similar-known")
            clear_shuffles(docs.sparkSession)
    labels = materialise(known.select("node", F.col("known").alias("label")).join(nodes.select("node", "least"), "node"), "similar-labels")
    of_label = labels.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = materialise(labels.select("node", "label").join(of_label, "label").select("node", "component_id"), "similar-components")
    return prints.select("doc_id", "node").hint("merge").join(of_node, "node").select("doc_id", "component_id")


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY, distance: int = SIMILAR_DISTANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of which ``doc_id`` is their component's least: one of each group of similar texts stays, with its own columns.

    Repeated rows of that id all stay; rows without an id stay; an empty table stays empty. Null and
    empty texts are one group, texts of any length count whole, and other columns may be called what they like.
    """
    found = similar_documents(docs, similarity, distance, doc_id, text)
    drop = materialise(found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(doc_id)).distinct(), "duplicates")
    if drop.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        drop = F.broadcast(drop)  # else the texts are shuffled to meet it
    plain, key = by_position(docs), f"_{docs.columns.index(doc_id)}"
    return plain.join(drop.toDF(key), key, "left_anti").select(plain.columns).toDF(*docs.columns)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
