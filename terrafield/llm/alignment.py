"""Alignment of two tokenizers: where their tokens end together, and which tokens share bytes.

Tokens become rows (posexplode) whose byte ends are running sums of lengths; rows of both tokenizers with the same
end meet; ends that both have are cuts, and their running count numbers the groups. Between two ends that
follow each other lies one token of each side, so every such row is one link: the range join of a group without its pairs.

Both tokenizers always cut at a space between two visible characters. So the rows are made of the
corpus's distinct stretches between such spaces, not of every occurrence, and a document's alignment is that of
its stretches one after another. Frequent stretches are looked up in a broadcast table of bounded size, others join.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ZSTD, at_most, clear_shuffles, drop_scratch, materialise, pieces, read_table, settings
from .tokens import _LETTERS, LONGEST_KEPT, default_path

#: Stretches (of at most LONGEST_KEPT letters) in the broadcast table; a worker holds some 40 MB of them.
FREQUENT = 200_000
#: Distinct stretches a task counts before it hands them on.
COUNTED = 300_000
#: Id pairs with counts that are broadcast, measured before; beyond, they are joined.
BROADCAST_PAIRS = 2_000_000
#: What a stretch adds up to, in the order of the columns.
SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def stretches(text: str) -> list[str]:
    """Space + text cut before each space that stands between two visible characters; each without its first space."""
    words = text.split(" ")
    if text.isprintable() and "" not in words:
        return words
    odd = [i for i, w in enumerate(words) if not w or not w.isprintable()]
    glued = {i for i in odd if not words[i] or not words[i][0].isprintable()} | {i + 1 for i in odd if not words[i] or not words[i][-1].isprintable()}
    glued -= {0, len(words)}  # words that stay with the one before them
    out, at = [], 0
    for i in sorted(glued):
        if i >= at:
            last = i
            while last + 1 in glued:
                last += 1
            out += [*words[at : i - 1], " ".join(words[i - 1 : last + 1])]
            at = last + 1
    return out + words[at:]


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)  # its own: special strings are plain text here
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letter = {chr(v): k for k, v in _LETTERS.items()}
        self.bytes_a = {i: bytes(letter[c] for c in token) for token, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("pieces that go on behind a space cannot be aligned by stretches")
        self.bytes_b = [bytes([int(n[1:-1], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """Ids of both for space + each text, and whether the bytes of both are that."""
        out = []
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        for text, a, b in zip(texts, ids_a, self.b.encode(texts, num_threads=1)):
            raw = b" " + text.encode("utf-8", "surrogatepass")
            same = b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
            out.append((a, b, same))
        return out


@lru_cache(maxsize=2)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _tokens(ids: list[list[int]], sizes) -> pa.Array:
    """An array of (id, len) for each list of ids."""
    flat = [i for row in ids for i in row]
    tokens = pa.StructArray.from_arrays([pa.array(flat, pa.int32()), pa.array([len(sizes[i]) for i in flat], pa.int32())], ["id", "len"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(row) for row in ids])]), pa.int32()), tokens)


def _encoder(path_a: str, path_b: str):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for batch in batches:
            for part, texts in pieces(batch, 0, 4096):
                made = pair.encode(texts)
                kept = [(a, b) if same else ([], []) for a, b, same in made]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _tokens([a for a, _ in kept], pair.bytes_a), _tokens([b for _, b in kept], pair.bytes_b), pa.array([same for *_, same in made])],
                    ["stretch", "n", "a", "b", "ok"],
                )

    return encode


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of the texts with how often they occur, summed in bounded memory."""
    counts: Counter[str] = Counter()

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["stretch", "n"])

    for batch in batches:
        for _, texts in pieces(batch, 0):
            for t in texts:
                if t:
                    counts.update(stretches(t))
            if len(counts) > COUNTED:
                yield batch_of()
                counts.clear()
    yield batch_of()


_tables: dict[str, object] = {}


def _table(key: str, make):
    """This worker's copy of a broadcast table in the form it is looked up in, made once."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = make()
    return _tables[key]


def _numberer(shared, key: str):
    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's stretches as numbers: of the frequent table, or -1 - k for the k-th of its others."""
        get = _table(key, lambda: {s: i for i, s in enumerate(shared.value)}).get
        for batch in batches:
            for part, texts in pieces(batch, 2):
                numbers, others = [], []
                for t in texts:
                    words = stretches(t) if t else []
                    own = list(map(get, words))
                    rest: dict[str, int] = {}
                    if None in own:
                        own = [rest.setdefault(w, -1 - len(rest)) if i is None else i for i, w in zip(own, words)]
                    numbers.append(zlib.compress(np.array(own, "<i4").tobytes(), 1))
                    others.append(list(rest))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(numbers, pa.binary()), pa.array(others, pa.list_(pa.string()))], ["uid", "doc_id", "numbers", "others"])

    return number


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<i4")


def _holds(wanted: list[int]):
    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the texts that have any of some frequent stretches."""
        for batch in batches:
            yield batch.filter(pa.array([bool(np.isin(_numbers(x), wanted).any()) for x in batch.column(1).to_pylist()], pa.bool_())).select([0])

    return hold


def _unnumberer(shared):
    def restore(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for numbers, others in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(shared.value[i] if i >= 0 else others[-1 - i] for i in _numbers(numbers).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["stretch", "n"])

    return restore


def group_strings(rows: pa.ListArray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each list of (a, b, g) from the last end back, a null where no token of that side ends."""
    sizes = np.diff(rows.offsets.to_numpy())
    a, b, g = rows.values.slice(rows.offsets[0].as_py(), int(sizes.sum())).flatten()
    row, g = np.repeat(np.arange(len(sizes)), sizes), g.to_numpy()
    parts = []
    for side, ids in enumerate((a, b)):
        here = np.flatnonzero(ids.is_valid().to_numpy(False))
        parts.append((row[here], -g[here], np.full(len(here), side), -here, ids.drop_null().to_numpy()))
    row, g, side, place, ids = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((place, side, g, row))
    row, g, side, ids = row[order], g[order], side[order], ids[order]
    between = np.where(row[1:] != row[:-1], "\n", np.where(g[1:] != g[:-1], ";", np.where(side[1:] != side[:-1], "|", ",")))
    text = [""] * (2 * len(ids))
    text[0::2], text[1::2] = map(str, ids.tolist()), [*between.tolist(), ""] if len(ids) else []
    made = iter("".join(text).split("\n"))
    return [next(made) if n else "" for n in sizes.tolist()]


def _write_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            yield part.set_column(part.num_columns - 1, "groups", pa.array(group_strings(part.column(part.num_columns - 1)), pa.string()))


def merged_ends(encoded: DataFrame, key: str = "cid") -> DataFrame:
    """key, end, a, b, g, link_a, link_b: a row for each byte offset at which tokens of either side end.

    ``encoded`` has, a row a key, tokens a and b as arrays of (id, len) of the same bytes. a and b are the ids that end there (else null);
    g numbers the groups from the last one on, 1 being the last; link_a and link_b are the tokens that cover the bytes ahead of the end.
    """
    # Dealt by key once, before tokens become rows: windows, the meeting of ends and all that follows need no shuffle.
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    running = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def side(tokens: str, other: str) -> DataFrame:
        rows = encoded.select(key, tokens).repartition(parts, key).select(key, F.posexplode(tokens).alias("pos", "token"))
        ends = rows.select(key, F.sum("token.len").over(running).alias("end"), F.col("token.id").alias(tokens))
        return ends.withColumn(other, F.lit(None).cast("int"))

    # The full outer join of both sides on (key, end), as a union that keeps how its sides are dealt.
    both = side("a", "b").unionByName(side("b", "a")).groupBy(key, "end").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    back = Window.partitionBy(key).orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (F.col("a").isNotNull() & F.col("b").isNotNull()).cast("int")
    return both.select(key, "end", "a", "b", F.sum(cut).over(back).alias("g"), F.last("a", True).over(back).alias("link_a"), F.last("b", True).over(back).alias("link_b"))


@dataclass(frozen=True)
class Alignment:
    """documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups; pairs: a, b, count, best."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT, broadcast_pairs: int = BROADCAST_PAIRS) -> Alignment:
    """Every text by a byte-level BPE (A, of space + text) and a SentencePiece model (B, which puts the space itself), aligned by bytes.

    documents: how many tokens, groups and links a text has, how many links are their B id's most counted (n_best) and the sum of
    the links' corpus-wide counts, and groups, ``a1,a2|b1;a3|b2,b3`` by ids. pairs: how often each id pair is linked in the corpus.

    Null and empty texts, and those that either tokenizer does not give back byte for byte, have no tokens: zeros, an empty string and
    no part in the counts. Texts of any length are aligned whole; repeated rows count each; null ids stay null; an
    empty table gives empty ones. Columns are taken by name (names must differ beyond case), others ignored.
    """
    with settings(docs.sparkSession, **ZSTD):
        return _align(docs, path_a, path_b, doc_id, text, frequent, broadcast_pairs)


def _align(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str, frequent: int, broadcast_pairs: int) -> Alignment:
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counted = rows.select("text").mapInArrow(_count, "stretch string, n bigint").groupBy("stretch").agg(F.sum("n").alias("n"))
    tokens = "array<struct<id: int, len: int>>"
    encoded = materialise(counted.mapInArrow(_encoder(path_a, path_b), f"stretch string, n bigint, a {tokens}, b {tokens}, ok boolean").withColumn("cid", F.monotonically_increasing_id()), "stretches")
    clear_shuffles(spark)

    # At most ``frequent`` rows of at most LONGEST_KEPT letters come to the driver.
    top = at_most(encoded.filter(F.length("stretch") <= LONGEST_KEPT), "n", frequent).select("cid", "stretch", "ok", "n").toArrow()
    top = top.sort_by([("n", "descending"), ("cid", "ascending")])  # small numbers for what occurs most: they pack well
    names = spark.sparkContext.broadcast(top["stretch"].to_pylist())
    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text").mapInArrow(_numberer(names, uuid.uuid4().hex), f"uid bigint, doc_id {kind}, numbers binary, others array<string>")
    numbered = materialise(numbered, "numbered-stretches")

    bad = encoded.filter(~F.col("ok")).select("stretch")
    sources = encoded
    if not bad.isEmpty():  # what stands beside them in their texts does not count
        within = numbered.select("uid", F.explode("others").alias("stretch")).join(bad, "stretch", "left_semi").select("uid")
        if bad_numbers := np.flatnonzero(~top["ok"].to_numpy()).tolist():
            within = within.union(numbered.select("uid", "numbers").mapInArrow(_holds(bad_numbers), "uid bigint"))
        spoiled = numbered.join(within.distinct(), "uid", "left_semi").select("numbers", "others").mapInArrow(_unnumberer(names), "stretch string, n bigint")
        less = spoiled.groupBy("stretch").agg(F.sum("n").alias("less"))
        sources = encoded.join(less, "stretch", "left").withColumn("n", F.col("n") - F.coalesce("less", F.lit(0))).drop("less")

    ends = merged_ends(encoded.filter("ok"))
    with settings(spark, **{"spark.sql.execution.replaceHashWithSortAgg": "true"}):  # rows of a key follow each other already
        collected = ends.groupBy("cid").agg(
            F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.max("g").alias("n_groups"), F.count("*").alias("n_links"),
            F.collect_list(F.shiftleft(F.col("link_a").cast("bigint"), 32) + F.col("link_b")).alias("links"), F.collect_list(F.struct("a", "b", "g")).alias("rows"),
        )
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        grouped = sources.select("cid", "stretch", "n", "ok").repartition(parts, "cid").join(collected, "cid", "left")
        schema = "cid bigint, stretch string, n bigint, ok boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, links array<bigint>, groups string"
        grouped = materialise(grouped.mapInArrow(_write_groups, schema), "stretch-groups")
    drop_scratch(encoded)
    clear_shuffles(spark)

    links = grouped.filter("n > 0").select("cid", "n", F.explode("links").alias("link"))
    counts = links.groupBy("link").agg(F.sum("n").alias("count"))
    counted_pairs = materialise(counts.select("link", (F.col("link") % (1 << 32)).cast("int").alias("b"), "count"), "pair-counts")
    highest = counted_pairs.groupBy("b").agg(F.max("count").alias("highest"))
    pairs = materialise(counted_pairs.join(highest, "b").select("link", F.shiftright("link", 32).cast("int").alias("a"), "b", "count", (F.col("count") == F.col("highest")).alias("best")), "pairs")
    scores = pairs.select("link", "count", "best")
    scores = F.broadcast(scores) if pairs.count() <= broadcast_pairs else scores
    summed = links.join(scores, "link").groupBy("cid").agg(F.sum("count").alias("count_sum"), F.count_if("best").alias("n_best"))
    # A stretch's sums and groups as one string, which shuffles at half the size of a row of numbers; a leading 1 tells one that does not come back.
    per = grouped.drop("links").join(summed, "cid", "left")
    packed = F.concat_ws(" ", (~F.col("ok")).cast("int").cast("string"), *[F.coalesce(c, F.lit(0)).cast("string") for c in SUMS], "groups")
    per = materialise(per.select("cid", "stretch", _halved(packed).alias("packed")), "stretch-scores")
    drop_scratch(grouped)
    drop_scratch(counted_pairs)
    clear_shuffles(spark)

    sums, groups, others = np.zeros((top.num_rows, len(SUMS) + 1), np.int64), [], per
    if top.num_rows:
        known = F.broadcast(spark.createDataFrame(pa.table({"cid": top["cid"], "number": pa.array(range(top.num_rows), pa.int32())})))
        found = per.join(known, "cid").select("number", "packed").toArrow().sort_by("number")  # a row a frequent stretch
        for i, x in enumerate(found["packed"].to_pylist()):
            sums[i], text = _unpacked(x)
            groups.append(text)
        others = per.join(known, "cid", "left_anti")
    shared = spark.sparkContext.broadcast((sums, pa.array(groups, pa.string())))
    key = uuid.uuid4().hex
    wanted = numbered.select("uid", F.posexplode("others").alias("k", "stretch"))
    # Written between both shuffles, so that the disk holds one of them at a time.
    met = materialise(wanted.join(others, "stretch").select("uid", "k", "packed"), "rare-stretches")
    drop_scratch(per)
    rare = met.groupBy("uid").agg(F.collect_list(F.struct("k", "packed")).alias("others"))
    together = numbered.select("uid", "doc_id", "numbers").join(rare, "uid", "left").select("doc_id", "numbers", "others")
    documents = together.mapInArrow(_composer(shared, key), f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in SUMS) + ", groups string")
    return Alignment(documents, pairs.select("a", "b", "count", "best"))


#: Signs of packed numbers and groups beside digits, and the hexadecimal digits they are kept as; f fills the last byte.
_SIGNS, _DIGITS = " ,|;", "abcd"
_READ = str.maketrans(_DIGITS, _SIGNS)


def _halved(packed: Column) -> Column:
    """Two signs of a packed string a byte."""
    digits = F.translate(packed, _SIGNS, _DIGITS)
    return F.unhex(F.when(F.length(digits) % 2 == 1, F.concat(digits, F.lit("f"))).otherwise(digits))


def _unpacked(packed: bytes) -> tuple[list[int], str]:
    """The numbers of a stretch, whether it does not come back first, and its groups."""
    *numbers, groups = packed.hex().rstrip("f").translate(_READ).split(" ", len(SUMS) + 1)
    return list(map(int, numbers)), groups


def _composer(shared, key: str):
    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = shared.value[0]
        groups = _table(key, lambda: shared.value[1].to_pylist())
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                totals, texts = np.zeros((part.num_rows, len(SUMS)), np.int64), []
                for row in range(part.num_rows):
                    numbers = _numbers(part.column(1)[row].as_py())
                    others = part.column(2)[row].as_py()
                    total = sums[numbers[numbers >= 0]].sum(axis=0)
                    if others:
                        rest: list[str] = [""] * len(others)
                        each = np.zeros((len(others), len(SUMS) + 1), np.int64)
                        for x in others:
                            each[x["k"]], rest[x["k"]] = _unpacked(x["packed"])
                        total = total + each[-1 - numbers[numbers < 0]].sum(axis=0)
                        made = [groups[n] if n >= 0 else rest[-1 - n] for n in numbers.tolist()]
                    else:
                        made = [groups[n] for n in numbers.tolist()]
                    good = len(numbers) and not total[0]
                    totals[row] = total[1:] if good else 0
                    texts.append(";".join(made) if good else "")
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(totals[:, c]) for c in range(len(SUMS))], pa.array(texts, pa.string())], ["doc_id", *SUMS, "groups"])

    return compose


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(read_table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")).documents
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.select("doc_id", *SUMS, digest.alias("groups_sha256"))
