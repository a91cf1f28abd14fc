"""SentencePiece encoding and decoding with exact N-best segmentation over the piece lattice.

A forward Viterbi pass scores every position of a lattice by its best segmentation from the
start; those scores are exact heuristics for an A-star search backward from the end, which
therefore yields segmentations in falling order of score. A text's lattice falls apart
wherever no piece can cross, so words are solved one by one: the search gives each word's best
segmentation and, by what is first in its queue then, how much the second loses. Both are kept in
a bounded cache; the text's N best differ only in the words that lose least, whose search goes on.

The scores are integers (millionths of a nat), so sums do not depend on their order. A model
that was trained by merging has ranks and no probabilities; there a piece of rank r counts as
having the probability 1 / (V * sqrt(r + 1)) up to a constant, V being the size of the vocabulary: few
pieces come first, frequent ones next. No such scores reproduce merging; these agree with it on
four fifths of a text's words. Characters without a piece are written as byte pieces. Decoding
gives back the very text, for every text and each of its segmentations.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, read_table
from .tokens import LONGEST_KEPT, RecentCache, default_path

N_BEST = 4
#: Entries of a worker's cache; some 320 bytes each.
CACHE_ENTRIES = 900_000
SPACE = "▁"
NEVER = 1 << 60

Edge = tuple[int, bytes, int]  # where it begins, ids, score


class PieceModel:
    """Vocabulary and scores of a SentencePiece model."""

    def __init__(self, path: str, scores: str = "ranks"):
        import sentencepiece

        if scores not in ("ranks", "model"):
            raise ValueError(f"scores must be ranks or model, not {scores!r}")

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.pieces: dict[str, tuple[bytes, int]] = {}
        self.bytes_of: list[bytes] = [b""] * self.size
        self.byte_ids: dict[int, int] = {}
        rank = 0
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                score = model.get_score(i) if scores == "model" else -math.log(self.size) - 0.5 * math.log(rank + 1)
                rank += 1
                text = piece.replace(SPACE, " ")
                self.bytes_of[i] = text.encode()
                self.pieces[text] = (array("I", [i]).tobytes(), round(score * 1e6))
        #: The pieces as a trie: from a character to (what follows, ids, score), ids being None where no piece ends.
        self.trie: dict = {}
        for text, (ids, score) in self.pieces.items():
            node = self.trie
            for c in text[:-1]:
                node = node.setdefault(c, ({}, None, 0))[0]
            node[text[-1]] = (node[text[-1]][0] if text[-1] in node else {}, ids, score)
        least = min((s for _, s in self.pieces.values()), default=0)
        #: A byte piece scores as less likely than any other.
        self.byte_score = least - 1_000_000
        #: Pieces that reach from a run of letters into other characters, or the reverse; none but spaces may lead.
        self.crossing = [p for p in self.pieces if len(self.RUNS.findall(p)) > 1]

    RUNS = re.compile(r" *[^\W\d_]+| *(?:[^\w ]|[\d_])+| +")

    def lattice(self, unit: str) -> tuple[list[int], list[list[Edge]]]:
        """Viterbi's best score from the start to each position of a unit, and the pieces that end there by where they begin.

        Characters without a piece have byte pieces.
        """
        n, trie, pieces = len(unit), self.trie, self.pieces
        best, into = [-NEVER] * (n + 1), [[] for _ in range(n + 1)]
        best[0] = 0
        for i in range(n):
            here, node, j = best[i], trie, i
            if unit[i] not in pieces:
                raw = unit[i].encode("utf-8", "surrogatepass")
                score = self.byte_score * len(raw)
                into[i + 1].append((i, array("I", [self.byte_ids[b] for b in raw]).tobytes(), score))
                if here + score > best[i + 1]:
                    best[i + 1] = here + score
            while j < n and (step := node.get(unit[j])) is not None:
                j += 1
                node, ids, score = step
                if ids is not None:
                    into[j].append((i, ids, score))
                    if here + score > best[j]:
                        best[j] = here + score
        return best, into


def a_star(best: list[int], into: list[list[Edge]], count: int) -> tuple[list[tuple[int, bytes]], int]:
    """The ``count`` best segmentations as (score, ids), best first, and the score of the next after them (-NEVER for none).

    The search goes backward from the end, led by the forward scores. What is before a
    position is known exactly, so the first state of the queue always leads to the next best
    segmentation; of a state's pieces one leads there (of equal ones the longest), and the others wait in the queue.
    """
    found: list[tuple[int, bytes]] = []
    # Minus (score behind + best before); the order of entry, the latest first; position; score behind; (ids, what comes behind them).
    queue: list = []
    at, behind, link, serial = len(best) - 1, 0, None, 0
    while True:
        while at:
            total, onward = behind + best[at], None
            for begin, ids, score in into[at]:
                score += behind
                if onward is None and score + best[begin] == total:
                    onward = begin, score, (ids, link)
                else:
                    serial -= 1
                    queue.append((-score - best[begin], serial, begin, score, (ids, link)))
            at, behind, link = onward
        parts = []
        while link:
            parts.append(link[0])
            link = link[1]
        found.append((behind, b"".join(parts)))
        if len(found) == count or not queue:
            return found, -min(queue)[0] if queue else -NEVER
        heapq.heapify(queue)
        _, _, at, behind, link = heapq.heappop(queue)


class NBestEncoder:
    """N-best ids of whole texts; a worker keeps one, with its caches."""

    def __init__(self, path: str, scores: str = "ranks", entries: int = CACHE_ENTRIES):
        self.model = PieceModel(path, scores)
        #: Of chunks and of the units they are made of; most chunks are one unit.
        self.known = RecentCache(entries)

    def units_of(self, chunk: str) -> list[str]:
        if any(p in chunk for p in self.model.crossing):
            return [chunk]
        return self.model.RUNS.findall(chunk)

    def _unit(self, unit: str) -> tuple[bytes, int, int]:
        known = self.known.new.get(unit) or self.known.lift(unit)
        if known is None:
            ((score, ids),), second = a_star(*self.model.lattice(unit), 1)
            known = ids, score, score - second if second > -NEVER else NEVER
            if len(unit) <= LONGEST_KEPT:
                self.known.new[unit] = known
        return known

    def _chunk(self, chunk: str) -> tuple[bytes, int, int]:
        known = self.known.lift(chunk)
        if known is None:
            parts = [self._unit(u) for u in self.units_of(chunk)]
            known = parts[0] if len(parts) == 1 else (b"".join([p[0] for p in parts]), sum([p[1] for p in parts]), min([p[2] for p in parts], default=NEVER))
            if len(chunk) <= LONGEST_KEPT:
                self.known.new[chunk] = known
        return known

    def _unit_choices(self, unit: str, count: int) -> list[tuple[int, bytes]]:
        return a_star(*self.model.lattice(unit), count)[0]

    def _chunk_choices(self, chunk: str, count: int) -> list[tuple[int, bytes]]:
        choices = [(0, b"")]
        for unit in self.units_of(chunk):
            mine = self._unit_choices(unit, count)
            choices = sorted(((s + t, a + b) for s, a in choices for t, b in mine), key=lambda c: -c[0])[:count]
        return choices

    def search(self, text: str, count: int = N_BEST) -> tuple[list[str], tuple[bytes, ...], int, list[tuple[int, tuple]]]:
        """A text's chunks, the ids of each one's best segmentation, the score of all, and the best ``count`` as (loss, changes).

        A change is (chunk, ids); the first entry has none. Only the count - 1 chunks that lose least
        by their second choice can differ within the count best; each of these is searched by A-star.
        """
        if not text:
            return [], (), 0, [(0, ())]
        if "  " in text or "\0" in text or text[0] == " ":
            chunks = re.findall(r" *[^ ]+| +", " " + text)
        else:
            chunks = (" " + text).replace(" ", "\0 ").split("\0")[1:]
        self.known.turn()
        get, learn = self.known.new.get, self._chunk
        ids, scores, losses = zip(*[get(c) or learn(c) for c in chunks])
        options: list[tuple[int, tuple]] = [(0, ())]
        if count > 1:
            losses = np.array(losses)
            few = min(count - 1, len(losses))
            at = np.argpartition(losses, few - 1)[:few] if few < len(losses) else np.arange(len(losses))
            for i in sorted(int(i) for i in at if losses[i] < NEVER):
                choices = self._chunk_choices(chunks[i], count)
                options = sorted(((o + scores[i] - s, c if b == ids[i] else (*c, (i, b))) for o, c in options for s, b in choices), key=lambda o: o[0])[:count]
        return chunks, ids, sum(scores), options

    def encode(self, text: str, count: int = N_BEST) -> list[tuple[int, bytes]]:
        """Up to ``count`` best segmentations as (score, ids as little-endian u32), best first; one empty one for the empty text."""
        _, ids, score, options = self.search(text, count)
        found = []
        for loss, changes in options:
            changed = list(ids)
            for i, b in changes:
                changed[i] = b
            found.append((score - loss, b"".join(changed)))
        return found

    def bytes_of(self, ids: bytes) -> bytes:
        """What ids stand for, with the space put before the text."""
        return b"".join(map(self.model.bytes_of.__getitem__, array("I", ids)))

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for, without the space put before it."""
        return b"".join(map(self.model.bytes_of.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=1)
def encoder(path: str, scores: str = "ranks", entries: int = CACHE_ENTRIES) -> NBestEncoder:
    """This worker's encoder."""
    return NBestEncoder(path, scores, entries)


def encode(docs: DataFrame, model_path: str, count: int = N_BEST, scores: str = "ranks", doc_id: str = "doc_id", text: str = "text", ids: str = "all", cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """The N best segmentations of every whole text.

    Returns doc_id, n_pieces, ids_crc32 and score of the best, gap (best less second, null without a
    second), round_trip (whether each of them decodes to the very text) and segmentations: at most
    ``count`` of (score in nats, n_pieces, ids_crc32: unsigned crc32 of the ids as little-endian u32, and,
    with ids="all", the ids), best first. With ids="best" the best ids are a column; ids="none" leaves all out.

    Null and empty texts have one segmentation, without pieces. Texts of any length, and words of any
    length in them, are segmented whole; repeated rows are encoded each, and an empty table
    gives an empty one. Ties between segmentations are broken the same way each time. Columns are
    taken by name and others ignored, whatever they are called. ``cache_entries`` bounds a worker's
    memory and changes speed alone.
    """
    if ids not in ("all", "best", "none"):
        raise ValueError(f"ids must be all, best or none, not {ids!r}")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path, scores, cache_entries)
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
        for batch in batches:
            for part, texts in pieces(batch, 1):
                rows, found, all_ids, each = [], [], [], []
                for t in texts:
                    chunks, best, score, options = own.search(t, count)
                    # The best decodes to the text, and whatever another puts for a chunk decodes to that chunk.
                    good = all(own.bytes_of(b) == chunks[i].encode("utf-8", "surrogatepass") for _, changes in options for i, b in changes)
                    for loss, changes in options:
                        mine = best
                        if changes:
                            mine = list(best)
                            for i, b in changes:
                                mine[i] = b
                        raw = b"".join(mine)
                        if not changes:
                            good = good and own.bytes_of(raw)[1:] == t.encode("utf-8", "surrogatepass")
                        found.append(((score - loss) / 1e6, len(raw) // 4, zlib.crc32(raw)))
                        if ids == "all" or ids == "best" and not changes:
                            all_ids.append(raw)
                    gap = (options[1][0] - options[0][0]) / 1e6 if len(options) > 1 else None
                    first = found[-len(options)]
                    rows.append((first[1], first[2], first[0], gap, good))
                    each.append(len(options))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in all_ids)]), pa.int32()), pa.array(np.frombuffer(b"".join(all_ids), "<i4")))
                members = [pa.array(c, k) for c, k in zip(zip(*found), (pa.float64(), pa.int64(), pa.int64()))] + [lists] * (ids == "all")
                segmentations = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *each]), pa.int32()), pa.StructArray.from_arrays(members, ["score", "n_pieces", "ids_crc32", "ids"][: len(members)]))
                columns = [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds)), segmentations] + [lists] * (ids == "best")
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids_crc32", "score", "gap", "round_trip", "segmentations", "ids"][: len(columns)])

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces bigint, ids_crc32 bigint, score double, gap double, round_trip boolean, segmentations array<struct<score: double, n_pieces: bigint, ids_crc32: bigint{', ids: array<int>' * (ids == 'all')}>>"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, schema + ", ids array<int>" * (ids == "best"))


def decode(encoded: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of encoded rows (ids being an array column); null ids give a null text, none the empty one."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path)
        for batch in batches:
            texts = [None if x is None else own.decode(np.array(x, dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema[doc_id].dataType.simpleString()
    return encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(scan, f"doc_id {kind}, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"), default_path("piece_bpe_32k.model"), ids="none")
