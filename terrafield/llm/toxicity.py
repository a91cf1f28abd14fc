"""Toxicity scores: a learned lexicon, Levenshtein automata over its trie, and context windows.

The lexicon holds stems that labelled toxic texts have and other labelled texts (all but)
lack, and suspect stems, which the others have too but far more rarely: one of these says little, a
text that is full of them much. All stems' Levenshtein automata are run as one deterministic automaton over their trie,
built lazily: a word costs one transition a letter and dies as soon as no stem is near. Hits
are weighed by a window around them, which tells a quoted or reported term from one aimed at
somebody, and a logistic regression on the weighed counts and the suspect stems' gives the score.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, materialise, read_table

#: Most labelled rows that a model is fitted on, taken by the hash of their doc_id, and about how many letters they have.
TRAIN_ROWS = 12_000
TRAIN_LETTERS = 60_000_000
#: A stem is learned from so many toxic texts and this share of them, or from so many that no other stem explains,
#: with at most one other text for so many toxic ones.
LEAST_TEXTS = 6
LEAST_SHARE = 0.02
LEAST_NEW = 3
PURITY = 50
#: A suspect stem is so many times as frequent among toxic texts as among others, by at least this likelihood ratio.
LIFT = 4
LEAST_RATIO = 30
STEM_LETTERS = (4, 12)
EDITS = 1
#: A stem is misspelled in so few of the texts without toxicity, else it is matched with its first letter right, or exactly.
FALSE_ALARMS = 0.002
MOST_SUFFIX = 2
WINDOW = 8
CACHE_ENTRIES = 150_000
#: Scales the share of suspect words to the size of the other inputs, for the regression's ridge.
DENSITY = 50.0

#: Letters often written as other signs.
_FOLD = str.maketrans("013457@$!", "oieastasi")
_LETTERS = re.compile(r"[^\W\d_]+")
_INNER = re.compile(r"[\W_]+")
_OPEN, _CLOSE = "\"“„«‹‘", "\"”“»›’"
_REPORT = frozenset("said says say wrote writes called calls quote quoted quotes word words term reported according dit disait écrit sagte sagt schrieb dijo dice escribió".split())
_TARGET = frozenset("you your you're youre ur u du dich dein deine ihr tu te ton ta vous votre tú usted eres vosotros".split())


def normal(token: str) -> str:
    """A lower-case token without the signs around and inside it, look-alike signs read as letters."""
    if token.isalpha():
        return token
    token = token.strip("\"'“”„«»‹›‘’.,;:?()[]{}<>*_-/\\|~`#%&+=")
    if token.isalpha():
        return token
    if not any(c.isalpha() for c in token):
        return ""
    return _INNER.sub("", token.rstrip("!").translate(_FOLD))


class StemAutomaton:
    """All stems' Levenshtein automata at once: states are sets of (trie node, edits, letter owed by a swap, whether an edit touched the first letter).

    ``fuzzy`` tells which stems may be misspelled, ``first`` which of these in the first letter too (by default none).
    """

    MOST_STATES = 20_000

    def __init__(self, stems: list[str], fuzzy: list[bool], edits: int = EDITS, first: list[bool] | None = None):
        self.stems, self.edits = stems, edits
        self.children: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]
        self.fuzzy_below: list[bool] = [False]
        self.first = [a and b for a, b in zip(first, fuzzy)] if first else [False] * len(stems)
        self.first_below: list[bool] = [any(self.first)]
        for k, stem in enumerate(stems):
            node = 0
            for c in stem:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.end.append(-1)
                    self.fuzzy_below.append(False)
                    self.first_below.append(False)
                node = self.children[node][c]
                self.fuzzy_below[node] |= fuzzy[k]
                self.first_below[node] |= self.first[k]
            self.end[node] = k
        self.fuzzy = fuzzy
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[int, int] | None] = []
        self.start = self._state(frozenset({(0, 0, "", False)}))

    def _state(self, nodes: frozenset) -> int:
        if nodes in self.states:
            return self.states[nodes]
        best = None
        for node, edits, owed, loose in nodes:
            k = self.end[node]
            if k >= 0 and not owed and (not edits or self.fuzzy[k]) and (not loose or self.first[k]) and (best is None or (edits, k) < best):
                best = (edits, k)
        self.states[nodes] = len(self.sets)
        self.sets.append(nodes)
        self.moves.append({})
        self.found.append(best)
        return len(self.sets) - 1

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, edits, owed, loose in self.sets[state]:
            if owed:
                if c == owed:
                    out.add((node, edits, "", loose))
                continue
            kids = self.children[node]
            if c in kids:
                out.add((kids[c], edits, "", loose))
            if edits < self.edits:
                loose = loose or not node
                below = self.first_below if loose else self.fuzzy_below
                if below[node]:
                    out.add((node, edits + 1, "", loose))  # a letter too many
                for x, kid in kids.items():
                    if not below[kid]:
                        continue
                    out.add((kid, edits + 1, "", loose))  # another letter
                    grandkids = self.children[kid]
                    if c in grandkids:
                        out.add((grandkids[c], edits + 1, "", loose))  # a letter left out
                        if c != x:
                            out.add((grandkids[c], edits + 1, x, loose))  # two letters swapped
        return self._state(frozenset(out))

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, stem) of the nearest stem that the word begins with, within the edits; ties to the first stem."""
        if len(self.sets) > self.MOST_STATES:
            self._reset()
        state, best, moves = self.start, None, self.moves
        whole = True
        for c in word:
            state = moves[state].get(c, -1) if c in moves[state] else moves[state].setdefault(c, self._move(state, c))
            found = self.found[state]
            if found is not None and (best is None or found < best):
                best = found
                if not found[0]:
                    return best
            if not self.sets[state]:
                whole = False
                break
        if whole and best is None:  # the stem's last letter left out
            for node, edits, owed, loose in self.sets[state]:
                if edits < self.edits and node and not owed:
                    for kid in self.children[node].values():
                        k = self.end[kid]
                        if k >= 0 and self.fuzzy[k] and (not loose or self.first[k]) and (best is None or (edits + 1, k) < best):
                            best = (edits + 1, k)
        return best


class _Hits(dict):
    """Token to 0, or 1 + 2 * stem + (1 if misspelled)."""

    def __init__(self, automaton: StemAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, token: str) -> int:
        word = normal(token)
        found = self.automaton.match(word) if word else None
        if found and found[0] and len(word) > len(self.automaton.stems[found[1]]) + MOST_SUFFIX:
            found = None  # a misspelled stem must be nearly the whole word
        code = 0 if found is None else 1 + 2 * found[1] + (found[0] > 0)
        if len(token) <= 40:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = code
        return code


@dataclass
class Model:
    """Stems, which of them may be misspelled, the regression's weights, which stems may be misspelled in the first letter, and which are suspect."""

    stems: list[str]
    fuzzy: list[bool]
    weights: list[float] = field(default_factory=lambda: [-4.0, 0.0, 0.0, 0.0, 0.0, 0.0])
    first: list[bool] | None = None
    suspect: list[bool] | None = None
    _hits: _Hits | None = None

    def __getstate__(self):
        return self.__dict__ | {"_hits": None}

    def features(self, text: str | None) -> tuple[list[float], list[tuple[int, int, float]]]:
        """The regression's inputs, and the hits as (word position, stem, weight)."""
        if self._hits is None:
            self._hits = _Hits(StemAutomaton(self.stems, self.fuzzy, first=self.first))
        words = text.lower().split() if text else []
        codes = list(map(self._hits.__getitem__, words))
        exact = misspelled = suspect = 0.0
        hits = []
        if any(codes):
            for i, code in enumerate(codes):
                if code:
                    if self.suspect and self.suspect[(code - 1) // 2]:
                        suspect += 1
                        continue
                    weight = context_weight(words, i)
                    hits.append((i, (code - 1) // 2, weight))
                    if (code - 1) % 2:
                        misspelled += weight
                    else:
                        exact += weight
        n = max(len(words), 1)
        return [1.0, math.log1p(exact), math.log1p(misspelled), math.sqrt(min(1.0, (exact + misspelled) / n)), math.log1p(suspect), DENSITY * min(1.0, suspect / n)], hits

    def score(self, text: str | None) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(text)[0]))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def context_weight(words: list[str], i: int) -> float:
    """Under 1 for a term that is quoted or reported, over 1 for one aimed at somebody, by a window around it."""
    before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
    opened = any(w[0] in _OPEN for w in before)
    closed = any(w.rstrip(".,;:!?")[-1:] in _CLOSE and w.rstrip(".,;:!?") for w in after)
    reported = any(w.strip(".,;:!?\"'") in _REPORT for w in before[-5:-1])
    weight = (0.4 if opened and closed else 1.0) * (0.7 if reported else 1.0)
    if weight == 1.0 and any(w.strip(".,;:!?\"'") in _TARGET for w in words[max(0, i - 4) : i + 4]):
        weight = 1.5
    return weight


def _signature(words: set[str]) -> int:
    """The least hash of a text's words: near copies mostly share it, other texts mostly do not."""
    return min((zlib.crc32(w.encode("utf-8", "surrogatepass")) * 2654435761 & 0xFFFFFFFF for w in words), default=0)


def _likelihood_ratio(a: int, n: int, b: int, m: int) -> float:
    """How much likelier a of n and b of m are with a share each than with one share for both (twice the log)."""
    whole = (a + b) / (n + m)
    term = lambda k, size, p: (k * math.log(k / size / p) if k else 0.0) + ((size - k) * math.log((1 - k / size) / (1 - p)) if k < size else 0.0)
    return 2 * (term(a, n, whole) + term(b, m, whole))


def learn_stems(texts: list[tuple[str | None, int]]) -> list[tuple[str, bool, bool]]:
    """Stems that toxic texts have and others (all but) lack, and suspect ones that others have far more rarely.

    Near copies of toxic texts count as one text. A stem is taken if many texts have it, or if
    several texts have it that no stem taken before explains; each is as long as its words
    agree. With each stem comes whether it is mostly a word by itself, and whether it is suspect.
    Only what toxic texts have is held in memory, so other texts may be many.
    """
    low, high = STEM_LETTERS
    words_of = lambda text: {n for w in set((text or "").lower().split()) if (n := normal(w)) and low <= len(n)}
    beginnings = lambda words: {w[:k] for w in words for k in range(low, min(high, len(w)) + 1)}
    toxic = [words_of(text) for text, label in texts if label]
    n_others = sum(1 for _, label in texts if not label)
    if not toxic or not n_others:
        return []
    signs = [_signature(words) for words in toxic]
    holders: dict[str, set[int]] = defaultdict(set)
    for words, sign in zip(toxic, signs):
        for prefix in beginnings(words):
            holders[prefix].add(sign)
    n_toxic = len(set(signs))
    many = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    holders = {p: h for p, h in holders.items() if len(h) >= LEAST_NEW}
    elsewhere: Counter[str] = Counter()
    for text, label in texts:
        if not label:
            elsewhere.update(p for p in beginnings(words_of(text)) if p in holders)
    pure = {p: h for p, h in holders.items() if elsewhere[p] * PURITY <= len(h)}
    lifted = {p: h for p, h in holders.items() if p not in pure and len(h) >= many and len(h) * n_others >= LIFT * n_toxic * elsewhere[p]}
    lifted = {p: h for p, h in lifted.items() if _likelihood_ratio(len(h), n_toxic, min(elsewhere[p], n_others), n_others) >= LEAST_RATIO}
    # What goes on from a suspect stem is pure by chance: rare words of it.
    pure = {p: h for p, h in pure.items() if not any(p[:k] in lifted for k in range(low, len(p)))}
    shortest = sorted((p for p in pure if len(p) == low or p[:-1] not in pure), key=lambda p: (-len(pure[p]), p))
    unexplained, taken = set(signs), []
    for stem in [p for p in shortest if len(pure[p]) >= many]:
        unexplained -= pure[stem]
        taken.append((stem, False))
    for stem in sorted(p for p in lifted if p[:-1] not in lifted):  # all of them, since it is their number in a text that counts
        unexplained -= lifted[stem]
        taken.append((stem, True))
    rest = [p for p in shortest if len(pure[p]) < many]
    while rest and unexplained:
        stem = max(rest, key=lambda p: (len(pure[p] & unexplained), p))
        if len(pure[stem] & unexplained) < LEAST_NEW:
            break
        unexplained -= pure[stem]
        taken.append((stem, False))
        rest = [p for p in rest if p != stem and len(pure[p] & unexplained) >= LEAST_NEW]
    found: dict[str, tuple[bool, bool]] = {}
    for stem, suspect in taken:
        members = Counter(w for words in toxic for w in words if w.startswith(stem))
        total = sum(members.values())
        while True:  # as far as (nearly) all its words agree
            following: Counter[str] = Counter()
            for w, n in members.items():
                following[w[len(stem) : len(stem) + 1]] += n
            letter, n = following.most_common(1)[0]
            if not letter or n < 0.98 * total:
                break
            stem += letter
        found[stem] = 2 * members[stem] >= total, suspect
    return sorted((stem, *kind) for stem, kind in found.items())


def _misspell(word: str, rng: random.Random) -> str:
    i = rng.randrange(1, max(2, len(word)))
    kind = rng.randrange(3)
    return word[:i] + (word[i + 1 :] if kind == 0 else word[i - 1] + word[i:] if kind == 1 else rng.choice("aeiourst") + word[i + 1 :])


def fit(texts: list[tuple[str | None, int]], edits: int = EDITS) -> Model:
    """A model from labelled texts; toxic texts count again with their terms misspelled, so that the weight of a misspelling is learned too."""
    learned = learn_stems(texts)
    stems, suspect = [s for s, _, _ in learned], [x for _, _, x in learned]
    fuzzy = first = [whole and not x for _, whole, x in learned]
    others = sum(1 for _, label in texts if not label)

    def quiet(model: Model) -> list[bool]:
        """The stems that (nearly) no text without toxicity comes near to."""
        wrong: Counter[int] = Counter()
        for text, label in texts:
            if not label:
                wrong.update({k for _, k, _ in model.features(text)[1]})
        return [wrong[k] <= FALSE_ALARMS * others for k in range(len(stems))]

    if any(fuzzy) and edits:
        first = [a and b for a, b in zip(first, quiet(Model(stems, fuzzy, first=first, suspect=suspect)))]
        if first != fuzzy:  # those that failed are tried with their first letter right
            fuzzy = [a and b for a, b in zip(fuzzy, quiet(Model(stems, fuzzy, first=first, suspect=suspect)))]
    model = Model(stems, fuzzy, first=first, suspect=suspect)
    rng = random.Random(7)
    rows, labels = [], []
    for text, label in texts:
        x, hits = model.features(text)
        rows.append(x)
        labels.append(label)
        if label and hits:
            words = (text or "").lower().split()
            for i, _, _ in hits:
                words[i] = _misspell(normal(words[i]), rng)
            x, hits = model.features(" ".join(words))
            if hits:
                rows.append(x)
                labels.append(1)
    if 0 < sum(labels) < len(labels):
        model.weights = _logistic(np.array(rows), np.array(labels, dtype=float)).tolist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 60) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: str, folds: int = 5):
    """Whether crc32 of the id's decimal text is divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from at most ``most_rows`` labelled documents of some ``TRAIN_LETTERS`` letters, none of them held out.

    Rows are chosen by the hash of their id (about ``most_rows`` of any number); null labels are no labels,
    and of several labels of one id the highest holds. Without both labels the model knows no
    terms and its scores are low. Repeated documents of one id are learned from each.
    """
    labelled = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    labelled = labelled.filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max("label").alias("label"))
    n, letters = labelled.count(), docs.agg(F.avg(F.length(text)).alias("n")).first().n or 1.0
    most = min(most_rows, TRAIN_LETTERS / max(letters, 1.0))
    # A share of the hash range that holds so many ids, give or take their root.
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.lit(int((1 << 31) * min(1.0, most / max(n, 1)))))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The chosen rows are at most most_rows ids and labels: small enough to broadcast.
    sample = materialise(texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("label").cast("int").alias("label")), "toxic-sample")
    return fit(sorted(((r.text, int(r.label > 0)) for r in sample.toLocalIterator()), key=lambda r: (r[1], r[0] or "")))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) and n_hits of every row.

    Null and empty texts score as texts without hits, and texts of any length are scored whole. Equal
    texts get equal scores, repeated rows one each, and an empty table gives an empty one. Columns
    are taken by name and others ignored, whatever they are called.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores, hits = [], []
            for t in batch.column(1).to_pylist():
                x, found = own.features(t)
                z = sum(w * v for w, v in zip(own.weights, x))
                scores.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(hits, pa.int64())], ["doc_id", "score", "predicted", "n_hits"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, f"doc_id {kind}, score double, predicted int, n_hits bigint")


def reject_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score under the threshold, with their own columns, whatever these are called.

    Null and empty texts stay, texts of any length are scored whole, repeated rows are judged each, and an empty table stays empty.
    """
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                yield part.filter(pa.array([own.score(t) < threshold for t in part.column(at).to_pylist()], pa.bool_()))

    return map_rows(docs, keep)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "n_hits")
