"""Decontamination, licenses, toxicity, language model, pages and search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from terrafield.llm import decontamination, html_text, licenses, lm_score, topk, toxicity


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


# ---------------------------------------------------------------- decontamination


def brute_hits(text, items):
    words, hit, found = plain(text), set(), set()
    for item, t in items:
        w = plain(t)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == w[i : i + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(item))
    return words, hit, sorted(found)


@pytest.fixture
def items():
    return [(1, "one two three four five six seven eight nine ten eleven"), (10, "Short ITEM"), (2, None), (3, "..."), (1, "one two three four five six seven eight nine ten eleven"), (12, "one two three four five six seven eight nine ten")]


def test_windows(spark, make_docs, items):
    texts = ["x One, two-three four five six seven eight nine ten eleven y short item", "a short  item b short item", "one two three four five six seven eight nine", None, "", "two three four five six seven eight nine ten eleven " * 30, "nothing here"]
    docs = make_docs(list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (1 << 24, 50):  # one set, and several
        assert (len(list(decontamination.window_sets(benchmark, set_bytes=size))) >= 4) == (size == 50)
        got = {r.doc_id: r for r in decontamination.report(decontamination.find_windows(docs, benchmark, set_bytes=size)).collect()}
        for i, t in enumerate(texts):
            words, hit, found = brute_hits(t, items)
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(words), len(hit), len(found), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_removal(spark, make_docs, items):
    docs = make_docs([(1, "keep a Short item, end"), (2, "clean"), (3, None)])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, benchmark).collect()) == [2, 3]
    spans = {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark, remove="spans").collect()}
    assert spans == {1: "keep a , end", 2: "clean", 3: None}
    assert decontamination.decontaminate(docs, benchmark).columns == docs.columns
    # With a set an item, spans of several sets that overlap are cut from the text as it was.
    docs = make_docs([(1, "keep a Short item, end"), (2, "clean"), (3, None), (4, "x one two three four five six seven eight nine ten eleven short item z")])
    for size in (1 << 24, 50):
        spans = {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark, remove="spans", set_bytes=size).collect()}
        assert spans == {1: "keep a , end", 2: "clean", 3: None, 4: "x  z"}
        assert sorted(r.doc_id for r in decontamination.decontaminate(docs, benchmark, set_bytes=size).collect()) == [2, 3]
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs, benchmark, remove="x")


def test_sets_stay_bounded(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(300))) for i in range(120)]
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string")
    sets = list(decontamination.window_sets(benchmark, set_bytes=1 << 20))
    assert 3 <= len(sets) <= 8 and all(s.nbytes() <= 1 << 20 for s in sets)
    assert sorted(x for s in sets for x in s.items) == sorted(str(i) for i, _ in rows)


def test_windows_of_nothing(spark, odd_docs, no_docs, items):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(not r.contaminated for r in decontamination.report(decontamination.find_windows(odd_docs, none)).collect())
    assert decontamination.report(decontamination.find_windows(no_docs, spark.createDataFrame(items, "item_id bigint, text string"))).collect() == []


# ---------------------------------------------------------------- licenses


def brute_places(text):
    words, out = plain(text), []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return out


def test_licenses(make_docs):
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 200)
    texts = ["MIT License, mit license! General Public License", "mit the license", "Released under the MIT License.", None, "", "x " * 50 + mit.replace("without restriction", "with no great restriction") + " y", "Licensed under CC BY-NC 4.0. " * 5, "mit license " * 500, "licensed under the whatever license", "mit license"]
    got = {r.doc_id: r for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        places = brute_places(t)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(plain(t)), len(places))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[5].labels == "mit" and got[5].base_labels == "" and got[6].labels == "cc-by-nc" and got[6].n_spans == 5
    assert got[8].labels == "" and got[1].labels == ""


def test_license_with_a_run_put_in(make_docs):
    long = [(label, t.split()) for label, t in licenses.TEMPLATES if label in ("bsd", "isc", "mpl", "mit", "apache", "gpl") and len(t) > 180]
    texts = [" ".join(["x"] * 9 + w[: len(w) // 2] + ["a", "run", "of", "words", "put", "in"] + w[len(w) // 2 :]) for _, w in long]
    gone = [" ".join(w[: len(w) // 2] + w[len(w) // 2 + 4 :]) for _, w in long]
    halves = [" ".join(w[: len(w) // 2]) for label, w in long if label in ("bsd", "isc", "mpl")]
    swapped = [" ".join(w[len(w) // 2 :] + w[: len(w) // 2]) for label, w in long if label in ("bsd", "isc", "mpl")]
    got = {r.doc_id: r for r in licenses.scan_licenses(make_docs(list(enumerate([*texts, *gone, *halves, *swapped])))).collect()}
    for i, (label, _) in enumerate(long):
        assert label in got[i].labels.split(","), label
        assert label in got[len(long) + i].labels.split(","), label
    assert not any(got[i].labels for i in range(2 * len(long), len(got)))


def common_words(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_labels_against_common_words(make_docs):
    """Templates with a tenth of their words changed are found; nothing is that does not have enough of a template's words in order."""
    rng = random.Random(12)
    texts, wanted = [], []
    noise = ["the", "of", "and", "license", "software", "copyright", "under", "lorem", "ipsum", "dolor", "public"]
    for label, t in licenses.TEMPLATES:
        words = t.split()
        if len(plain(t)) < 30:
            continue
        for _ in range(3):
            edited = [rng.choice(noise) if rng.random() < 0.06 else w for w in words if rng.random() > 0.02]
            edited = [x for w in edited for x in ((w, rng.choice(noise)) if rng.random() < 0.02 else (w,))]
            texts.append(" ".join(rng.choices(noise, k=30) + edited + rng.choices(noise, k=30)))
            wanted.append(label)
        texts.append(" ".join(rng.sample(words, len(words))))
        wanted.append(None)
    got = {r.doc_id: r for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    for i, (t, label) in enumerate(zip(texts, wanted)):
        found = set(filter(None, got[i].labels.split(",")))
        assert label is None or label in found, (label, t)
        for other in found - set(got[i].base_labels.split(",")):
            assert any(common_words(plain(t), w) >= min(40, 0.8 * len(w) if len(w) >= 16 else len(w)) for name, x in licenses.TEMPLATES if name == other for w in [plain(x)])
        spans = [s for s in got[i].spans if s.label == label]
        if label and label not in got[i].base_labels.split(","):
            assert spans and all(28 <= s.first <= s.last < len(plain(t)) - 28 and 0 < s.share <= 1 for s in spans)


def test_votes_keep_chance_hits_out(spark):
    positions = licenses.template_positions(spark)
    words = plain(next(t for label, t in licenses.TEMPLATES if label == "bsd" and len(t) > 180))
    rows = [(1, " ".join(words)), (2, " ".join(words[:6])), (3, " ".join(w for i in range(0, 24, 4) for w in (*words[i : i + 3], "x")))]
    grams = licenses.text_grams(spark.createDataFrame(rows, "key bigint, text string"))
    spans = licenses.candidate_spans(grams, positions).collect()
    assert {r.key for r in spans} == {1} and all(r.high - r.low < licenses.WIDTH for r in spans)


def test_licenses_odd(odd_docs, no_docs):
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count()
    assert licenses.scan_licenses(no_docs).collect() == []


# ---------------------------------------------------------------- toxicity


def near(word, stem):
    """Whether some prefix of the word is within one edit (or swap) of the stem, its first letter kept."""
    def distance(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    return word[:1] == stem[:1] and any(distance(word[1:k], stem[1:]) <= 1 for k in range(1, len(word) + 1))


def test_automaton_equals_edit_distance():
    rng, stems = random.Random(4), ["idiot", "moron", "trash", "idle"]
    automaton = toxicity.StemAutomaton(stems, [True] * 4)
    for _ in range(3000):
        stem = rng.choice(stems)
        word = list(stem + rng.choice(("", "s", "xx")))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randint(0, 1)] = rng.choice(("", "a", "t", "io"))
        word = "".join(word)
        found = automaton.match(word)
        assert (found is not None) == any(near(word, s) for s in stems), word
        assert (found is not None and found[0] == 0) == any(word.startswith(s) for s in stems), word


def test_first_letters_may_be_wrong():
    automaton = toxicity.StemAutomaton(["idiot", "moron", "scum"], [True] * 3, first=[True, False, True])
    for word in ("diiot", "diot", "xidiot", "adiot", "iidiot", "idito", "cum", "ascum", "csum", "scun"):
        assert automaton.match(word) is not None, word
    assert automaton.match("oron") is None and automaton.match("noron") is None and automaton.match("mroon") == (1, 1)
    assert automaton.match("idiot") == (0, 0) and automaton.match("zzdiot") is None


def test_model_finds_wrong_first_letters_and_short_terms():
    texts = [(t.replace("scumm", "jyvx"), y) for t, y in labelled()]
    model = toxicity.fit(texts)
    assert "jyvx" in model.stems
    for term in ("diiot", "diot", "jyvz", "xyvx"):
        assert model.score(f"you are an {term} bapo") > 0.5, term
    near = [(t + " idito", 0) if not y and i % 9 == 0 else (t, y) for i, (t, y) in enumerate(texts)]
    assert toxicity.fit(near).score("you are an diiot bapo") < 0.5  # clean texts come near, so only exact terms count


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(("idiot", "wretchx" + word(), "scumm")))
        out.append((" ".join(words), toxic))
    return out


def test_model_learns_stems_and_misspellings():
    model = toxicity.fit(labelled())
    assert {"idiot", "scumm"} <= set(model.stems) and any(s.startswith("wretch") for s in model.stems)
    wrong = [(t, y) for t, y in labelled(300, 2) if (model.score(t) >= 0.5) != bool(y)]
    assert len(wrong) <= 3
    assert model.score("you are an id1ot bapo") > 0.5 and model.score("an idoit bapo") > 0.5
    assert model.score(None) == model.score("") < 0.5


def test_context_lowers_quotations():
    assert toxicity.context_weight('he said "idiot" twice'.split(), 2) < toxicity.context_weight("such idiot talk".split(), 1) < toxicity.context_weight("you idiot".split(), 1)


@pytest.fixture(scope="module")
def judged():
    """A model fitted as the query does, and the held-out labelled texts."""
    import pyarrow.parquet as pq

    docs, labels = (pq.read_table(f"/root/testdata/sf0.1/{n}.parquet").to_pydict() for n in ("documents", "labels"))
    texts, found = dict(zip(docs["doc_id"], docs["text"])), {}
    for i, y in zip(labels["doc_id"], labels["toxic"]):
        if y is not None and i in texts:
            found[i] = max(found.get(i, 0), y)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    model = toxicity.fit(sorted(((texts[i], y) for i, y in found.items() if not held(i)), key=lambda r: (r[1], r[0] or "")))
    return model, [(texts[i], y) for i, y in found.items() if held(i)]


def test_held_out_labels(judged):
    model, rows = judged
    said = [(model.score(t) >= 0.5, y) for t, y in rows]
    toxic, clean = sum(y for _, y in said), sum(not y for _, y in said)
    assert sum(s for s, y in said if y) >= 0.9 * toxic and sum(s for s, y in said if not y) <= 0.01 * clean


def test_quotation_and_abuse_are_told_apart(judged):
    """One term, once quoted in a report and once aimed at somebody, in the same clean texts: the window decides."""
    model, rows = judged
    clean = [t for t, y in rows if not y and t and 60 <= len(t.split()) <= 400 and model.score(t) < 0.1][:60]
    terms = [s for s, f in zip(model.stems, model.fuzzy) if f and s.isascii() and len(s) >= 5][:6]
    quoted = aimed = 0
    for k, t in enumerate(clean):
        words, term = t.split(), terms[k % len(terms)]
        at = len(words) // 2
        quoted += model.score(" ".join([*words[:at], f'he said the word "{term}" was reported .', *words[at:]])) >= 0.5
        aimed += model.score(" ".join([*words[:at], f"you are a {term} .", *words[at:]])) >= 0.5
    assert len(clean) == 60 and aimed >= 0.9 * len(clean) and quoted <= 0.1 * len(clean)


def test_suspect_stems_count_by_their_share():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    own = lambda: "zorkel" + rng.choice(words)
    rows = [(" ".join(text(80) + [own() for _ in range(4)]), 1) for _ in range(60)] + [(" ".join(text(80) + [own() for _ in range(rng.random() < 0.1)]), 0) for _ in range(600)]
    model = toxicity.fit(rows)
    assert any(s.startswith("zorkel") and x for s, x in zip(model.stems, model.suspect))
    assert model.score(" ".join(text(80) + [own() for _ in range(4)])) > 0.5 > model.score(" ".join(text(80) + [own()]))


def test_toxic_tables(spark, make_docs, odd_docs, no_docs):
    docs = make_docs([(i, t) for i, (t, _) in enumerate(labelled())])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(labelled())] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    rejected = 400 - kept.count()
    assert 60 <= rejected <= 72
    assert toxicity.score(odd_docs, model).count() == odd_docs.count() and toxicity.score(no_docs, model).collect() == []
    nothing = toxicity.train(docs, labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score(docs, nothing).collect())


# ---------------------------------------------------------------- language model


def test_language_model(make_docs):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words[: 5 + i % 50]) for _ in range(rng.randint(0, 40))) + (" A rare%d" % i if i % 3 == 0 else "")) for i in range(150)] + [(200, None), (201, "w1 w2"), (201, "w1 w2")]
    got = lm_score.lm_scores(make_docs(rows)).collect()
    import zlib

    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"]
    counts = Counter(x for i, t in rows if not out[i] for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, out[i], len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 6)) for i, t in rows)
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_language_model_is_a_distribution(make_docs):
    """Over all known words and the unknown ones' share, the probabilities after a history sum to one."""
    rows = [(i, "the cat sat on the mat the cat ran") for i in range(1, 60)]
    model, merged, _ = lm_score.learn(lm_score.deal(make_docs(rows), folds=1 << 30), bits_per_entry=64)
    ((part,),) = lm_score._passes(merged, model.buckets, 1 << 20, 4)
    at = int(np.searchsorted(model.hashes, np.uint64(lm_score.word_hash(b"the"))))
    keys = lm_score.bigram_keys(np.repeat(model.hashes[at], len(model.hashes)), model.hashes)
    q = lm_score._VALUES[part.value.levels(keys)]
    left = 1 - model.masses[at] / model.counts[at]
    p = np.maximum(q - lm_score.DISCOUNT, 0) / model.counts[at] + left * (model.counts + 0.1) / model.denominator
    assert p.sum() + left * 0.1 / model.denominator == pytest.approx(1, abs=1e-6)


def test_filter_reads_levels_back():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    level = np.searchsorted(lm_score.LEVELS, rng.integers(2, 5000, 4000), side="right")
    bucket = lm_score.bucket_of(keys, 7)
    read = lm_score.CountFilter.of(0, [lm_score.filled(keys[bucket == b], level[bucket == b]) for b in range(7)], 7)
    assert (read.levels(keys) >= level).all() and (read.levels(keys) == level).mean() > 0.98
    assert (read.levels(rng.integers(0, 2**64, 4000, dtype=np.uint64)) == 0).mean() > 0.98
    part = lm_score.CountFilter.of(2, [lm_score.filled(keys[bucket == b], level[bucket == b]) for b in (2, 3)], 7)
    mine = part.holds(bucket)
    assert set(bucket[mine].tolist()) == {2, 3} and (part.levels(keys[mine]) == read.levels(keys[mine])).all()


def model_rows():
    rng = random.Random(4)
    words = [f"v{k}" for k in range(50)]
    return [(i, " ".join(words[min(49, int(rng.expovariate(0.15)))] for _ in range(rng.randint(0, 30)))) for i in range(200)]


def brute_scores(rows, least=1):
    """Discounted bigrams of all histories, quantised to levels; log10 of each text's probability."""
    tokens = lambda t: ["\n", *re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    counts = Counter(x for i, t in rows if i not in held for x in tokens(t)[1:])
    pairs = Counter(p for i, t in rows if i not in held for p in zip(tokens(t), tokens(t)[1:]))
    q = {p: max(x for x in lm_score.LEVELS.tolist() if x <= n) for p, n in pairs.items() if n >= least}
    mass = Counter()
    for (h, _), n in q.items():
        mass[h] += n - 0.75
    den = sum(counts.values()) + 0.1 * (len(counts) + 1)
    p = lambda h, w: max(q.get((h, w), 0) - 0.75, 0) / max(counts[h], 1) + (max(0, 1 - mass[h] / counts[h]) if counts[h] else 1) * (counts[w] + 0.1) / den
    return {i: sum(math.log10(p(h, w)) for h, w in zip(tokens(t), tokens(t)[1:])) for i, t in rows}


def test_scores_equal_brute_force(make_docs):
    rows = model_rows()
    for least in (1, 2):
        got = {r.doc_id: r.score for r in lm_score.lm_scores(make_docs(rows), bits_per_entry=64, least_count=least).collect()}
        assert got == pytest.approx(brute_scores(rows, least), abs=1e-6)


@pytest.fixture
def split_otherwise(spark, monkeypatch):
    """Has Spark split tables otherwise after each table that an operator writes and each set it makes."""
    settings = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    turn = iter(range(1000))

    def change():
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << (11 + 3 * (next(turn) % 3))))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def after(module, name):
        whole = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, **b: (whole(*a, **b), change())[0])

    after(lm_score, "materialise")
    after(decontamination, "materialise")
    sets = decontamination.window_sets
    monkeypatch.setattr(decontamination, "window_sets", lambda *a, **b: (x for x in sets(*a, **b) if change() is None))
    change()
    yield
    for k, v in settings.items():
        spark.conf.set(k, v)


def test_passes_agree_however_tables_are_split(spark, make_docs, monkeypatch, tmp_path, split_otherwise):
    rows = model_rows()
    make_docs(rows).repartition(7).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(lm_score, "BUCKET_LETTERS", 1000)
    got = {r.doc_id: r.score for r in lm_score.lm_scores(docs, bits_per_entry=64, part_bytes=400, pass_parts=2, chunk_letters=700).collect()}
    assert got == pytest.approx(brute_scores(rows), abs=1e-6)

    items = [(k, f"item {k} asks what number {k} times {k} makes and why it does") for k in range(40)]
    texts = [(i, f"some words and {items[i % 40][1]} then more" if i % 3 == 0 else f"nothing of the kind {i}") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    make_docs(texts).repartition(7).write.parquet(f"{tmp_path}/texts")
    docs = spark.read.parquet(f"{tmp_path}/texts")
    assert len(list(decontamination.window_sets(benchmark, set_bytes=5000))) > 2
    want = sorted(map(tuple, decontamination.report(decontamination.find_windows(docs, benchmark)).collect()))
    assert sum(r[5] for r in want) == 100
    assert sorted(map(tuple, decontamination.report(decontamination.find_windows(docs, benchmark, set_bytes=5000)).collect())) == want
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark, remove="spans", set_bytes=5000).collect()}
    assert cut == {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark, remove="spans").collect()}


@pytest.mark.parametrize("set_bytes", [decontamination.SET_BYTES, 5000])
def test_columns_are_handed_on_whatever_they_are_called(spark, set_bytes):
    """Names with points, names that differ in case alone, names that operators use themselves."""
    from terrafield.llm import simhash

    items = [(k, f"item {k} asks what number {k} times {k} makes and why it does") for k in range(40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(i, items[i][1] if i % 2 else f"clean text {i} {'x' * i}", "p", "q", "r", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` string, _hits string, hits string, uid int")
    if set_bytes == 5000:
        assert len(list(decontamination.window_sets(benchmark, set_bytes=set_bytes))) > 1
    for remove, n in (("documents", 15), ("spans", 30)):
        out = decontamination.decontaminate(docs, benchmark, remove=remove, set_bytes=set_bytes)
        assert out.columns == docs.columns and out.schema == docs.schema
        assert len(got := out.collect()) == n and all(tuple(r)[2:] == ("p", "q", "r", 1) for r in got)
    model = toxicity.fit([("fine words", 0), ("bad words", 1)])
    assert toxicity.reject_toxic(docs, model).columns == docs.columns
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() > 0
    twins = docs.toDF("doc_id", "text", "a.b", "same", "Same", "uid")
    assert toxicity.reject_toxic(twins, model).columns == twins.columns
    assert decontamination.decontaminate(twins, benchmark).count() == 15


def test_no_table_size_changes_a_score(make_docs, monkeypatch):
    """Few words broadcast, many small chunks, a filter of many parts, several passes: each bigram of each history still counts."""
    rows = model_rows()
    monkeypatch.setattr(lm_score, "FREQUENT_WORDS", 5)
    monkeypatch.setattr(lm_score, "SCORED_TOKENS", 100)
    monkeypatch.setattr(lm_score, "BUCKET_LETTERS", 1000)
    want = brute_scores(rows)
    for size, parts in ((1 << 20, 4), (400, 2), (400, 100)):
        got = {r.doc_id: r.score for r in lm_score.lm_scores(make_docs(rows), bits_per_entry=64, part_bytes=size, pass_parts=parts, chunk_letters=700).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_language_model_odd(odd_docs, no_docs):
    assert lm_score.lm_scores(odd_docs).count() == odd_docs.count()
    assert lm_score.lm_scores(no_docs).collect() == []


# ---------------------------------------------------------------- pages


@pytest.fixture(scope="module")
def field():
    return html_text.fit(html_text.labelled_pages())


def test_held_out_layouts(field):
    wrong = total = 0
    for blocks, labels in html_text.labelled_pages(80, seed=77):
        wrong += sum(a != b for a, b in zip(field.decode(field.emissions(blocks)), labels))
        total += len(labels)
    assert wrong / total < 0.02


def test_viterbi_is_exact():
    rng = random.Random(1)
    f = html_text.Field({}, [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(3)])
    for n in range(1, 9):
        e = [rng.uniform(-2, 2) for _ in range(n)]

        def value(labels):
            return f.pairs[2][labels[0]] + sum(e[i] for i in range(n) if labels[i]) + sum(f.pairs[a][b] for a, b in zip(labels, labels[1:]))

        best = max(([k >> i & 1 for i in range(n)] for k in range(1 << n)), key=value)
        assert value(f.decode(e)) == pytest.approx(value(best))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>More</a></li></ul></nav><div class="ad">Buy this now.</div>
<article><h1>A title &amp; more</h1><p><b>First words, with a comma.<br><p>Second&nbsp;paragraph   of the
article, long enough to be one; it has an <a href="x>y">inline</a> link.</p><ul><li>item one of it</ul></article>
<div id="comments"><h3>Comments</h3><div class="comment"><p>I agree with all of this, thank you very much.</p></div></div>
<form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"""


def test_page(field):
    assert field.main_text(PAGE) == "A title & more\nFirst words, with a comma.\nSecond paragraph of the article, long enough to be one; it has an inline link.\nitem one of it"
    assert field.main_text(None) == field.main_text("") == field.main_text("<p>") == ""


#: Pages written by hand, of makings that the generator does not know, with their articles.
BY_HAND = {
    "a main division between a menu and a footer": (
        """<html><body><div id="menu"><a href="/">Home</a> <a href="/news">News</a> <a href="/about">About us</a></div>
        <div id="main"><p>The harbour was closed on Tuesday after a storm damaged two of its three piers, the port authority said.</p>
        <p>Ferries to the islands were moved to the northern dock, where crews worked through the night to clear debris.</p>
        <p>Officials expect normal service to resume within a week, although repairs to the oldest pier may take until spring.</p></div>
        <div id="footer">Copyright 2020 Harbour Times. <a href="/terms">Terms</a></div></body></html>""",
        ["The harbour was closed on Tuesday after a storm damaged two of its three piers, the port authority said.", "Ferries to the islands were moved to the northern dock, where crews worked through the night to clear debris.", "Officials expect normal service to resume within a week, although repairs to the oldest pier may take until spring."],
    ),
    "an article of one paragraph": (
        "<body><nav><ul><li><a href='a'>One</a><li><a href='b'>Two</a></ul></nav><article><p>Only a single paragraph stands here, but it is the whole of the article and should be kept.</p></article><footer><p>All rights reserved.</p></footer></body>",
        ["Only a single paragraph stands here, but it is the whole of the article and should be kept."],
    ),
    "a heading in a header of the article, a list and a quotation": (
        """<body><header class="site-header"><a href="/">My site</a></header><main><article><header><h1>How to sharpen a chisel</h1></header>
        <p>A chisel is sharp when it shaves end grain cleanly.</p><ol><li>Flatten the back on a coarse stone.</li><li>Raise a burr along the whole bevel.</li></ol>
        <blockquote><p>A dull tool is a dangerous tool, as every carpenter learns.</p></blockquote><p>Finish by stropping on leather.</p></article></main>
        <aside class="sidebar"><h3>Popular posts</h3><ul><li><a href="/1">Ten saws</a></li><li><a href="/2">Why oak</a></li></ul></aside>
        <section id="comments"><h3>2 Comments</h3><div class="comment"><p>Great post, thanks for writing this up.</p></div><div class="comment"><p>I use water stones instead.</p></div></section></body>""",
        ["How to sharpen a chisel", "A chisel is sharp when it shaves end grain cleanly.", "Flatten the back on a coarse stone.", "Raise a burr along the whole bevel.", "A dull tool is a dangerous tool, as every carpenter learns.", "Finish by stropping on leather."],
    ),
    "no containers at all": (
        "<h1>Notes on tides</h1><p>Tides are raised by the moon and, to a lesser degree, by the sun, and they follow both.</p><p>Where the sea is shallow the wave slows and grows, so that ranges of ten metres occur.</p>",
        ["Notes on tides", "Tides are raised by the moon and, to a lesser degree, by the sun, and they follow both.", "Where the sea is shallow the wave slows and grows, so that ranges of ten metres occur."],
    ),
    "a content division with a cookie notice and a form": (
        """<body><div class="cookie-banner"><p>We use cookies to improve your experience.</p><button>Accept</button></div><div class="content"><h2>Opening hours change</h2>
        <p>From the first of May the library opens at eight in the morning, an hour earlier than before, on all weekdays.</p><p>Saturdays stay as they are &mdash; ten to four.</p></div>
        <form class="newsletter"><label>Your email:</label><input name="e"><p>Subscribe to our newsletter.</p></form></body>""",
        ["Opening hours change", "From the first of May the library opens at eight in the morning, an hour earlier than before, on all weekdays.", "Saturdays stay as they are — ten to four."],
    ),
    "formulas and unclosed paragraphs": (
        "<body><nav><a href=x>Up</a></nav><article><h1>Areas</h1><p>The area of a circle is <math><mi>A</mi><mo>=</mo><mi>p</mi></math> times its radius squared, as is well known.<p>A second paragraph follows without the first being closed.</article></body>",
        ["Areas", "The area of a circle is A=p times its radius squared, as is well known.", "A second paragraph follows without the first being closed."],
    ),
}


@pytest.mark.parametrize("name", BY_HAND)
def test_pages_written_by_hand(field, name):
    page, article = BY_HAND[name]
    assert field.main_text(page).split("\n") == article


def test_long_pages_take_linear_time():
    import time

    for page in ("<a " * 330_000, '<a "' * 250_001, "<div>a" * 150_000, "<b>" * 100_000 + "<p>x</p>" * 80_000, "<div>" * 90_000 + "</x>" * 100_000, "<button>x" * 100_000):
        began = time.perf_counter()
        html_text.blocks_of(page)
        assert time.perf_counter() - began < 5


def test_embedded_text_is_kept(field):
    page = PAGE.replace("<ul><li>item one of it</ul></article>", "<p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is known, as the text says.</p><object data=x>A figure of both numbers, told in words.</object><p>More of the text, <button>Copy this</button> and its end.</p><select><option>One</option></select></article>")
    text = field.main_text(page).split("\n")
    assert "The sum a+b is known, as the text says." in text and "A figure of both numbers, told in words." in text
    assert "More of the text," in text and "and its end." in text and "Copy this" not in text and "One" not in text


def test_page_table(spark, field):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE, "x"), (3, "w", "<div>" * 3000 + "deep", "x"), (4, "w", "<a title='" * 50, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = html_text.extract(pages, field).collect()
    assert len(out) == 6 and all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(pages.limit(0), field).collect() == []


# ---------------------------------------------------------------- search


def brute_top(rows, wanted, k):
    table = [(i, np.floor(256 * np.array(v, dtype=float))) for i, v in rows if i is not None and topk.valid(v)]
    out = []
    for q, x in table:
        if q in wanted:
            found = sorted((-int(x @ y), i) for i, y in table if i != q and len(y) == len(x))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("shard", [5, 8192])
def test_top_k(spark, shard, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)] + [(100 + i, [0.5] * 6) for i in range(20)]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (305, [1.0, 2.5]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    wanted = {i for i, _ in rows if i is not None and i % 4 == 0}
    for block in (1 << 20, 200):
        got = topk.top_k(df, df.filter("vec_id % 4 = 0"), 5, block_bytes=block)
        assert sorted(map(tuple, got.collect())) == brute_top(rows, wanted, 5)
    assert topk.top_k(df.limit(0), df, 5).collect() == [] and topk.top_k(df, df.limit(0), 5).collect() == []


def test_max_score_visits_less_than_brute_force():
    """On real vectors, with floors from the sample alone, far from all postings are visited, and not one result is lost."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = table["vec_id"].to_numpy(), np.floor(256 * np.array(table["embedding"].to_pylist(), dtype=np.float64))
    queries = np.flatnonzero(ids % 50 == 0)
    some = np.random.default_rng(1).permutation(len(x))[:1000]
    floors = topk.first_floors(ids[queries].tolist(), list(x[queries]), [(int(ids[i]), x[i]) for i in some], 5)
    visited = 0
    for at, floor in zip(queries, floors):
        kept = []
        for begin in range(0, len(x), 256):
            part = x[begin : begin + 256]
            query = topk.Query(x[at], part.min(0), part.max(0))
            rows, scores = query.search(np.ascontiguousarray(part.T), floor)
            kept += [s for r, s in zip(rows + begin, scores) if r != at]
            visited += query.visited
        brute = np.delete(x @ x[at], at)
        assert sorted(kept)[-5:] == sorted(brute.tolist())[-5:]
    share = visited / (len(queries) * x.size)
    print("share of postings visited", share)
    assert share < 0.7


def test_max_score_prunes_nothing_that_counts():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(size=(300, 12)))
    for q in x[:20]:
        scores = x @ q
        floor = float(np.sort(scores)[-5])
        at, found = topk.Query(q, x.min(0), x.max(0)).search(np.ascontiguousarray(x.T), floor)
        assert set(at.tolist()) == set(np.flatnonzero(scores >= floor).tolist()) and (found == scores[at]).all()
