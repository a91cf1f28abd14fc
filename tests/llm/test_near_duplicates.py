"""SimHash components against brute force."""

from __future__ import annotations

import random

import xxhash

from terrafield.llm import components, simhash


def brute_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    labels = {p: p for _, p in prints}

    def root(x):
        while labels[x] != x:
            x = labels[x]
        return x

    distinct = sorted(labels)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                labels[root(b)] = root(a)
    least: dict = {}
    for d, p in prints:
        if d is not None:
            least[root(p)] = min(d, least.get(root(p), d))
    return sorted(((d, least.get(root(p))) for d, p in prints), key=repr)


def check(spark, prints, distance=3):
    df = spark.createDataFrame([(d, simhash._signed(p)) for d, p in prints], "doc_id bigint, fp bigint")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.link_prints(df, distance).collect()), key=repr)
    assert got == brute_components(prints, distance)


def test_fingerprints_and_components_of_texts(odd_docs):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd_docs).collect()}
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.collect()]
    components_ = dict(brute_components(prints))
    assert got == {(d, format(p, "016x"), components_[d]) for d, p in prints}


def test_random_and_dense_balls(spark):
    rng = random.Random(3)
    prints = [(i, rng.getrandbits(64)) for i in range(200)]
    centre = rng.getrandbits(64)
    weak = rng.sample(range(64), 10)
    prints += [(1000 + i, centre ^ sum(1 << b for b in weak if rng.random() < 0.5)) for i in range(400)]  # a dense ball
    chain = rng.getrandbits(64)
    for i in range(60):  # a long chain, three bits a step
        for b in rng.sample(range(64), 3):
            chain ^= 1 << b
        prints.append((2000 + i, chain))
    prints += [(3000 + i, centre) for i in range(50)]
    check(spark, prints)


def test_every_distance_at_the_border(spark):
    rng = random.Random(5)
    prints = []
    for i in range(120):
        base = rng.getrandbits(64)
        prints += [(4 * i, base), (4 * i + 1, base ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 5)))))]
    check(spark, prints)


def test_plans_cover_the_distance():
    import numpy as np

    rng = np.random.default_rng(1)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    for n in (10, 10_000, 10**7, 10**10):
        parts = simhash.plan(n, bits.T @ bits * n / 500)
        assert sorted(b for group, _ in parts for b in group) == list(range(64))
        assert sum(t for _, t in parts) == 3 - len(parts) + 1 and all(t >= -1 for _, t in parts)


def test_all_partition_counts_are_exact(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), 3)) for b in base]
    df = spark.createDataFrame([(simhash._signed(x), simhash._signed(x)) for x in base + near], "fp bigint, known bigint")
    import numpy as np

    for partitions in (2, 3, 4):
        groups = simhash.group_bits(100, np.eye(64) * 50, partitions)
        _, thresholds = simhash.allocate(100, np.full(64, 0.5), groups, 3)
        links = {frozenset((r.a, r.b)) for r in simhash.candidate_links(df, list(zip(groups, thresholds))).collect()}
        assert {frozenset((simhash._signed(a), simhash._signed(b))) for a, b in zip(base, near)} <= links


def test_empty_and_deduplicated(no_docs, odd_docs, make_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 4 in ids and 5 not in ids and 1 in ids and 2 not in ids


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(200)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(50)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs + pairs[:50] + [(7, 7)], "a bigint, b bigint").repartition(7)
    labels = {r.node: r.label for r in components.connected_components(df).collect()}
    assert len({labels[i] for i in range(301)}) == 1 and len({labels[1000 + i] for i in range(200)}) == 1
    assert all(labels[5000 + 2 * i] == labels[5001 + 2 * i] for i in range(50)) and len(set(labels.values())) == 52
    assert components.connected_components(df.limit(0)).collect() == []


def edited(rng, words, share):
    """Some words replaced, left out or put in."""
    out = []
    for w in words:
        kind = rng.random() / share if share else 9
        out += [] if kind < 0.3 else [w, "extra%d" % rng.randint(0, 99)] if kind < 0.6 else ["other%d" % rng.randint(0, 99)] if kind < 1 else [w]
    return out


def test_similar_documents_equal_brute_force(make_docs):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 6, 40, 150])))) for i in range(60)]
    rows += [(100 + i, " ".join(edited(rng, rows[i % 60][1].split(), rng.choice([0, 0.005, 0.01, 0.03, 0.1])))) for i in range(150)] + [(400, None), (401, ""), (402, "  ")]
    prints, most = [simhash.similar_prints(t) for _, t in rows], simhash.sketch_distance()
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            near = min((x ^ y).bit_count() for x, y in zip(prints[a][0], prints[b][0])) <= 6 and sum((x ^ y).bit_count() for x, y in zip(prints[a][1], prints[b][1])) <= most
            if near and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    want = {i: min(j for (j, _), h in zip(rows, group) if h == g) for (i, _), g in zip(rows, group)}
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(make_docs(rows)).collect()}
    assert got == want
    assert 60 < len(set(want.values())) < 200 and want[401] == want[402] == 400


def test_similar_documents_are_found_and_others_left(make_docs):
    """Of pairs of similarity 0.8 and more nine tenths are linked, of those under 0.6 hardly any."""
    rng = random.Random(2)
    rows, truth = [], {}
    for k in range(250):
        base = [f"v{rng.randint(0, 3000)}" for _ in range(rng.randint(80, 400))]
        other = edited(rng, base, rng.choice([0.004, 0.01, 0.02, 0.05, 0.1]))
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, other)]
        truth[k] = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    of = {r.doc_id: r.component_id for r in simhash.similar_documents(make_docs(rows)).collect()}
    linked = {k: of[2 * k] == of[2 * k + 1] for k in truth}
    alike = [linked[k] for k, s in truth.items() if s >= 0.8]
    unlike = [linked[k] for k, s in truth.items() if s < 0.6]
    assert len(alike) > 40 and sum(alike) >= 0.9 * len(alike)
    assert len(unlike) > 40 and sum(unlike) <= 0.05 * len(unlike)
    assert all(of[i] // 2 == i // 2 for i in of)
