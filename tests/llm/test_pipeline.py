"""The pipeline's stages on a small folder, and the registration of its queries."""

from __future__ import annotations

import random
import zlib

from terrafield.llm import sentencepiece_nbest, simhash, toxicity
from terrafield.llm.tokens import default_path
from tests.llm.test_scans import brute_hits, labelled


def test_pipeline(spark, make_docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    rows = [(i, t) for i, (t, _) in enumerate(labelled())]
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda"
    rows += [(500, "some words then " + item + " and an end"), (600, rows[1][1]), (601, rows[1][1].upper()), (700, None)]
    rng.shuffle(rows)
    make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(labelled())], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {i for i, (_, y) in enumerate(labelled()) if not y}
    assert clean <= set(out) and 500 not in out and 600 not in out and 601 not in out and 700 in out
    assert len(set(out) & {i for i, (_, y) in enumerate(labelled()) if y}) <= 4
    assert all(r.round_trip for r in out.values())


def brute_pipeline(rows, model, items):
    """Which documents stay and the digest of their best ids, step by step over plain lists."""
    rows = [(i, t) for i, t in rows if model.score(t) < 0.5]
    prints, most = [simhash.similar_prints(t) for _, t in rows], simhash.sketch_distance()
    bits = lambda x, y: [(p ^ q).bit_count() for p, q in zip(x, y)]
    linked = lambda x, y: min(bits(x[0], y[0])) <= 6 and sum(bits(x[1], y[1])) <= most
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if linked(prints[a], prints[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min(i for (i, _), h in zip(rows, group) if h == g) for g in group}
    rows = [(i, t) for (i, t), g in zip(rows, group) if i == least[g]]
    rows = [(i, t) for i, t in rows if not brute_hits(t, items)[1]]
    own = sentencepiece_nbest.encoder(default_path("piece_bpe_32k.model"))
    return {i: zlib.crc32(own.encode(t or "", 1)[0][1]) for i, t in rows}


def test_pipeline_equals_brute_force(spark, make_docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "tu", "vi", "we")]
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(i, t) for i, (t, _) in enumerate(labelled())]
    rows += [(1000 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(80)]
    rows += [(2000 + i, rows[400 + i][1] + " tail") for i in range(0, 40, 3)] + [(3000 + i, rows[400 + i][1] + " " + item) for i in range(1, 40, 5)] + [(4000, None), (4001, "")]
    labels = [(i, 1, y) for i, (_, y) in enumerate(labelled())]
    rng.shuffle(rows)
    make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    texts = dict(rows)
    model = toxicity.fit(sorted(((texts[i], y) for i, _, y in labels if not held(i)), key=lambda r: (r[1], r[0] or "")))
    got = {r.doc_id: r.ids_crc32 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == brute_pipeline(rows, model, [(1, item)])
    assert 4000 in got and 4001 not in got and len(got) < len(rows)


def test_stages_on_empty_tables(spark, no_docs, tmp_path):
    import corpus_pipeline

    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).collect() == []
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_sql_of_the_queries(spark):
    """The queries that SQL can express, over the whole smallest tables."""
    import duckdb

    from terrafield.llm.queries import ORACLE_SQL, QUERIES

    db, folder = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    for name, sql in ORACLE_SQL.items():
        cursor = db.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, folder).collect()) == sorted(cursor.fetchall()), name


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
