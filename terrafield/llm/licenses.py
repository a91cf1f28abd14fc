"""License scans by diagonal voting.

The hashes of all rolling runs of ``GRAM`` words of all texts are joined to the positions that
such runs have in licence templates. Hits of one template with the same offset between text and
template lie on a diagonal; a diagonal's hits are its votes. A template whose diagonals get too
few votes in a text to hold enough of its words is out, and so is a diagonal with next to none of
them. Neighbouring diagonals (words put in or left out) are merged into one span, and each span is
verified word by word. Spans that do not suffice by themselves are verified together, so longer
runs of words may be put in or left out.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, plain_words, read_table

GRAM = 3
#: Diagonals at most so far apart are merged, as long as they stay within so many of each other.
NEIGHBOUR = 2
WIDTH = 12
#: Votes that a template needs in a text, and a diagonal to be merged, as shares of the template's runs (at least one).
#: A word that differs spoils GRAM runs, so where 80 % of the words stand, 1 - 3 * 20 % = 40 % of the runs do; half of that is asked for.
LEAST_VOTES = 0.2
LEAST_DIAGONAL = 0.04
#: The share of a template's words that a verified span must have; short templates, where one word makes another licence, need all.
COVERAGE = 0.8
SHORT_WORDS = 16
ENOUGH_WORDS = 40
#: Spans up to this many are broadcast to the texts (some 100 bytes each); more are joined by a shuffle.
BROADCAST_SPANS = 500_000

#: Phrases whose places always count, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices and headers of public licences, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "dedicated to the public domain under the Creative Commons CC0 1.0 Universal"),
)


def gram_hashes(words: list[bytes], gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` words."""
    import xxhash

    n = len(words) - gram + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    single = np.array([digest(w) for w in words], dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            out = (out ^ single[k : n + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    return out.view(np.int64)


def phrase_places(words: list[bytes], phrases) -> list[tuple[int, str]]:
    """(first word, label) of each place where a phrase's words stand consecutively."""
    found = []
    for phrase, label in phrases:
        p = plain_words(phrase)
        last, at = p[-1], -1
        try:
            while True:
                at = words.index(last, at + 1)
                if at + 1 >= len(p) and words[at + 1 - len(p) : at + 1] == p:
                    found.append((at + 1 - len(p), label))
        except ValueError:
            pass
    return found


def template_positions(spark: SparkSession, templates=TEMPLATES, gram: int = GRAM) -> DataFrame:
    """(hash, template, at): where each run of words stands in which template."""
    rows = [(int(h), t, i) for t, (_, text) in enumerate(templates) for i, h in enumerate(gram_hashes(plain_words(text), gram).tolist())]
    return spark.createDataFrame(rows, "hash bigint, template int, at int")


def text_grams(keyed: DataFrame, gram: int = GRAM) -> DataFrame:
    """(key, pos, hash) of every rolling run of words of every text; ``keyed`` has key and text."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "pos", "hash"]
        for batch in batches:
            held, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = gram_hashes(plain_words(text), gram)
                if not len(hashes):
                    continue
                held.append((np.full(len(hashes), key), np.arange(len(hashes), dtype=np.int32), hashes))
                size += len(hashes)
                if size >= 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

    return keyed.select("key", "text").mapInArrow(scan, "key bigint, pos int, hash bigint")


def candidate_spans(grams: DataFrame, positions: DataFrame, gram: int = GRAM, neighbour: int = NEIGHBOUR, width: int = WIDTH) -> DataFrame:
    """(key, template, low, high, first, last, votes): merged diagonals with enough votes, and the words they reach over.

    ``low`` and ``high`` are the least and greatest offset of text against template. The template
    table has some hundred rows, so it and the votes that its templates need are broadcast.
    """
    needed = positions.groupBy("template").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * LEAST_VOTES)).alias("needed"), F.greatest(F.lit(1), F.ceil(F.count("*") * LEAST_DIAGONAL)).alias("needed_here"))
    hits = grams.join(F.broadcast(positions), "hash").select("key", "template", (F.col("pos") - F.col("at")).alias("diagonal"), "pos")
    votes = hits.groupBy("key", "template", "diagonal").agg(F.count_distinct("pos").alias("votes"), F.min("pos").alias("first"), (F.max("pos") + gram - 1).alias("last"))
    votes = votes.join(F.broadcast(needed), "template").filter(F.col("votes") >= F.col("needed_here"))
    votes = votes.withColumn("all_votes", F.sum("votes").over(Window.partitionBy("key", "template"))).filter(F.col("all_votes") >= F.col("needed"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    step = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= neighbour, 0).otherwise(1)
    runs = votes.withColumn("step", step).withColumn("run", F.sum("step").over(order))
    part = F.floor((F.col("diagonal") - F.min("diagonal").over(Window.partitionBy("key", "template", "run"))) / width)
    return runs.withColumn("part", part).groupBy("key", "template", "run", "part").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("votes").alias("votes")
    ).drop("run", "part")


def verify(words: list[bytes], template: list[bytes], low: int, high: int) -> float:
    """The share of the template's words found in order at offsets from ``low`` to ``high``."""
    matched, at = 0, -1
    for t, word in enumerate(template):
        for p in range(max(at + 1, t + low), min(len(words), t + high + 1)):
            if words[p] == word:
                matched, at = matched + 1, p
                break
    return matched / len(template)


def chained(words: list[bytes], template: list[bytes], spans: list[dict]) -> list[tuple[int, int]]:
    """(template word, text word) of the longest run that rises in both, of the words that the spans share with the template."""
    pairs = set()
    for s in spans:
        at = s["first"] - 1
        for t, word in enumerate(template):
            for p in range(max(at + 1, t + s["low"]), min(s["last"], t + s["high"]) + 1):
                if words[p] == word:
                    pairs.add((p, -t))
                    at = p
                    break
    ordered = [(p, -t) for p, t in sorted(pairs)]  # equal text words by falling template words, so that one is taken
    tails: list[int] = []  # the least last template word of a run of each length
    ends: list[int] = []
    before: list[int] = []
    for i, (_, t) in enumerate(ordered):
        k = bisect.bisect_left(tails, t)
        before.append(ends[k - 1] if k else -1)
        tails[k:] = [t] + tails[k + 1 :]
        ends[k:] = [i] + ends[k + 1 :]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append((ordered[i][1], ordered[i][0]))
        i = before[i]
    return out[::-1]


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, gram: int = GRAM, coverage: float = COVERAGE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence labels of every row.

    Returns doc_id, n_words, n_base (places of all phrases), first_word and last_word (the smallest
    and largest start of these, else null), base_labels, labels (with those of verified spans), score
    (1 with a phrase, else the best verified share of a template), n_spans and spans (template
    label, first and last word, share). Null texts have no words, texts of any length are scanned
    whole, equal rows get equal results, and an empty table gives an empty one. Columns are
    taken by name and others ignored, whatever they are called.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    spans = materialise(candidate_spans(text_grams(rows, gram), template_positions(spark, templates, gram), gram), "license-spans")
    grouped = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("template", "low", "high", "first", "last"))).alias("spans"))
    if spans.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS:
        grouped = F.broadcast(grouped)
    prepared = [(label, plain_words(t)) for label, t in templates]

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = plain_words(t)
                places = phrase_places(words, phrases)
                verified = []
                short: dict[int, list] = {}  # spans that do not suffice by themselves
                for s in spans or ():
                    label, template = prepared[s["template"]]
                    share = verify(words, template, s["low"], s["high"])
                    if share >= (1.0 if len(template) < SHORT_WORDS else coverage) or share * len(template) >= ENOUGH_WORDS:
                        verified.append({"label": label, "first": s["first"], "last": s["last"], "share": share})
                    elif len(template) >= SHORT_WORDS:
                        short.setdefault(s["template"], []).append(s)
                for k, some in short.items():
                    label, template = prepared[k]
                    while len(some) > 1:
                        run = chained(words, template, some)
                        if len(run) < min(coverage * len(template), ENOUGH_WORDS):
                            break
                        verified.append({"label": label, "first": run[0][1], "last": run[-1][1], "share": len(run) / len(template)})
                        some = [s for s in some if s["first"] > run[-1][1]]
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(v["label"] for v in verified)})
                starts = [p for p, _ in places]
                best = 1.0 if places else max((v["share"] for v in verified), default=0.0)
                out.append((len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), min(1.0, best), len(verified), verified))
            span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.list_(span)]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans", "spans"]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    joined = rows.join(grouped, "key", "left").select("doc_id", "text", "spans")
    schema = f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, n_spans bigint, spans array<struct<label: string, first: bigint, last: bigint, share: double>>"
    return joined.mapInArrow(check, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")
