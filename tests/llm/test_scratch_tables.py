"""What corpus operators leave on the shared disk."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from terrafield.llm import alignment, lm_score
from terrafield.llm.common import materialise


def _files(df):
    return [f.removeprefix("file:").replace("///", "/") for f in df.inputFiles()]


def test_lm_scratch_is_packed_and_dropped(spark, make_docs, monkeypatch):
    """op3: texts are written as zstd, and sums of earlier passes go once later ones are written."""
    rows = make_docs([(i, f"word{i % 7} other{i % 11} and word{i} " * 20) for i in range(60)])
    made, dropped = {}, []
    write, drop = lm_score.materialise, lm_score.drop_scratch

    def written(df, name):
        out = write(df, name)
        made.setdefault(name, []).append(_files(out))
        return out

    monkeypatch.setattr(lm_score, "materialise", written)
    monkeypatch.setattr(lm_score, "drop_scratch", lambda df: (dropped.append(_files(df)), drop(df)))
    monkeypatch.setattr(lm_score, "BUCKET_LETTERS", 1000)
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    out = lm_score.lm_scores(rows, part_bytes=400, pass_parts=2, chunk_letters=700)
    assert out.count() == 60 and spark.conf.get("spark.sql.parquet.compression.codec") == before
    assert all(pq.ParquetFile(f).metadata.row_group(0).column(4).compression == "ZSTD" for f in made["lm-texts"][0])
    assert len(made["lm-sums"]) > 1 and sorted(map(tuple, dropped)) == sorted(map(tuple, made["lm-scored"] + made["lm-sums"][:-1]))


def test_alignment_packs_two_signs_a_byte(spark):
    """op11: numbers and groups of a stretch read back whole from half their length."""
    packed = ["0 3 3 1 5 1 1234567 12345,2345,34521|12345,234;7|8", "0 1 1 1 1 1 7 5|5", "1 0 0 0 0 0 0 ", "0 0 0 0 0 0 0 0|0"]
    found = spark.createDataFrame([(i, p) for i, p in enumerate(packed)], "i int, p string").select("i", alignment._halved(F.col("p")).alias("p")).collect()
    for r in found:
        *numbers, groups = packed[r.i].split(" ", len(alignment.SUMS) + 1)
        assert alignment._unpacked(bytes(r.p)) == (list(map(int, numbers)), groups) and len(r.p) == (len(packed[r.i]) + 1) // 2


def test_shuffles_of_scratch_tables_end_with_the_write(spark):
    """op3, op11: no shuffle file of a written table is left, whether or not garbage was collected."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    out = materialise(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    assert tracker.shuffleStatuses().size() <= before and out.count() == 7
