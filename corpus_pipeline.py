"""The corpus pipeline: toxicity, near-duplicates, decontamination, then SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again
as the next one's docs. Texts of any length are judged and encoded whole, repeated rows each; stages take the
columns of documents by name and hand all columns on, whatever others there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrafield.llm import decontamination, sentencepiece_nbest, simhash, toxicity
from terrafield.llm.common import materialise, read_table
from terrafield.llm.tokens import default_path

#: Workers live on from stage to stage beside a heap that the stages before have filled, so the last one caches less.
CACHE_ENTRIES = 200_000


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores under 0.5 stay, null and empty texts among them; an empty table stays empty, and without labels all stay."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one of least id; null and empty texts are one component, rows without an id stay."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay, null and empty texts among them; an empty benchmark removes none."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a document: ids of the best segmentation, and scores and digests of the N best; null and empty texts have no pieces."""
    return sentencepiece_nbest.encode(docs, default_path("piece_bpe_32k.model"), ids="best", cache_entries=CACHE_ENTRIES)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: SQL can express neither the learned scores nor the fingerprints' hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
