"""From raw documents to sharded training documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.llm import decontamination, mixing, nearcopies, sharding, toxicity
from mentionlake.llm.common import table, word_count
from mentionlake.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be toxic go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.classify(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that five-word shingles connect at a similarity of 0.8 or more, the one with the least id stays."""
    return nearcopies.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more occur in windows of the benchmark go."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.contaminated()).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the curriculum takes them (up to three times).

    They are not sorted by position: the columns of documents have no place for it, and the next stage gives each
    row a slot of its own.
    """
    mixed = mixing.curriculum(docs, word_count(F.col("text")), cut=False)
    return mixed.select(*docs.columns, F.explode("positions").alias("__position")).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sixteen shards by document id; the copies of a document are in one shard, each with a slot of its own."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("curriculum_mixing", mix),
    ("rendezvous_sharding", shard),
]

#: SQL cannot express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
