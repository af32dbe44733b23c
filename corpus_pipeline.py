"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Toxic documents go, one document of each near-duplicate group stays, documents that hold a
benchmark passage go, sources are mixed to their target weights (a document's row comes as
often as the mix takes it), and the mix is stored in compacted shards under a versioned
manifest. The last stage returns the rows as read back from the committed shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meteoloom.llm import decontam, mixing, sharding, simhash, toxicity
from meteoloom.llm.common import discard, materialize
from meteoloom.sources.working import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; its labels are those of the folder."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the one with the smallest doc_id, nulls last."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the folder's benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out as their source's target weight asks; repeated rows count each."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as the committed shards hold it: doc_id, source, lang, n_bytes, text_sha256."""
    return sharding.shard_digest(docs, scratch(spark, "shards"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The stages are learnt or hashed, which SQL can't express. Tests hold near-dedup, decontamination, mixing and
#: sharding against plain loops in Python, and toxicity against labels that it didn't learn from.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
