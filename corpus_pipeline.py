"""From raw documents to shards: classify, drop near copies and leaks, mix the sources, shard.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns a DataFrame.  ``run`` writes
every stage as Parquet in the shared folder and goes on from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weighlens.llm.common import staged, table
from weighlens.llm.decontaminate import drop_leaks
from weighlens.llm.histogram_shards import shard_by_bytes
from weighlens.llm.poisson_mix import mix_sources
from weighlens.llm.quality_eb import add_quality
from weighlens.llm.signature_join import drop_near_copies

ROW = "__row"


def _beside(docs: DataFrame, *columns: str) -> DataFrame:
    """What an operator needs, and the whole row beside it: what the operator adds cannot replace a column of ``docs``."""
    return docs.select(*columns, F.struct(*docs.columns).alias(ROW))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    rated = add_quality(_beside(docs, "doc_id", "text", "source", "lang"), table(spark, sf_dir, "labels"), carry=[ROW])
    return rated.filter("keep").select(f"{ROW}.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; rows without an id or words all stay."""
    return drop_near_copies(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target weights."""
    return mix_sources(_beside(docs, "doc_id", "text", "source")).select(f"{ROW}.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard_by_bytes(docs, shards=16)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_leaks),
    ("mixing sources to target weights", mixed_sources),
    ("sharding", sharded),
]

#: The first stage trains a classifier, which SQL cannot express; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
