"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weighlens.llm import (
    binary_codes, decontaminate, fill_in_middle, histogram_shards, poisson_mix, quality_eb, run_length_repair, secret_ledger, signature_join,
    super_kmers, token_files, toxic_crf, warc_index,
)
from weighlens.llm.common import table
from weighlens.llm.oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), tokenizer_file(), tokens=False)


@query
def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histogram_shards.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op3_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc_index.archive_round_trip(table(spark, sf_dir, "pages"), payloads=False, least_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sums of doubles may differ in their last bits by partitioning: what is shown is rounded
    return poisson_mix.mix_sources(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.BlobLedger(spark).scan(table(spark, sf_dir, "documents"))
    counts = {f"n_{r.kind}": secret_ledger.count_of(F.col("findings"), r.kind) for r in secret_ledger.BASE_RULES}
    return found.withColumns(counts | {"spans": secret_ledger.span_text(F.col("findings"))}).select(
        "doc_id", *counts, F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans"
    )


@query
def op8_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = toxic_crf.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxic_crf.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


@query
def op9_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.join_near_copies(table(spark, sf_dir, "documents"))


@query
def op10_quality_eb(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_eb.add_quality(docs, labels, carry=["doc_id", "source", "lang"])
    return scored.select("doc_id", "source", "lang", "evidence", "host_rate", "path_rate", "quality", "keep")


def _sha256(text: str):
    return F.sha2(F.col(text).cast("binary"), 256).alias(f"{text}_sha256")


@query
def op11_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_length_repair.repair_conversations(table(spark, sf_dir, "conversations"))


@query
def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_kmers.drop_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", _sha256("kept"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fill_in_middle.restore(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return examples.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output"), _sha256("restored"))
