"""Registering a finished set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weighlens.operators.datasets import dataset_summary, registry_upsert
from weighlens.schemas import REGISTRY
from weighlens.sinks.commits import CommittedTable
from weighlens.sinks.tables import write_report


def register_dataset(
    registry: DataFrame, files: DataFrame, sources: list[DataFrame], dataset: str, created_at: str,
    deployment_id: str, trained_model: str, description: str, s3_path: str, folder: str, replace: bool = True,
) -> dict[str, str]:
    """New registry, the set's summary and its totals in a fresh folder; the caller swaps folders.

    ``created_at`` is dd/MM/yyyy.  The registry being read is never overwritten in place.
    """
    values = {
        "dataset_name": dataset, "created_at": created_at, "deployment_id": deployment_id,
        "trained_model": trained_model, "description": description, "s3_path": s3_path,
    }
    entry = registry.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
    totals = files.agg(F.count(F.lit(1)).alias("files"), F.countDistinct("class", "label_id").alias("folders"))
    return write_report(
        {"registry": registry_upsert(registry, entry, replace), "summary": dataset_summary(files, sources), "totals": totals},
        folder,
    )


def registry_table(spark: SparkSession, folder: str) -> CommittedTable:
    """The registry as a table of versions."""
    return CommittedTable(spark, folder, ", ".join(f"{c} string" for c in REGISTRY))


def commit_dataset(
    spark: SparkSession, folder: str, run_id: str, dataset: str, created_at: str, deployment_id: str, trained_model: str,
    description: str, s3_path: str, replace: bool = True, based_on: int | None = None,
) -> int:
    """Enter a finished set into the registry at ``folder`` and return the registry's new version.

    The version the entry was made from is checked at the end: of two runs that start from the same one, the second gets
    Conflict and can start again.  A run that is in the registry already changes nothing; one that stops half-way leaves the old
    version.  ``based_on`` is the version the caller has seen (default: the newest).
    """
    table = registry_table(spark, folder)
    now = table.snapshot()
    based_on = now.version if based_on is None else based_on
    values = (dataset, created_at, deployment_id, trained_model, description, s3_path)
    entry = spark.range(1).select(*[F.lit(v).alias(c) for c, v in zip(REGISTRY, values)])
    return table.replace(registry_upsert(table.read(based_on), entry, replace), run_id, based_on)
