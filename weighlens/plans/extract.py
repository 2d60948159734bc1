"""The labelled extract that reports and later jobs read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from weighlens.operators.images import add_image_info
from weighlens.operators.labelling import label_transactions
from weighlens.schemas import DAYS_BACK
from weighlens.sources.transactions import scan_with_model_fallback


def transaction_extract(raw: DataFrame, folders: DataFrame) -> DataFrame:
    """Raw transactions, labelled and with their image folders."""
    return add_image_info(label_transactions(raw), folders)


def deployment_extract(
    raw: DataFrame, deployments: DataFrame, folders: DataFrame, deployment_id: int, as_of: datetime,
    days_back: int = DAYS_BACK, model_id: int | None = None,
) -> DataFrame:
    """The extract of one deployment's last days."""
    return transaction_extract(
        scan_with_model_fallback(raw, deployments, deployment_id, as_of, days_back, model_id), folders
    )


def write_extract(extract: DataFrame, folder: str) -> None:
    """One folder per deployment, so that a deployment's report reads only its own files.

    Rebalancing keeps the files few and splits the partitions of large deployments.
    """
    extract.hint("rebalance", "deployment_id").write.partitionBy("deployment_id").parquet(folder)
