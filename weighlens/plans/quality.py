"""Quality report of a deployment or of a whole fleet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.operators.devices import device_decision_columns, device_metrics
from weighlens.operators.labelling import client_rows
from weighlens.operators.models import active_model
from weighlens.operators.references import reference_metrics, references_with_labels, references_with_model
from weighlens.operators.reports import (
    consistency_report, consolidated_references, executive_summary, model_class_table, summary_stats,
)
from weighlens.schemas import MANUAL_METRIC, MIN_APPEARANCES, MIN_CLIENT_ROWS
from weighlens.sinks.tables import write_report


def complete_analysis(
    tx: DataFrame, references: DataFrame, labels: DataFrame, classes: DataFrame,
    active: DataFrame | int | None = None, min_client: int = MIN_APPEARANCES, deployments: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All analysis tables as lazy DataFrames over one labelled transaction frame.

    For several deployments at once give ``deployments`` (deployment_id, model_id): products then meet the classes of their
    own deployment's model.  Without it ``classes`` must be those of one model.
    """
    active = active_model(tx) if active is None else active
    known = references_with_model(references_with_labels(references, labels), classes, deployments=deployments)
    analysed = reference_metrics(tx, known, active)
    return {
        "complete_analysis": analysed,
        "filtered_references": analysed.filter(F.col("num_cliente") >= min_client),
        "client_transactions": client_rows(tx),
        "manual_transactions": tx.filter(F.col("transaction_metric") == MANUAL_METRIC),
        "summary_stats": summary_stats(analysed),
        "devices_analysis": device_metrics(tx, active),
    }


def quality_report(
    tx: DataFrame, references: DataFrame, labels: DataFrame, classes: DataFrame, folder: str,
    min_client: int = MIN_CLIENT_ROWS, csv_copy: bool = False, deployments: DataFrame | None = None,
) -> dict[str, str]:
    """Write the report tables into one run folder; with ``deployments`` (deployment_id, model_id) those of a whole fleet,
    whose product table then has ``deployment_id``.

    Products, devices and active models are written first and read back for the tables that
    are derived from them, so the transactions are scanned once per base table and a lost
    executor costs a re-read, not a re-computation.
    """
    spark = tx.sparkSession
    base = write_report({"active_model": active_model(tx)}, folder)
    active = spark.read.parquet(base["active_model"])
    analysis = complete_analysis(tx, references, labels, classes, active, deployments=deployments)
    base |= write_report(
        {
            "products": consolidated_references(references, analysis["complete_analysis"], min_client, deployments is not None),
            "devices": device_decision_columns(analysis["devices_analysis"]),
        },
        folder,
        sort={"products": [F.col("num_cliente").desc()], "devices": [F.col("num_cliente").desc()]},
        csv_copy=csv_copy,
    )
    products, devices = spark.read.parquet(base["products"]), spark.read.parquet(base["devices"])
    base |= write_report({"summary_stats": summary_stats(products)}, folder)
    stats = spark.read.parquet(base["summary_stats"])
    return base | write_report(
        {
            "labels": labels,
            "model_classes": model_class_table(classes, labels),
            "summary": executive_summary(tx, references, labels, active, stats, devices),
            "consistency": consistency_report(stats, devices),
        },
        folder, csv_copy=csv_copy,
    )
