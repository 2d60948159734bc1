"""A deployment's quality report from its raw transactions, as one job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from weighlens.plans.extract import deployment_extract, transaction_extract, write_extract
from weighlens.plans.quality import quality_report
from weighlens.schemas import DAYS_BACK, MIN_CLIENT_ROWS
from weighlens.sources.catalogue import resolve_model, scan_labels, scan_model_classes, scan_references
from weighlens.sources.transactions import scan_fleet


class UnknownModel(ValueError):
    """The deployment is not known, or has no model and none was given."""


def deployment_report(
    raw: DataFrame, deployments: DataFrame, models: DataFrame, references: DataFrame, labels: DataFrame, folders: DataFrame,
    deployment_id: int, as_of: datetime, folder: str, days_back: int = DAYS_BACK, model_id: int | None = None,
    min_client: int = MIN_CLIENT_ROWS, csv_copy: bool = False,
) -> dict[str, str]:
    """Resolve the model, extract and label its rows with their images, write the extract and the report tables.

    The extract is written once below ``folder`` and read back for the report.  Returns the tables' paths.
    """
    spark = raw.sparkSession
    request = spark.createDataFrame([(deployment_id, model_id)], "deployment_id int, model_id int")
    resolved = resolve_model(deployments, request).first()
    if resolved["status"] != "ok":
        raise UnknownModel(f"deployment {deployment_id}: {resolved['status']}")
    path = f"{folder}/extract"
    # without a given model the deployment's own one is filtered for if it has rows, else all rows are taken
    deployment_extract(raw, deployments, folders, deployment_id, as_of, days_back, resolved["model_id"]).hint("rebalance").write.parquet(path)
    classes = scan_model_classes(models, resolved["model_id"]).filter(F.col("json_ok"))
    return {"extract": path} | quality_report(
        spark.read.parquet(path), scan_references(references, deployment_id), scan_labels(labels), classes, folder, min_client, csv_copy
    )


def fleet_report(
    raw: DataFrame, deployments: DataFrame, models: DataFrame, references: DataFrame, labels: DataFrame, folders: DataFrame,
    as_of: datetime, folder: str, days_back: int = DAYS_BACK, min_client: int = MIN_CLIENT_ROWS, csv_copy: bool = False,
) -> dict[str, str]:
    """The report of all deployments that have a model, in one pass instead of one run for each.

    Every deployment's rows are those a run of its own would take: of its model, if the model has rows in the time window,
    else all of them.  Products meet the classes of their own deployment's model.  Deployments without a model are written
    to the table ``skipped`` instead of stopping the others.  Returns the tables' paths.
    """
    spark = raw.sparkSession
    own = deployments.groupBy("deployment_id").agg(F.max("model_id").alias("model_id"))
    known = own.filter(F.col("model_id").isNotNull())
    written = {"extract": f"{folder}/extract", "skipped": f"{folder}/skipped"}
    own.filter(F.col("model_id").isNull()).write.parquet(written["skipped"])
    write_extract(transaction_extract(scan_fleet(raw, known, as_of, days_back), folders), written["extract"])
    extract = spark.read.parquet(written["extract"])
    classes = scan_model_classes(models.join(known, "model_id", "left_semi")).filter(F.col("json_ok"))
    products = references.join(known.select("deployment_id"), "deployment_id", "left_semi")
    return written | quality_report(extract, products, scan_labels(labels), classes, folder, min_client, csv_copy, known)
