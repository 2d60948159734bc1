"""Rows of the edited decision tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.functions.codes import answer_is, normalize_device_id
from weighlens.schemas import YES_DATASET, YES_REVIEW, require


def marked_for_review(decisions: DataFrame) -> DataFrame:
    require(decisions, "revisar_imagenes")
    return decisions.filter(answer_is(F.col("revisar_imagenes"), YES_REVIEW))


def marked_for_dataset(decisions: DataFrame) -> DataFrame:
    """Rows to include; a table without the column includes everything."""
    if "incluir_dataset" not in decisions.columns:
        return decisions
    return decisions.filter(answer_is(F.col("incluir_dataset"), YES_DATASET))


def allowed_devices(device_decisions: DataFrame) -> DataFrame:
    """Distinct normalised ids of the included devices."""
    require(device_decisions, "device_id")
    return (
        marked_for_dataset(device_decisions)
        .select(normalize_device_id(F.col("device_id")).alias("device_id"))
        .filter(F.col("device_id").isNotNull())
        .distinct()
    )
