"""Right / wrong / no-result labels of one transaction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weighlens.schemas import CLIENT_METRICS, MANUAL_METRIC


def is_client(metric: Column) -> Column:
    return F.coalesce(metric.isin(*CLIENT_METRICS), F.lit(False))


def is_manual(metric: Column) -> Column:
    return F.coalesce(metric == MANUAL_METRIC, F.lit(False))


def metric_class(metric: Column) -> Column:
    return (
        F.when(is_client(metric), F.lit("client"))
        .when(is_manual(metric), F.lit("manual"))
        .otherwise(F.lit("other"))
    )


def result_class(confidence: Column, topk: Column) -> Column:
    """Low confidence comes first; an unknown list position counts as right."""
    return (
        F.when(confidence == "LOW", F.lit("No_result"))
        .when(topk == -1, F.lit("Error"))
        .otherwise(F.lit("Ok"))
    )


def model_result(
    metric: Column, trained: Column, untrained: Column, result_index: Column, selected_index: Column
) -> Column:
    """The model's own verdict; '' for manual rows and where training is unknown."""
    return (
        F.when(~is_client(metric), F.lit(""))
        .when(untrained, F.lit("NOT_TRAINED"))
        .when(trained & (result_index == selected_index), F.lit("SUCCESS"))
        .when(trained, F.lit("FAIL"))
        .otherwise(F.lit(""))
    )


def topk_class(topk: Column) -> Column:
    return (
        F.when(topk.isNull() | (topk == -1), F.lit("NO_CLASIFICADO"))
        .when(topk == 0, F.lit("top_k_0"))
        .when(topk.between(1, 4), F.lit("top_k_medio"))
        .otherwise(F.lit("top_k_alto"))
    )


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")
