"""Active model and model accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from weighlens.functions.ranking import first_per_group
from weighlens.schemas import MIN_ACCURACY_ROWS, is_true, require

RECENT_ROWS = 1000


def active_model(
    tx: DataFrame, recent: int = RECENT_ROWS, newest: bool = True, per_deployment: bool = True
) -> DataFrame:
    """Most frequent model among the latest rows: of each deployment, or of the whole frame.

    Rows without a model count in ``total_records`` only; ties go to the lowest model id.
    """
    time = F.col("transaction_start_time")
    order = [time.desc_nulls_last() if newest else time.asc_nulls_last(), F.col("transaction_id")]
    columns = ["deployment_id", "model_id", "transaction_start_time", "transaction_id"]
    rows = tx.select(*[c for c in columns if c in tx.columns])
    if per_deployment:
        keys = ["deployment_id"]
        rows = first_per_group(_recent_days(rows, recent, newest), keys, order, recent, "_n", "transaction_id")
    else:
        keys = []
        rows = rows.orderBy(*order).limit(recent)
    return most_frequent(rows.groupBy(*keys, "model_id").agg(F.count(F.lit(1)).alias("n")), keys)


def most_frequent(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The model with the highest ``n`` per group of ``keys``, its share of all ``n`` there."""
    best = F.max(F.when(F.col("model_id").isNotNull(), F.struct("n", (-F.col("model_id")).alias("neg"))))
    total = F.sum("n")
    return (
        counts.groupBy(*keys)
        .agg(best.alias("_best"), total.alias("total_records"))
        .filter(F.col("_best").isNotNull())
        .select(
            *keys, (-F.col("_best.neg")).alias("model_id"), F.col("_best.n").alias("frequency"), "total_records",
            (F.lit(100.0) * F.col("_best.n") / F.col("total_records")).alias("percentage"),
        )
    )


def _recent_days(rows: DataFrame, recent: int, newest: bool) -> DataFrame:
    """Rows of each deployment's latest days that together hold at least ``recent`` rows.

    Two scans with hash aggregation; ranking alone would sort every row of every task.
    """
    day = F.coalesce(F.to_date("transaction_start_time"), F.lit("0001-01-01" if newest else "9999-12-31").cast("date"))
    rows = rows.withColumn("_day", day)
    per_day = rows.groupBy("deployment_id", "_day").agg(F.count(F.lit(1)).alias("_rows"))
    cut = day_cut(per_day, recent, newest).select("deployment_id", "_edge")
    inside = F.col("_day") >= F.col("_edge") if newest else F.col("_day") <= F.col("_edge")
    return rows.join(cut, "deployment_id").filter(inside).drop("_day", "_edge")


def day_cut(per_day: DataFrame, recent: int, newest: bool = True) -> DataFrame:
    """(deployment_id, _edge, _need) from (deployment_id, _day, _rows): the day on which the latest ``recent`` rows are complete
    (the last one there is, where they are fewer) and how many rows of it belong to them."""
    order = F.col("_day").desc() if newest else F.col("_day").asc()
    before = F.sum("_rows").over(
        W.partitionBy("deployment_id").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    )
    edge = F.min if newest else F.max
    return (
        per_day.withColumn("_before", F.coalesce(before, F.lit(0)))
        .filter(F.col("_before") < recent).groupBy("deployment_id")
        .agg(edge("_day").alias("_edge"), (F.lit(recent) - F.max("_before")).alias("_need"))
    )


def mark_active(counts: DataFrame, active: DataFrame | int | None) -> DataFrame:
    """Add ``_active``: does the row belong to the active model (always, when none is known)?"""
    if active is None or "model_id" not in counts.columns:
        return counts.withColumn("_active", F.lit(True))
    if not isinstance(active, DataFrame):
        return counts.withColumn("_active", F.coalesce(F.col("model_id") == active, F.lit(False)))
    known = active.select("deployment_id", F.col("model_id").alias("_in_use"))
    return counts.join(known, "deployment_id", "left").withColumn(
        "_active",
        F.col("_in_use").isNull() | F.coalesce(F.col("model_id") == F.col("_in_use"), F.lit(False)),
    )


def accuracy_stats(tx: DataFrame, min_rows: int = MIN_ACCURACY_ROWS) -> DataFrame:
    """Model hits per (deployment, product) over rows of trained products."""
    keys = ["deployment_id", "selected_reference_code", "selected_reference_name"]
    require(tx, *keys, "Ok_modelo", "selected_reference_is_trained")
    return (
        tx.filter(is_true(tx, "selected_reference_is_trained"))
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("Ok_modelo").alias("total_transactions"),
            F.sum("Ok_modelo").alias("successful_transactions"),
        )
        .filter(F.col("total_transactions") >= min_rows)
        .withColumn(
            "pct_ok_modelo", F.round(F.col("successful_transactions") / F.col("total_transactions"), 4)
        )
    )


def add_expected_accuracy(tx: DataFrame, stats: DataFrame) -> DataFrame:
    """``pct_ok_modelo_previsto`` of the row's product; a code with two names gives two rows."""
    expected = stats.select(
        "deployment_id", "selected_reference_code", F.col("pct_ok_modelo").alias("pct_ok_modelo_previsto")
    )
    return tx.join(expected, ["deployment_id", "selected_reference_code"], "left")
