"""Per-device metrics and activation status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.functions.codes import normalize_yes_no, strip_decimal_suffix
from weighlens.functions.quality import is_client, is_manual
from weighlens.operators.models import mark_active
from weighlens.schemas import column_or, is_true, percent, require


def device_sums(tx: DataFrame, *more: str) -> DataFrame:
    """Sums per device, deployment, model, name and the columns ``more``: sums of them can be added up further."""
    require(tx, "device_id", "transaction_metric", "Ok", "Ok_modelo")
    client = is_client(F.col("transaction_metric"))
    trained = is_true(tx, "selected_reference_is_trained")
    name = column_or(tx, "device_name", F.col("device_id").cast("string"))
    # the name is a key, so that the fact rows meet fixed-width buffers only (hash aggregation)
    keys = ["device_id", *[c for c in ("deployment_id", "model_id") if c in tx.columns], name.alias("_name")]
    return tx.groupBy(*keys, *more).agg(
        F.count_if(client).alias("_client"),
        F.count_if(is_manual(F.col("transaction_metric"))).alias("_manual"),
        F.count_if(client & (F.col("Ok") == 1)).alias("_ok"),
        F.count_if(client & trained).alias("_trained"),
        F.count_if(client & trained & (F.col("Ok_modelo") == 1)).alias("_ok_modelo"),
        F.min("transaction_start_time").alias("_start"),
    )


def device_report(sums: DataFrame, active: DataFrame | int | None = None) -> DataFrame:
    """The device metrics from sums of ``device_sums``."""
    on = F.col("_active")
    return (
        mark_active(sums, active).groupBy("device_id")
        .agg(
            F.min_by("_name", F.struct(F.col("_start").isNull(), "_start", "_name")).alias("device_name"),
            F.sum("_client").alias("num_cliente"),
            F.sum("_manual").alias("num_manual"),
            percent(F.sum(F.when(on, F.col("_ok"))), F.sum(F.when(on, F.col("_client"))), 1).alias("pct_ok_sistema"),
            percent(F.sum(F.when(on, F.col("_ok_modelo"))), F.sum(F.when(on, F.col("_trained"))), 1).alias("pct_ok_modelo"),
            F.min("_start").alias("first_transaction_date"),
        )
        .select(
            "device_id", "device_name", "num_cliente", "num_manual",
            "pct_ok_sistema", "pct_ok_modelo", F.lit("no").alias("revisar_imagenes"), "first_transaction_date",
        )
    )


def device_metrics(tx: DataFrame, active: DataFrame | int | None = None) -> DataFrame:
    """Client and manual counts, both percentages (active model only), first name and first time."""
    require(tx, "device_id", "transaction_metric", "Ok", "Ok_modelo")
    return device_report(device_sums(tx.filter(F.col("device_id").isNotNull())), active)


def device_decision_columns(devices: DataFrame, extra_images: int = 0) -> DataFrame:
    """Device report rows with the columns a person edits; sorted when written."""
    review = column_or(devices, "revisar_imagenes", F.lit("no"))
    first = F.to_date("first_transaction_date") if "first_transaction_date" in devices.columns else F.lit(None).cast("date")
    return devices.withColumns({
        "revisar_imagenes": normalize_yes_no(review),
        "incluir_dataset": F.lit("si"),
        "num_imagenes_dataset_adicionales": F.lit(extra_images),
        "first_transaction_date": first,
    })


# Fixed order in which a time column is looked for.
TIME_COLUMNS = ("transaction_start_time", "transaction_end_time", "timestamp", "fecha", "date", "@timestamp")


def _with_activation(tx: DataFrame, activations: DataFrame) -> DataFrame:
    known = activations.select(
        F.col("device_id").alias("_listed"), F.col("activated_at").alias("_activated")
    )
    return tx.withColumn("_device", strip_decimal_suffix(F.col("device_id"))).join(
        known, F.col("_device") == F.col("_listed"), "left"
    )


def add_device_status(tx: DataFrame, activations: DataFrame) -> DataFrame:
    """'Encendido' from the device's activation on, else 'Silencioso'.

    A listed device without a date counts from one month before the earliest row.
    """
    return _add_activation(tx, activations, status=True)


def add_activation_label(tx: DataFrame, activations: DataFrame) -> DataFrame:
    """Activation day of the row's device as text."""
    return _add_activation(tx, activations, label=True)


def add_activation_columns(tx: DataFrame, activations: DataFrame) -> DataFrame:
    """Status and activation day from one join."""
    return _add_activation(tx, activations, status=True, label=True)


def _add_activation(tx: DataFrame, activations: DataFrame, status: bool = False, label: bool = False) -> DataFrame:
    known = "device_id" in tx.columns
    time = next((c for c in TIME_COLUMNS if c in tx.columns), None)
    columns = {}
    if status and known and time is not None:
        moment = F.col(time).try_cast("timestamp_ntz")
        default = tx.agg(F.min(moment) - F.expr("INTERVAL 1 MONTH")).scalar()
        on = F.col("_listed").isNotNull() & (moment >= F.coalesce(F.col("_activated"), default))
        columns["estado_dispositivo"] = F.when(on, F.lit("Encendido")).otherwise(F.lit("Silencioso"))
    elif status:
        columns["estado_dispositivo"] = F.lit("Silencioso")
    if label:
        columns["fecha_encendido"] = (
            F.when(F.col("_device").isNull(), F.lit(""))
            .when(F.col("_listed").isNull(), F.lit("No en archivo"))
            .when(F.col("_activated").isNull(), F.lit("Sin fecha"))
            .otherwise(F.to_date("_activated").cast("string"))
        ) if known else F.lit("")
    if not known:
        return tx.withColumns(columns)
    return _with_activation(tx, activations).withColumns(columns).drop("_device", "_listed", "_activated")
