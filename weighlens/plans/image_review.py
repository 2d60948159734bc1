"""Manifest of images to look at for marked products and devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighlens.operators.images import resolve_image_keys
from weighlens.operators.review import (
    products_to_review, sample_devices_for_review, sample_for_review, similar_sub_products,
)
from weighlens.functions.paths import image_extension
from weighlens.schemas import IMAGES_PER_REVIEW, SEED
from weighlens.sources.decisions import marked_for_review
from weighlens.sources.lookups import load_review_transactions


_SAMPLED = (
    "reference_name", "product_name", "product_type", "transaction_id", "transaction_start_time", "device_id", "device_name",
    "selected_reference_name", "result_label_name", "confidence", "Ok", "Ok_modelo", "image_link",
)


def _sampled(sample: DataFrame, folder: Column) -> DataFrame:
    return sample.withColumn("device_id", F.col("device_id").cast("string")).select(*_SAMPLED, folder.alias("_folder_to"))


def _log_rows(sample: DataFrame, bucket: str, files: DataFrame | None) -> DataFrame:
    rows = resolve_image_keys(sample, files)
    key = F.col("s3_key")
    found = key.isNotNull()
    return rows.select(
        "reference_name", "product_name", "product_type", "transaction_id", "transaction_start_time",
        "device_id", "device_name", "selected_reference_name", "result_label_name",
        "confidence", "Ok", "Ok_modelo",
        F.coalesce(key, F.lit("")).alias("s3_key"),
        F.when(found, F.concat(F.lit(f"s3://{bucket}/"), key)).otherwise(F.lit("")).alias("s3_url"),
        F.when(found, F.concat(
            "_folder_to", F.lit("/"), F.col("transaction_id"), image_extension(key, None)
        )).otherwise(F.lit("")).alias("local_path"),
        F.when(found, F.lit("planned")).otherwise(F.lit("failed")).alias("download_status"),
        F.when(found, F.lit("")).otherwise(F.lit("Imagen no encontrada en S3")).alias("error_reason"),
    )


def review_images(
    decisions: DataFrame, devices: DataFrame, cached: DataFrame, files: DataFrame | None = None,
    images: int = IMAGES_PER_REVIEW, mode: str = "ambas", classes_too: bool = True,
    bucket: str = "images", target: str = "revisar_imagenes", seed: int = SEED,
) -> DataFrame:
    """17-column review log: product rows first sampled per entry, device rows per device."""
    tx = load_review_transactions(cached)
    marked = marked_for_review(decisions)
    subs = similar_sub_products(tx, decisions) if classes_too else None
    entries = products_to_review(marked, subs, classes_too)
    by_product = sample_for_review(entries, tx, images, mode, seed)
    main = F.col("product_type") == "clase_principal"
    folder = F.when(main, F.concat_ws("/", F.lit(target), F.lit("productos"), "reference_name", "product_name")).otherwise(
        F.concat_ws(
            "/", F.lit(target), F.lit("productos"), F.col("reference_name"),
            F.concat(F.lit("Reference_similar_"), "parent_similar_name"),
            F.concat(F.coalesce("label_id", F.lit("unknown")), F.lit("_"), F.coalesce("product_name", F.lit(""))),
        )
    )
    by_device = sample_devices_for_review(devices, tx, images, mode, seed).withColumn("reference_name", F.lit("unknown"))
    device_folder = F.concat_ws("/", F.lit(target), F.lit("devices"), F.col("device_id").cast("string"))
    # one look at the listing for both kinds
    return _log_rows(_sampled(by_product, folder).unionByName(_sampled(by_device, device_folder)), bucket, files)
