"""Plans for bulk image copies from transaction lists and product lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.functions.paths import image_extension, safe_name, target_folder
from weighlens.operators.images import extract_image_urls, first_n_per_folder
from weighlens.schemas import IMAGES_FALLBACK, shared_scope
from weighlens.sources.lookups import lookup_folder_urls


def folder_download_plan(
    requests: DataFrame, transactions: DataFrame, folders: DataFrame, files: DataFrame, base: str,
    max_images: int | None = None, work_dir: str | None = None,
) -> DataFrame:
    """First images of every requested transaction and the folder its request row builds.

    The first column of ``requests`` is the transaction id, all others name the target folder.
    """
    key, *parts = requests.columns
    wanted = requests.select(
        F.col(key).cast("string").alias("transaction_id"),
        F.concat_ws("/", F.lit(base), F.when(
            target_folder(F.col(key), [F.col(p) for p in parts]) != "",
            target_folder(F.col(key), [F.col(p) for p in parts]),
        )).alias("target_folder"),
    )
    known = lookup_folder_urls(wanted, transactions, folders)
    images = first_n_per_folder(known, files, max_images, work_dir=work_dir)
    return wanted.join(images, "transaction_id").withColumn(
        "local_path", F.concat_ws("/", "target_folder", "filename")
    )


def reference_image_plan(
    untrained: DataFrame, tx: DataFrame, output: str, images: int = IMAGES_FALLBACK
) -> DataFrame:
    """First image URLs of every untrained product (of its deployment, where both sides name one) with their target files."""
    scope = shared_scope(untrained, tx)
    untrained = untrained.select(*scope, "reference_code", "reference_name")
    tx = tx if scope else tx.drop("deployment_id")
    urls = extract_image_urls(tx, images, untrained)
    products = untrained
    folder = F.concat_ws(
        "/", F.lit(output), F.concat(F.col("reference_code"), F.lit("_"), safe_name(F.col("reference_name")))
    )
    return urls.join(products, [*scope, "reference_code"]).select(
        *scope, "reference_code", "reference_name", "url", "image_no", folder.alias("directory"),
        F.concat(
            F.lit("image_"), F.lpad((F.col("image_no") - 1).cast("string"), 4, "0"), image_extension(F.col("url"))
        ).alias("filename"),
    )
