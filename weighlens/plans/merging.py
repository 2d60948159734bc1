"""Several sets become one: winners of equal names, their earlier log rows, the new set's log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.operators.datasets import merge_datasets, merge_log, merge_log_enrichment
from weighlens.sinks.logs import read_dataset_log, write_dataset_log


def merge_sets(files: DataFrame, log_folder: str, target: str) -> DataFrame:
    """Append the merged set's rows to the log in ``log_folder``; returns the plan of copies.

    ``files`` holds dataset, set_order, class, label_id and filename.  A target that the log knows already stops the job.
    The plan names, for each file of the new set, the set it is copied from.
    """
    log = read_dataset_log(files.sparkSession, log_folder)
    merged = merge_datasets(files)
    keys = ["class", "label_id", "filename"]
    carried = merge_log_enrichment(merged, log).drop("copies", "dataset_original")
    rows = merge_log(merged, target, log).withColumns({"class": F.col("clase_name"), "label_id": F.col("label_id").cast("string")})
    write_dataset_log(rows.join(carried, keys, "left"), log_folder)
    return merged.select(*keys, F.col("dataset_original").alias("from_dataset"), F.lit(target).alias("to_dataset"))
