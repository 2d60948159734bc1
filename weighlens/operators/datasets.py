"""Life of finished sets: folders, merging, summaries, versions and the registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from weighlens.functions.paths import base_name, filename_transaction_id, has_extension, parent_folder
from weighlens.functions.times import time_text
from weighlens.schemas import IMAGE_EXTENSIONS, REGISTRY, column_or, require
from weighlens.sources.log_buckets import CARRIED, BucketedLog, newest_row


def folder_structure(files: DataFrame, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> DataFrame:
    """Folders with images and no direct sub-folder with images, with their image counts.

    ``files`` holds paths relative to the folder that contains the sets.
    """
    counted = (
        files.filter(has_extension(F.col("path"), extensions))
        .groupBy(parent_folder(F.col("path")).alias("folder"))
        .agg(F.count(F.lit(1)).alias("images"))
    )
    # each folder with images also tells its parent that it has such a sub-folder
    signs = counted.select(F.inline(F.array(
        F.struct("folder", F.col("images"), F.lit(0).alias("child")),
        F.struct(parent_folder(F.col("folder")).alias("folder"), F.lit(0).cast("bigint").alias("images"), F.lit(1).alias("child")),
    )))
    leaves = (
        signs.groupBy("folder").agg(F.sum("images").alias("images_count"), F.max("child").alias("_child"))
        .filter((F.col("images_count") > 0) & (F.col("_child") == 0))
    )
    parts = F.split("folder", "/")
    inner = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return leaves.select(
        F.get(parts, F.lit(0)).alias("dataset_name"),
        F.when(F.size(inner) >= 2, F.get(parts, F.size(parts) - 2)).otherwise(F.lit("")).alias("product"),
        F.get(parts, F.size(parts) - 1).alias("label_id"),
        F.when(F.size(inner) > 0, F.array_join(inner, "/")).otherwise(F.lit(".")).alias("folder_rel"),
        "images_count",
    )


def latest_per_transaction(sources: list[DataFrame]) -> DataFrame:
    """Newest device and start time per transaction over all tables that carry the three columns."""
    needed = ["transaction_id", "device_id", "transaction_start_time"]
    usable = [
        s.select(
            F.col("transaction_id").cast("string").alias("transaction_id"),
            F.col("device_id").cast("string").alias("device_id"),
            F.col("transaction_start_time").cast("string").alias("_text"),
        ) for s in sources if set(needed) <= set(s.columns)
    ]
    rows = reduce(DataFrame.unionByName, usable).withColumn("_at", F.col("_text").try_cast("timestamp_ntz"))
    newest = F.max_by(
        F.struct("device_id", F.col("_at").alias("transaction_start_time")),
        F.struct(F.col("_at").isNotNull(), "_at", "device_id"),
    )
    return (
        rows.filter(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id").agg(newest.alias("_n")).select("transaction_id", "_n.*")
    )


def dataset_summary(files: DataFrame, sources: list[DataFrame | BucketedLog]) -> DataFrame:
    """The set's images with device and time of the transaction in their file name.

    Bucketed logs among the sources are joined where they lie, without a shuffle of theirs.
    """
    images = files.filter(has_extension(F.col("filename"))).select(
        filename_transaction_id(F.col("filename")).alias("transaction_id"),
        F.col("class").alias("clase"), "label_id", "filename",
        F.concat_ws("/", "class", "label_id").alias("file_name_path"),
    )
    logs = [s for s in sources if isinstance(s, BucketedLog)]
    tables = [s for s in sources if not isinstance(s, BucketedLog)]
    if logs:
        known = _from_logs(images, logs, tables)
    else:
        known = images.join(latest_per_transaction(tables), "transaction_id", "left")
    return known.select(
        "transaction_id", "device_id",
        time_text(F.col("transaction_start_time")).alias("transaction_start_time"),
        F.to_date("transaction_start_time").alias("Date"),
        "clase", "label_id", "filename", "file_name_path",
    )


def _from_logs(images: DataFrame, logs: list[BucketedLog], tables: list[DataFrame]) -> DataFrame:
    """Images with the newest device and time over all sources."""
    found = []
    for n, log in enumerate(logs):
        images = log.newest_of(images).withColumnRenamed("_logged", f"_log{n}")
        found.append(F.col(f"_log{n}"))
    if tables:
        rows = latest_per_transaction(tables)
        rows = rows.select("transaction_id", newest_row(F.col("device_id"), F.col("transaction_start_time")).alias("_other"))
        images = images.join(rows, "transaction_id", "left")
        found.append(F.col("_other"))
    images = images.withColumn("_newest", F.greatest(*found) if len(found) > 1 else found[0])
    return images.withColumns({"device_id": F.col("_newest.device_id"), "transaction_start_time": F.col("_newest.at")})


def merge_datasets(files: DataFrame) -> DataFrame:
    """Union of several sets; of the same class, label and file name the later set wins.

    ``files`` holds dataset, set_order, class, label_id, filename; ``copies`` counts the
    files that met in one target.
    """
    require(files, "dataset", "set_order", "class", "label_id", "filename")
    return (
        files.groupBy("class", "label_id", "filename")
        .agg(
            F.max_by("dataset", F.struct("set_order", "dataset")).alias("dataset_original"),
            F.count(F.lit(1)).alias("copies"),
        )
    )


def merge_log(merged: DataFrame, target: str, existing: DataFrame) -> DataFrame:
    """Log rows of a merge; the target set must be new (an existing one raises when run)."""
    clash = existing.filter(F.col("dataset_folder") == target).agg(F.count(F.lit(1)) > 0).scalar()
    folder = F.concat_ws("/", "class", "label_id")
    return merged.select(
        F.when(clash, F.raise_error(F.lit(f"dataset {target} already exists"))).otherwise(F.lit(target)).alias("dataset_folder"),
        F.col("class").alias("clase_name"), "label_id", "filename",
        F.concat_ws("/", F.lit(target), folder, "filename").alias("local_path"),
        F.lit("merged").alias("download_status"), F.lit("juntar_datasets").alias("origen"),
        "dataset_original", folder.alias("relative_folder"),
    )


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: files copied, overwritten and left, and unique images."""
    return merged.agg(
        F.sum("copies").alias("copied"),
        (F.sum("copies") - F.count(F.lit(1))).alias("overwritten"),
        F.count(F.lit(1)).alias("unique_files"),
        F.count_if(has_extension(F.col("filename"))).alias("unique_images"),
    )


def merge_log_enrichment(merged: DataFrame, log: DataFrame | BucketedLog) -> DataFrame:
    """Merged files with the transaction data of their earlier log rows.

    First by class, label, file name and set, then by file name alone.  A bucketed log is joined where it lies: only the
    merged files are shuffled.
    """
    found = F.coalesce("_exact", "_by_name")
    if isinstance(log, BucketedLog):
        rows = log.rows_of_files(merged.withColumn("label_id", F.col("label_id").cast("string")))
        return rows.withColumns({c: found[c] for c in CARRIED}).drop("_exact", "_by_name")
    carried = ["reference_name", "transaction_id", "transaction_start_time", "device_id", "s3_key", "motivo_descarga"]
    carried = [c for c in carried if c in log.columns]
    log = log.withColumn("filename", column_or(log, "filename", base_name(F.col("local_path"))))
    order = F.struct("transaction_id", "s3_key", "dataset_folder")
    payload = F.struct(*[F.col(c).cast("string").alias(c) for c in carried])
    full_key = {
        "class": F.col("clase_name").cast("string"), "label_id": F.col("label_id").cast("string"),
        "filename": F.col("filename"), "dataset_original": F.col("dataset_folder").cast("string"),
    }
    exact = log.groupBy(*[c.alias(n) for n, c in full_key.items()]).agg(F.min_by(payload, order).alias("_exact"))
    by_name = log.groupBy("filename").agg(F.min_by(payload, order).alias("_by_name"))
    return (
        merged.withColumn("label_id", F.col("label_id").cast("string"))
        .join(exact, list(full_key), "left").join(by_name, "filename", "left")
        .withColumns({c: found[c] for c in carried}).drop("_exact", "_by_name")
    )


# Fixed folder-name format of runs and sets.
_FOLDER = r"^dataset_(\d+)_(\d{6})_(?:v\d+_)?v(\d+)$"


def dataset_versions(log: DataFrame) -> DataFrame:
    """Sets, highest version and next free version per deployment and day of the dataset log."""
    parts = [F.regexp_extract("dataset_folder", _FOLDER, i) for i in (1, 2, 3)]
    return (
        log.filter(F.col("dataset_folder").rlike(_FOLDER)).select("dataset_folder").distinct()
        .groupBy(parts[0].cast("int").alias("deployment_id"), parts[1].alias("day"))
        .agg(
            F.count(F.lit(1)).alias("datasets"),
            F.max(parts[2].cast("int")).alias("version"),
            (F.max(parts[2].cast("int")) + 1).alias("next_version"),
        )
    )


def registry_upsert(registry: DataFrame, entries: DataFrame, replace: bool = True) -> DataFrame:
    """Registry with new entries; an existing name is replaced or, without ``replace``, kept."""
    def header(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.coalesce(column_or(df, c, F.lit("")).cast("string"), F.lit("")).alias(c) for c in REGISTRY
        ])

    old, new = header(registry), header(entries)
    if replace:
        old = old.join(new.select("dataset_name"), "dataset_name", "left_anti").select(*REGISTRY)
    else:
        new = new.join(old.select("dataset_name"), "dataset_name", "left_anti").select(*REGISTRY)
    return old.unionByName(new)
