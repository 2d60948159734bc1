"""Lookup files and tables: pairs, descriptions, activations, folders, cached rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weighlens.functions.codes import answer_is, normalize_code, strip_decimal_suffix, whole_number
from weighlens.functions.times import parse_time
from weighlens.schemas import YES_VALID_PAIR, require


def read_semicolon_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8"
) -> DataFrame:
    """A ';' file with a header; code columns are declared as text so '00014' keeps its zeros."""
    return (
        spark.read.option("sep", ";").option("header", True).option("encoding", encoding)
        .schema(schema).csv(path)
    )


def load_valid_pairs(raw: DataFrame) -> DataFrame:
    """(deployment_id,) result_index, code, valid; a pair is valid when any of its rows says so."""
    require(raw, "result_index", "selected_reference", "valida")
    keys = ["deployment_id"] if "deployment_id" in raw.columns else []
    return (
        raw.select(
            *[F.col(k).cast("string").alias(k) for k in keys],
            F.trim(F.col("result_index").cast("string")).try_cast("int").alias("result_index"),
            normalize_code(F.col("selected_reference").cast("string")).alias("code"),
            answer_is(F.col("valida"), YES_VALID_PAIR).alias("_valid"),
        )
        .filter(F.col("result_index").isNotNull() & F.col("code").isNotNull())
        .groupBy(*keys, "result_index", "code")
        .agg(F.max("_valid").alias("valid"))
    )


def _without_nbsp(text: Column) -> Column:
    return F.trim(F.regexp_replace(text.cast("string"), " ", ""))


def load_product_descriptions(raw: DataFrame, row_order: str | None = None) -> DataFrame:
    """(deployment_id,) label_index, label_name; the last row of an index wins."""
    require(raw, "label_index", "label_name")
    keys = ["deployment_id"] if "deployment_id" in raw.columns else []
    order = F.col(row_order) if row_order else F.monotonically_increasing_id()
    return (
        raw.select(
            *[F.col(k).cast("string").alias(k) for k in keys],
            whole_number(_without_nbsp(F.col("label_index"))).alias("label_index"),
            _without_nbsp(F.col("label_name")).alias("label_name"),
            order.alias("_order"),
        )
        .filter(F.col("label_index").isNotNull())
        .groupBy(*keys, "label_index")
        .agg(F.max_by("label_name", "_order").alias("label_name"))
    )


def load_activations(raw: DataFrame, row_order: str | None = None) -> DataFrame:
    """device_id, activated_at (NULL when listed without a usable date); the last row wins."""
    require(raw, "device_id")
    order = F.col(row_order) if row_order else F.monotonically_increasing_id()
    name = next((c for c in ("fecha_encendido", "Fecha encendido", "Fecha_encendido") if c in raw.columns), None)
    moment = parse_time(F.col(name).cast("string")) if name else F.lit(None).cast("timestamp_ntz")
    return (
        raw.select(
            strip_decimal_suffix(F.col("device_id")).alias("device_id"),
            moment.alias("_at"), order.alias("_order"),
        )
        .filter(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(F.max_by("_at", "_order").alias("activated_at"))
    )


def lookup_folders(folders: DataFrame, row_order: str | None = None) -> DataFrame:
    """One folder_url and folder_files per transaction; the last row wins."""
    require(folders, "transaction_id", "folder_url", "folder_files")
    order = F.col(row_order) if row_order else F.struct("folder_url", "folder_files")
    return (
        folders.groupBy(F.col("transaction_id").cast("string").alias("transaction_id"))
        .agg(F.max_by(F.struct("folder_url", "folder_files"), order).alias("_f"))
        .select("transaction_id", "_f.folder_url", "_f.folder_files")
    )


def folders_of(ids: DataFrame, folders: DataFrame) -> DataFrame:
    """Folder data of the listed transactions; unknown ids are absent."""
    wanted = ids.select(F.col("transaction_id").cast("string").alias("transaction_id"))
    return lookup_folders(folders).join(wanted, "transaction_id", "left_semi")


def lookup_folder_urls(ids: DataFrame, transactions: DataFrame, folders: DataFrame) -> DataFrame:
    """Known transactions among the ids with their folder_url, NULL where they have none."""
    wanted = ids.select(F.col("transaction_id").cast("string").alias("transaction_id"))
    known = transactions.select(F.col("transaction_id").cast("string").alias("transaction_id"))
    return known.join(wanted, "transaction_id", "left_semi").join(
        lookup_folders(folders).select("transaction_id", "folder_url"), "transaction_id", "left"
    )


def load_cached_transactions(cached: DataFrame) -> DataFrame:
    """Cached rows that have all of id, product code and image link; blank, 'none' and 'null' links are no links."""
    needed = ("transaction_id", "selected_reference_code", "image_link")
    linked = ~F.lower(F.trim("image_link")).isin("", "none", "null")
    return require(cached, *needed).dropna(subset=list(needed)).filter(linked)


def load_review_transactions(cached: DataFrame) -> DataFrame:
    """Cached rows with ``has_image`` recomputed from the link."""
    if "image_link" not in cached.columns:
        return cached.withColumn("has_image", F.lit(0))
    link = F.coalesce(F.col("image_link"), F.lit(""))
    return cached.withColumn("has_image", (~link.isin("", "null", "None")).cast("int"))
