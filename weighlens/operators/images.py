"""Image folders of transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weighlens.functions.paths import clean_image_link, folder_at, folder_depth, has_extension
from weighlens.schemas import FOLDER_EXTENSIONS, IMAGE_EXTENSIONS, shared_scope
from weighlens.functions.ranking import first_per_group, number_all
from weighlens.sources.lookups import lookup_folders
from weighlens.storage import shared_dir


def folder_file_list(text: Column) -> Column:
    """A list literal as text to an array; anything else to an empty array."""
    parsed = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))


def add_image_info(tx: DataFrame, folders: DataFrame, row_order: str | None = None) -> DataFrame:
    """has_image, num_images and image_link; 0, 0 and '' without a folder row."""
    info = lookup_folders(folders, row_order).select(
        F.col("transaction_id").alias("_id"),
        F.size(folder_file_list(F.col("folder_files"))).alias("_n"),
        F.coalesce("folder_url", F.lit("")).alias("_url"),
    )
    n = F.coalesce("_n", F.lit(0))
    return (
        tx.join(info, F.col("transaction_id").cast("string") == F.col("_id"), "left")
        .withColumns({
            "has_image": (n > 0).cast("int"),
            "num_images": n,
            "image_link": F.when(n > 0, F.col("_url")).otherwise(F.lit("")),
        })
        .drop("_id", "_n", "_url")
    )


def _with_folders(files: DataFrame, depths: Column, extensions: tuple[str, ...]) -> DataFrame:
    """Each image once per enclosing folder of the given depths."""
    return (
        files.filter(has_extension(F.col("path"), extensions))
        .select("path", F.explode(depths).alias("_depth"))
        .filter(F.col("_depth") <= folder_depth(F.col("path")))
        .select("path", folder_at(F.col("path"), F.col("_depth")).alias("folder"))
    )


def first_image_per_folder(folders: DataFrame, files: DataFrame, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> DataFrame:
    """(folder, first_key): for each folder (with its trailing slash) the first image key in listing order below it, if any.

    An as-of merge: folders and keys are sorted together by ranges, and the first key behind a folder is its image if it begins
    with the folder.  Every key is moved once, whatever its depth; the key behind the last folder of a range is the first key
    of a later range, and there is one such row per range.
    """
    spark = files.sparkSession
    # a folder that holds nothing at all needs no row of its own: names that end in '/' sort before all that they begin
    both = folders.select(F.col("folder").alias("name"), F.lit(True).alias("asked")).distinct().union(
        files.filter(has_extension(F.col("path"), extensions)).select("path", F.lit(False))
    )
    work_dir = shared_dir(spark, "first-images")
    both.repartitionByRange("name").withColumn("part", F.spark_partition_id()).write.parquet(work_dir)
    both = spark.read.schema("name string, asked boolean, part int").parquet(work_dir)
    key = F.when(~F.col("asked"), F.col("name"))
    back = W.partitionBy("part").orderBy(F.desc("name"), "asked").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = both.withColumn("behind", F.last(key, ignorenulls=True).over(back)).filter("asked")
    edges = both.groupBy("part").agg(F.min(key).alias("first"))
    later = W.orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)  # one row per range
    edges = edges.select("part", F.last("first", ignorenulls=True).over(later).alias("next"))
    first = F.coalesce("behind", "next")
    return placed.join(edges, "part").filter(first.startswith(F.col("name"))).select(F.col("name").alias("folder"), first.alias("first_key"))


def resolve_image_keys(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``s3_key`` of each row: the link itself, or the first image of the folder it names.

    NULL where the link is empty or its folder holds no image.  With a listing the rows are written once into the shared
    folder, as the folders they name and the rows themselves are read apart.
    """
    rows = rows.withColumn("_link", clean_image_link(F.col("image_link")))
    direct = F.when(has_extension(F.col("_link")), F.col("_link"))
    if files is None:
        return rows.withColumn("s3_key", direct).drop("_link")
    folder = F.when(
        ~has_extension(F.col("_link")), F.concat(F.regexp_replace("_link", "/+$", ""), F.lit("/"))
    )
    work_dir = shared_dir(rows.sparkSession, "linked-rows")
    rows = rows.withColumns({"_folder": folder, "_direct": direct}).drop("_link")
    rows.write.parquet(work_dir)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(work_dir)
    firsts = first_image_per_folder(rows.select(F.col("_folder").alias("folder")).filter("folder is not null"), files)
    # rows without a folder get a key of their own that matches nothing, so they stay spread out
    none = F.concat(F.lit("\x00"), F.col("transaction_id").cast("string"))
    return (
        rows.withColumn("_folder", F.coalesce("_folder", none))
        .join(firsts.withColumnRenamed("folder", "_folder"), "_folder", "left")
        .withColumn("s3_key", F.coalesce("_direct", "first_key"))
        .drop("_direct", "_folder", "first_key")
    )


def first_n_per_folder(
    folders: DataFrame, files: DataFrame, max_images: int | None,
    extensions: tuple[str, ...] = FOLDER_EXTENSIONS, work_dir: str | None = None,
) -> DataFrame:
    """First images below each transaction's folder in listing order, named ``<id>_<i>.jpg``.

    Without ``max_images`` all of them, numbered by way of ``work_dir`` (a fresh shared folder by default).
    """
    wanted = folders.filter(F.col("folder_url").isNotNull()).select(
        "transaction_id",
        F.concat(F.regexp_replace("folder_url", "^/+|/+$", ""), F.lit("/")).alias("folder"),
    )
    # only prefixes as deep as a wanted folder: the top folders, which hold everything, drop out
    depths = wanted.agg(F.collect_set(folder_depth(F.col("folder")))).scalar()
    keys = _with_folders(files, depths, extensions)
    found = keys.join(wanted, "folder").drop("folder")
    if max_images is None:
        work_dir = work_dir or shared_dir(found.sparkSession, "numbered")
        ranked = number_all(found, ["transaction_id"], ["path"], "image_no", work_dir)
    else:
        ranked = first_per_group(found, ["transaction_id"], [F.col("path")], max_images, "image_no", "path")
    return ranked.select(
        "transaction_id", F.col("path").alias("s3_key"), "image_no",
        F.concat(F.col("transaction_id"), F.lit("_"), F.col("image_no"), F.lit(".jpg")).alias("filename"),
    )


def extract_image_urls(tx: DataFrame, max_images: int | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Distinct image URLs per product code in order of first appearance.

    Appearance goes column by column (all columns named *image*url*, then ``image_path``)
    and by time within a column.  A row counts once for each of its two product codes.  Codes belong to their
    deployment where the rows (and ``codes``) have ``deployment_id``; it is then a column of the result.
    """
    scope = shared_scope(tx, *([codes] if codes is not None else []))
    names = [c for c in tx.columns if "image" in c.lower() and "url" in c.lower()]
    names += ["image_path"] if "image_path" in tx.columns else []
    code_columns = [F.col(c) for c in ("reference_code", "product_code") if c in tx.columns]
    values = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(c).cast("string").alias("url")) for i, c in enumerate(names)])
    urls = (
        tx.select(
            *scope, F.explode(F.array_distinct(F.array_compact(F.array(*code_columns)))).alias("reference_code"),
            "transaction_start_time", "transaction_id", values.alias("_values"),
        )
        .select(*scope, "reference_code", "transaction_start_time", "transaction_id", F.inline("_values"))
        .filter(F.col("url").startswith("http") | F.col("url").startswith("/"))
    )
    if codes is not None:
        urls = urls.join(codes.select(*scope, "reference_code"), [*scope, "reference_code"], "left_semi")
    keys = [*scope, "reference_code", "url"]
    first_seen = F.min(F.struct("pos", "transaction_start_time", "transaction_id")).alias("first_seen")
    if codes is None:
        first = urls.groupBy(*keys).agg(first_seen)
    else:  # one struct key: a semi join by code before must not decide where a hot code is summed up
        first = urls.groupBy(F.struct(*keys).alias("_key")).agg(first_seen).select("_key.*", "first_seen")
    if max_images is None:
        return first
    return first_per_group(
        first, [*scope, "reference_code"], [F.col("first_seen"), F.col("url")], max_images, "image_no", "url", dealt=True
    )
