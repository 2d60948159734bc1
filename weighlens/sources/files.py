"""Image listings without reading any image."""

from __future__ import annotations

import datetime
import re

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from weighlens.functions.paths import has_extension
from weighlens.schemas import IMAGE_EXTENSIONS
from weighlens.storage import shared_dir

_ENTRY = "path string, length bigint, modificationTime timestamp, is_folder boolean"
_BATCH = 50_000  # entries handed on at once


def _store(root: str):
    """File system and inner path of a folder; plain paths are local or mounted ones."""
    uri = re.sub(r"^file:/+", "file:///", root) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root) else f"file://{root}"
    return arrow_fs.FileSystem.from_uri(uri)


def _entries(root: str):
    """Task: the entries of folders, given relative to the root ('' is the root itself)."""
    def run(batches):
        store, base = _store(root)
        base = base.rstrip("/")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(arrow_fs.FileSelector(f"{base}/{folder}".rstrip("/") or "/", recursive=False))
                for at in range(0, len(found), _BATCH):
                    part = [x for x in found[at:at + _BATCH] if x.type in (arrow_fs.FileType.File, arrow_fs.FileType.Directory)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{folder}{x.base_name}" for x in part], pa.string()), pa.array([x.size for x in part], pa.int64()),
                        pa.array([x.mtime or datetime.datetime.fromtimestamp(0, datetime.timezone.utc) for x in part], pa.timestamp("us", "UTC")),
                        pa.array([x.type == arrow_fs.FileType.Directory for x in part], pa.bool_()),
                    ], names=["path", "length", "modificationTime", "is_folder"])
    return run


def list_image_files(
    spark: SparkSession, root: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, work_dir: str | None = None,
) -> DataFrame:
    """path, length and modificationTime of every image below a folder, any letter case.

    The folders of one depth are a table; tasks list them and append what they find to ``work_dir`` (a fresh shared folder by
    default), and the folders among it are the next depth.  The driver sees one number per depth, never a file; a folder's
    own entries are held by one task.  Executors must reach the root through pyarrow.fs (a mounted folder, S3, GCS, HDFS).
    Files and folders whose names begin with '.' or '_' are listed like any other.  A missing root is an error.
    """
    work_dir = work_dir or shared_dir(spark, "listing")
    prefix = root.rstrip("/") + "/"
    folders, depth = spark.createDataFrame([("",)], "path string"), 0
    count, tasks = 1, 4 * spark.sparkContext.defaultParallelism
    while count:
        level = f"{work_dir}/depth={depth}"
        folders.repartition(min(count, tasks)).mapInArrow(_entries(root), _ENTRY).write.parquet(level)
        found = spark.read.schema(_ENTRY).parquet(level).filter("is_folder")
        folders, depth = found.select(F.concat("path", F.lit("/")).alias("path")), depth + 1
        count = found.count()
    listed = spark.read.schema(f"{_ENTRY}, depth int").parquet(work_dir).filter("not is_folder")
    return listed.filter(has_extension(F.col("path"), extensions)).select(
        F.concat(F.lit(prefix), "path").alias("path"), "length", "modificationTime"
    )
