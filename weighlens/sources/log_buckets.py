"""The logs of all sets, bucketed by file name and by transaction id, for joins that leave them where they lie.

The logs grow with every set; a merge or a summary asks for the rows of one.  Three tables hold what the joins need: the log
row that counts per file (name, class, label, set) and per file name, and per transaction its newest device and time.  Each is
written in hash buckets of its key.  A join deals the asking rows to the same buckets, so only they are shuffled; the tables are read
bucket by bucket and summed in place.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weighlens.functions.paths import base_name
from weighlens.schemas import column_or

CARRIED = ("reference_name", "transaction_id", "transaction_start_time", "device_id", "s3_key", "motivo_descarga")
FULL_KEY = ("filename", "class", "label_id", "dataset_original")

_TEXTS = ", ".join(f"{c}: string" for c in CARRIED)
_BEST = f"best struct<transaction_id: string, s3_key: string, dataset_folder: string, payload: struct<{_TEXTS}>>"
_TABLES = {  # name: (key, columns besides it)
    "files": (FULL_KEY, _BEST),
    "names": (("filename",), _BEST),
    "transactions": (("transaction_id",), "newest struct<timed: boolean, at: timestamp_ntz, device_id: string>"),
}


def newest_row(device: Column, time: Column) -> Column:
    """Struct whose maximum over a transaction's rows is the newest one: rows with a time before those without."""
    at = time.cast("string").try_cast("timestamp_ntz")
    return F.struct(at.isNotNull().alias("timed"), at.alias("at"), device.cast("string").alias("device_id"))


class BucketedLog:
    """Bucketed log tables in a shared folder; ``append`` extends them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = spark.read.schema("buckets int").parquet(f"{self.folder}/layout").first()[0]
        self._names = {}
        for table, (key, more) in _TABLES.items():
            self._names[table] = f"log_{table}_{sha256(self.folder.encode()).hexdigest()[:16]}"
            place, keys = f"{self.folder}/{table}".replace("'", r"\'"), ", ".join(key)
            spark.sql(
                f"create table if not exists {self._names[table]} ({', '.join(f'{k} string' for k in key)}, {more}) using parquet "
                f"clustered by ({keys}) sorted by ({keys}) into {self.buckets} buckets location '{place}'"
            )

    @classmethod
    def create(cls, spark: SparkSession, folder: str, buckets: int = 400) -> BucketedLog:
        """Empty tables.  ``buckets`` stays as it is: choose it so that a bucket of the finished log fits a task."""
        spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{folder.rstrip('/')}/layout")
        return cls(spark, folder)

    def append(self, log: DataFrame) -> None:
        """Add a log.  Rows without a file name, or without a transaction id, are left out of that table: they match nothing.

        Rows of one key are reduced to the one that counts before they are shuffled, so a key that repeats without end is one row
        per task.  The tables hold minima and maxima: a log that is added twice changes no result.
        """
        log = log.withColumns({c: column_or(log, c, F.lit(None)).cast("string") for c in CARRIED})
        name = column_or(log, "filename", base_name(F.col("local_path"))) if {"filename", "local_path"} & set(log.columns) else F.lit(None)
        named = log.select(
            name.cast("string").alias("filename"), F.col("clase_name").cast("string").alias("class"),
            F.col("label_id").cast("string").alias("label_id"), F.col("dataset_folder").cast("string").alias("dataset_original"),
            F.struct("transaction_id", "s3_key", F.col("dataset_folder").cast("string").alias("dataset_folder"), F.struct(*CARRIED).alias("payload")).alias("best"),
        )
        named = named.filter(F.col("filename") != "")
        newest = newest_row(F.col("device_id"), F.col("transaction_start_time"))
        moved = log.filter(F.col("transaction_id") != "")
        for table, rows, kept in (("files", named, F.min("best")), ("names", named, F.min("best")), ("transactions", moved, F.max(newest))):
            key = _TABLES[table][0]
            rows.groupBy(*key).agg(kept.alias("kept")).repartition(self.buckets, *key).write.insertInto(self._names[table])

    def _beside(self, rows: DataFrame, key: str, joined: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``rows`` joined bucket by bucket; rows without a key, which may be many, stay where they are."""
        without = rows.filter(F.col(key).isNull() | (F.col(key) == ""))
        return joined(rows.filter(F.col(key) != "")).unionByName(without, allowMissingColumns=True)

    def rows_of_files(self, files: DataFrame) -> DataFrame:
        """``files`` (with the columns of FULL_KEY) with ``_exact``, the log row of the same file of the same set, and
        ``_by_name``, that of any file of this name; structs of CARRIED, NULL where there is none."""
        exact = self.spark.table(self._names["files"]).groupBy(*FULL_KEY).agg(F.min("best").alias("_e"))
        by_name = self.spark.table(self._names["names"]).groupBy("filename").agg(F.min("best").alias("_b"))
        return self._beside(files, "filename", lambda asked: (
            asked.repartition(self.buckets, *FULL_KEY).join(exact, list(FULL_KEY), "left")
            .repartition(self.buckets, "filename").join(by_name, "filename", "left")
            .withColumns({"_exact": F.col("_e.payload"), "_by_name": F.col("_b.payload")}).drop("_e", "_b")
        ))

    def newest_of(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with transaction_id) with ``_logged``, the transaction's newest log row as of ``newest_row``."""
        newest = self.spark.table(self._names["transactions"]).groupBy("transaction_id").agg(F.max("newest").alias("_logged"))
        return self._beside(rows, "transaction_id", lambda asked: (
            asked.repartition(self.buckets, "transaction_id").join(newest, "transaction_id", "left")
        ))
