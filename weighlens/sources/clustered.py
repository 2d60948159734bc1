"""Transactions clustered by deployment and day at once, with the ranges of each file beside them.

One folder per deployment makes a few days of it read its whole history; one folder per day makes a deployment read the
whole fleet.  Here rows are laid out along the interleaved bits of both, so that a file holds few deployments and few days,
and a table of file ranges says which files a scan has to open.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weighlens.schemas import ALL_METRICS, DAYS_BACK, require
from weighlens.sources.transactions import scan_transactions

BITS = 10  # of each of the two; a finer place within a cell decides nothing but the cut of files
_RANGES = "name string, low_deployment bigint, high_deployment bigint, low_day date, high_day date, row_count bigint"


def _interleaved(first: Column, second: Column) -> Column:
    """One number whose bits are those of the two in turn, the highest first."""
    out = F.lit(0).cast("bigint")
    for i in range(BITS):
        for shift, value in ((2 * i + 1, first), (2 * i, second)):
            bit = F.shiftright(value, i).bitwiseAND(F.lit(1).cast("bigint"))
            out = out + F.shiftleft(bit, shift)
    return out


def write_clustered(tx: DataFrame, folder: str, rows_per_file: int = 2_000_000) -> int:
    """Write transactions in files of about ``rows_per_file`` rows below ``folder``; returns the number of files.

    Rows without a deployment or time are kept and lie at the lower end.  A deployment's day of any size is cut into several
    files by a hash of its ids.  The ranges are written last: a folder without them is not complete.
    """
    require(tx, "deployment_id", "transaction_start_time", "transaction_id")
    day = F.datediff(F.to_date("transaction_start_time"), F.lit("1970-01-01").cast("date")).cast("bigint")
    spots = tx.select(F.col("deployment_id").cast("bigint").alias("a"), day.alias("b"))
    ends = spots.agg(F.count(F.lit(1)), F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    count, ends = ends[0], [e or 0 for e in ends[1:]]

    def place(value: Column, low: int, high: int) -> Column:
        return F.coalesce(F.floor((value - low) * ((1 << BITS) - 1) / max(high - low, 1)), F.lit(0)).cast("bigint")

    files = max(1, -(-count // rows_per_file))
    cell = _interleaved(place(F.col("deployment_id").cast("bigint"), *ends[:2]), place(day, *ends[2:]))
    columns = tx.columns
    (
        tx.withColumns({"_cell": cell, "_within": F.xxhash64("transaction_id")})
        .repartitionByRange(files, "_cell", "_within").sortWithinPartitions("_cell", "transaction_start_time").select(*columns)
        .write.parquet(f"{folder}/data")
    )
    written = tx.sparkSession.read.schema(tx.schema).parquet(f"{folder}/data")
    moment, of = F.to_date("transaction_start_time"), F.col("deployment_id").cast("bigint")
    ranges = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.min(of).alias("low_deployment"), F.max(of).alias("high_deployment"),
        F.min(moment).alias("low_day"), F.max(moment).alias("high_day"), F.count(F.lit(1)).alias("row_count"))
    ranges.coalesce(1).write.parquet(f"{folder}/ranges")
    return tx.sparkSession.read.schema(_RANGES).parquet(f"{folder}/ranges").count()


def files_to_read(spark: SparkSession, folder: str, deployment_id: int, as_of: datetime, days_back: int = DAYS_BACK) -> list[str]:
    """Paths of the files that may hold a row of the deployment in the window of ``scan_transactions``."""
    ranges = spark.read.schema(_RANGES).parquet(f"{folder}/ranges")
    first, last = (as_of - timedelta(days=days_back)).date(), as_of.date()
    met = ranges.filter(
        (F.col("low_deployment") <= deployment_id) & (F.col("high_deployment") >= deployment_id)
        & (F.col("low_day") <= F.lit(last)) & (F.col("high_day") >= F.lit(first))
    )
    return [f"{folder}/data/{r['name']}" for r in met.select("name").orderBy("name").collect()]


def scan_clustered(
    spark: SparkSession, folder: str, schema, deployment_id: int, as_of: datetime, days_back: int = DAYS_BACK,
    model_id: int | None = None, metrics: tuple[str, ...] = ALL_METRICS,
) -> DataFrame:
    """``scan_transactions`` of a clustered folder: files whose ranges cannot hold such rows are not opened."""
    files = files_to_read(spark, folder, deployment_id, as_of, days_back)
    tx = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return scan_transactions(tx, deployment_id, as_of, days_back, model_id, metrics)
