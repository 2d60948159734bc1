"""Active model and device metrics from sums per file and day that are kept and extended, not worked out anew.

A run reads only files that no run before it has read.  Their rows become sums per (file, deployment, model, device, day),
which are committed together with the names of the files: a file counts once, whichever run stops half-way or is started
twice.  Sums add up, so the device metrics follow from them alone.  The active model depends on the latest rows: whole days
come from the sums, and only the files that hold a deployment's last day inside the cut are opened for their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weighlens.functions.ranking import first_per_group
from weighlens.operators.devices import device_report, device_sums
from weighlens.operators.models import RECENT_ROWS, day_cut, most_frequent
from weighlens.schemas import require
from weighlens.sinks.commits import CommittedTable

FILE = "_file"
_SUMS = ("_client", "_manual", "_ok", "_trained", "_ok_modelo")


@dataclass(frozen=True)
class Extension:
    files: int  # read by this run
    rows: int
    late_rows: int  # of days before the newest day that the deployment had: counted like all others


class DayStates:
    """Sums of the transactions in Parquet files of ``schema``, kept in a shared folder.

    ``label`` turns the rows of files into labelled transactions and carries the column ``_file`` along; without it the files
    hold labelled transactions.  Files are taken as they are when first seen: new rows come in new files.  Days are those of
    the session's time zone, which must not change between runs.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, label: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.schema, self.label = spark, schema, label or (lambda rows: rows)
        kinds = self._sums(self.label(spark.createDataFrame([], schema).withColumn(FILE, F.lit("")))).schema
        self.columns = kinds.names
        self.table = CommittedTable(spark, folder, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds))

    def _rows(self, files: list[str]) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(*files)
        return require(self.label(rows.withColumn(FILE, F.col("_metadata.file_path"))), FILE, "deployment_id", "model_id", "transaction_id")

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        """One pass, partial sums in each task: what is shuffled is a row per file, device, model and day."""
        dated = rows.withColumn("_day", F.to_date("transaction_start_time")).withColumn("_one", F.lit(1).cast("bigint"))
        counts = device_sums(dated, FILE, "_day")
        total = dated.groupBy(FILE, "deployment_id", "model_id", "_day").agg(F.sum("_one").alias("_rows"))
        # rows are counted beside the sums, under no device: rows without a device count for the model only
        return counts.withColumn("_rows", F.lit(0).cast("bigint")).unionByName(total, allowMissingColumns=True)

    def files(self, version: int | None = None) -> set[str]:
        """Files in the state; as many names as Spark's own listing of the source has."""
        seen = self.table.read(version).filter(F.col("_rows").isNull()).select(FILE)
        return {r[0] for r in seen.collect()}

    def extend(self, source: str) -> Extension:
        """Add the files below ``source`` that are not in the state yet; ``Conflict`` if another run adds some meanwhile."""
        before = self.table.snapshot().version
        listed = {unquote(f) for f in self.spark.read.schema(self.schema).parquet(source).inputFiles()}
        new = sorted(listed - self.files(before))
        if not new:
            return Extension(0, 0, 0)
        known = self._days(before).groupBy(F.col("deployment_id").alias("_of")).agg(F.max("_day").alias("_newest"))
        run = sha256("\n".join(new).encode()).hexdigest()
        # a row without counts says that a file is in the state, also one without rows
        names = self.spark.createDataFrame([(f,) for f in new], f"{FILE} string")
        sums = self._sums(self._rows(new)).withColumn(FILE, F.url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B"))))
        version = self.table.append(names.unionByName(sums, allowMissingColumns=True).select(*self.columns), run, before)
        if version == before:  # the same run, finished by another driver meanwhile
            return Extension(0, 0, 0)
        added = self.spark.read.schema(self.table.schema).parquet(f"{self.table.folder}/{self.table.snapshot(version).folders[-1]}")
        days = _known_day(added.filter("_rows > 0"))
        late = F.sum(F.when(F.col("_day") < F.col("_newest"), F.col("_rows")))
        counted = days.join(known, F.col("deployment_id").eqNullSafe(F.col("_of")), "left").agg(F.sum("_rows"), late).first()
        return Extension(len(new), counted[0] or 0, counted[1] or 0)

    def _days(self, version: int | None = None) -> DataFrame:
        return _known_day(self.table.read(version).filter("_rows > 0"))

    def device_metrics(self, active: DataFrame | int | None = None) -> DataFrame:
        """As ``devices.device_metrics`` over all files of the state."""
        sums = self.table.read().filter("device_id is not null and _rows = 0")
        keys = ["device_id", "deployment_id", "model_id", "_name"]
        merged = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS], F.min("_start").alias("_start"))
        return device_report(merged, active)

    def active_model(self, recent: int = RECENT_ROWS) -> DataFrame:
        """As ``models.active_model`` over the newest rows of each deployment."""
        days = self._days()
        per_day = days.groupBy("deployment_id", "_day").agg(F.sum("_rows").alias("_rows"))
        cut = day_cut(per_day, recent).withColumnsRenamed({"deployment_id": "_of"})
        of_cut = F.col("deployment_id") == F.col("_of")
        inside = days.join(cut, of_cut).filter(F.col("_day") > F.col("_edge"))
        counts = inside.select("deployment_id", "model_id", F.col("_rows").alias("n"))
        last = days.join(cut, of_cut).filter(F.col("_day") == F.col("_edge"))
        files = sorted(r[0] for r in last.select(FILE).distinct().collect())
        if files:
            rows = self._rows(files).select("deployment_id", "model_id", "transaction_start_time", "transaction_id")
            rows = _known_day(rows.withColumn("_day", F.to_date("transaction_start_time"))).join(cut, of_cut)
            rows = rows.filter(F.col("_day") == F.col("_edge"))
            order = [F.col("transaction_start_time").desc_nulls_last(), F.col("transaction_id")]
            edge = first_per_group(rows, ["deployment_id"], order, recent, "_n", "transaction_id").filter(F.col("_n") <= F.col("_need"))
            counts = counts.unionAll(edge.groupBy("deployment_id", "model_id").agg(F.count(F.lit(1)).alias("n")))
        counts = counts.groupBy("deployment_id", "model_id").agg(F.sum("n").alias("n"))
        return most_frequent(counts, ["deployment_id"])


def _known_day(rows: DataFrame) -> DataFrame:
    """Rows without a time lie before all days."""
    return rows.withColumn("_day", F.coalesce("_day", F.lit("0001-01-01").cast("date")))
