"""Reproducible samples per group that no hot group can pull into one task.

A sample of n rows is the n rows with the lowest ``md5(seed|id)``.  The order does not
depend on partitioning, so a re-run, a lost executor or another cluster size gives the
same rows.  The cut is found from counts first: the hash space of each group is divided
into 4,096 buckets, partial counts per (group, bucket) are summed, and only rows at or
below the bucket in which the n-th row lies are shuffled for ranking - at most n rows
plus one bucket of each group, ranked bucket by bucket.

Buckets are grouped as one struct column on purpose: Spark then never takes an earlier
join's partitioning by the group key for good enough, so the rows of a hot group are
spread over its buckets, and the join before may be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weighlens.schemas import SEED

_BUCKET_DIGITS = 3  # hex digits: 16**3 buckets per group
_SLICES = 256
_MOST_PER_TASK = 1000  # Spark cuts a ranked group in each task before the shuffle up to this rank
_MOST_IN_ALL = 1 << 20


def sample_key(row_id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string")))


def sample_per_group(
    rows: DataFrame, keys: list[str], row_id: str, wanted: Column | int, seed: int = SEED, most: int | None = None,
) -> DataFrame:
    """The ``wanted`` rows (constant within a group) with the lowest sample keys of each group.

    ``most`` is a bound on ``wanted``, if one is known.  Up to 1,000 the rows are then evaluated once: every task keeps the
    lowest ``most`` of each group, and one exchange merges them.  Without it, or beyond, the cut is found from counts.
    """
    if isinstance(wanted, int):
        most, wanted = wanted, F.lit(wanted)
    if most is not None and most <= _MOST_PER_TASK:
        keyed = rows.withColumns({"_order": sample_key(F.col(row_id), seed), "_wanted": wanted.cast("bigint")}).filter(F.col("_wanted") > 0)
        lowest = first_per_group(keyed, keys, [F.col("_order"), F.col(row_id)], max(most, 1), "_rank", row_id)
        return lowest.filter(F.col("_rank") <= F.col("_wanted")).drop("_order", "_wanted", "_rank")
    keyed = rows.withColumns({
        "_order": sample_key(F.col(row_id), seed),
        "_bucket": F.substring(sample_key(F.col(row_id), seed), 1, _BUCKET_DIGITS),
        "_wanted": wanted.cast("bigint"),
    }).filter(F.col("_wanted") > 0)

    cell = F.struct(*keys, "_bucket")
    counts = (
        keyed.groupBy(cell.alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_wanted").alias("_limit"))
        .select("_cell.*", "_n", "_limit")
    )
    running = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    cut = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .filter(F.col("_before") < F.col("_limit"))
        .groupBy(*keys)
        .agg(
            F.max("_bucket").alias("_cut"),
            F.max_by(F.col("_limit") - F.col("_before"), "_bucket").alias("_room"),
        )
    )
    near = keyed.join(cut, keys).filter(F.col("_bucket") <= F.col("_cut"))
    return (
        near.withColumn("_rank", F.row_number().over(W.partitionBy(cell).orderBy("_order", row_id)))
        .filter((F.col("_bucket") < F.col("_cut")) | (F.col("_rank") <= F.col("_room")))
        .drop("_order", "_bucket", "_wanted", "_cut", "_room", "_rank")
    )


def first_per_group(
    rows: DataFrame, keys: list[str], order: list[Column], n: int, rank: str, row_id: str, dealt: bool = False,
) -> DataFrame:
    """First n rows of each group with their 1-based position.

    Every task keeps n rows of a group, so the task that ranks a hot group gets n rows from each.  Where that may be many (n
    times the shuffle partitions), each group is first cut to n rows per slice of its hash space: its last task then gets a
    number of rows that depends on n only, not on the data or on the number of tasks.

    ``dealt`` says that the rows come from a grouping by the keys and more columns: a group's rows lie in many tasks then, and
    the sorts need not carry the keys a second time.
    """
    group = F.struct(*keys)  # one struct column, for the reason given above
    window = W.partitionBy(*(keys if dealt else [group])).orderBy(*order)
    if n <= _MOST_PER_TASK and n * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) <= _MOST_IN_ALL:
        return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    within = W.partitionBy(F.struct(group, F.pmod(F.xxhash64(row_id), F.lit(_SLICES)))).orderBy(*order)
    rows = rows.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= n).drop("_rank")
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def number_all(rows: DataFrame, keys: list[str], order: list[str], rank: str, work_dir: str) -> DataFrame:
    """1-based position of every row in its group, however large the group is.

    The rows are written once in range partitions of (keys, order), so that the partition
    numbers are fixed; positions are counted inside each and shifted by the sizes before it.
    """
    spark = rows.sparkSession
    (
        rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
        .write.parquet(work_dir)
    )
    kept = spark.read.schema(f"{_ddl(rows)}, _part int").parquet(work_dir)
    cell = F.struct(*keys, "_part")
    sizes = kept.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).select("_cell.*", "_n")
    running = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.withColumn("_shift", F.coalesce(F.sum("_n").over(running), F.lit(0))).drop("_n")
    position = F.row_number().over(W.partitionBy(cell).orderBy(*order)) + F.col("_shift")
    return kept.join(shifts, [*keys, "_part"]).withColumn(rank, position).drop("_part", "_shift")


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
