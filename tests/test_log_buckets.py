"""Bucketed logs: the same rows as the plain joins, and no shuffle of the log."""

import re

import pytest
from pyspark.sql import functions as F

from weighlens.operators.datasets import dataset_summary, merge_datasets, merge_log_enrichment
from weighlens.sources.log_buckets import BucketedLog

LOG = "clase_name string, label_id bigint, transaction_id string, transaction_start_time string, device_id bigint, s3_key string, local_path string, dataset_folder string, reference_name string, motivo_descarga string"
FILES = "dataset string, set_order int, class string, label_id bigint, filename string"


def _row(t, name, cls="a", label=1, time="2020-01-01 00:00:00", device=1, folder="s1", key="k"):
    return (cls, label, t, time, device, key + (t or ""), f"x/{cls}/{label}/{name}" if name else "", folder, f"ref {t}", "reference")


@pytest.fixture
def log(rows):
    return rows([
        _row("t1", "200101_000000_t1_1.jpg"), _row("t1", "200101_000000_t1_1.jpg", folder="s2", key="a"),
        _row("t2", "200101_000000_t2_1.jpg", time=None), _row("t2", "other.jpg", time="2021-05-05 00:00:00", device=9),
        _row("t2", "other.jpg", cls="b", time="no time", device=99, key="z"), _row(None, ""), _row("", "", device=3), _row(None, "nobody.jpg"),
    ], LOG)


@pytest.fixture
def files(rows):
    return rows([
        ("s1", 1, "a", 1, "200101_000000_t1_1.jpg"), ("s2", 2, "c", 1, "200101_000000_t1_1.jpg"), ("s1", 1, "a", 1, "200101_000000_t2_1.jpg"),
        ("s1", 1, "b", 1, "other.jpg"), ("s1", 1, "b", 2, "nobody.jpg"), ("s1", 1, "b", 2, "unknown.jpg"), ("s1", 1, "b", 2, None), ("s1", 1, "b", 2, ""),
        ("s1", 1, None, None, "other.jpg"),
    ], FILES)


def _set(df, columns=None):
    return sorted(map(str, df.select(*(columns or sorted(df.columns))).collect()))


def test_bucketed_joins_equal_plain_joins(spark, log, files, tmp_path):
    buckets = BucketedLog.create(spark, str(tmp_path), 4)
    empty = merge_log_enrichment(merge_datasets(files), buckets)
    assert empty.count() == 9 and empty.filter("s3_key is not null").isEmpty()
    buckets.append(log.filter("dataset_folder = 's1'"))
    buckets.append(log.filter("dataset_folder = 's2'"))
    buckets.append(log.filter("dataset_folder = 's2'"))  # a run that was started twice
    again = BucketedLog(spark, str(tmp_path))
    merged = merge_datasets(files)
    worded = lambda df: df.filter("coalesce(filename, '') != ''")
    assert _set(worded(merge_log_enrichment(merged, again))) == _set(worded(merge_log_enrichment(merged, log)))
    assert merge_log_enrichment(merged, again).filter("coalesce(filename, '') = '' and s3_key is null").count() == 2
    assert _set(dataset_summary(files, [again])) == _set(dataset_summary(files, [log.filter("transaction_id != ''")]))


def test_other_sources_count_beside_the_buckets(spark, rows, log, files, tmp_path):
    other = rows([("t1", "5", "2019-01-01 00:00:00"), ("t2", "6", "2030-01-01 00:00:00"), (None, "7", "2031-01-01 00:00:00")],
                 "transaction_id string, device_id string, transaction_start_time string")
    buckets = BucketedLog.create(spark, str(tmp_path), 4)
    buckets.append(log)
    assert _set(dataset_summary(files, [buckets, other])) == _set(dataset_summary(files, [log.filter("transaction_id != ''"), other]))


def test_only_the_asking_rows_are_shuffled(spark, log, files, tmp_path):
    buckets = BucketedLog.create(spark, str(tmp_path), 4)
    buckets.append(log)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = files.select("filename", "class", F.col("label_id").cast("string").alias("label_id"), F.col("dataset").alias("dataset_original"))
        plans = [
            buckets.rows_of_files(named)._jdf.queryExecution().executedPlan().toString(),
            buckets.newest_of(named.select(F.col("filename").alias("transaction_id")))._jdf.queryExecution().executedPlan().toString(),
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for plan, scans in zip(plans, (2, 1)):
        assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == scans  # those asked for, of the asking rows
        assert len(re.findall(r"FileScan parquet .*?SelectedBucketsCount: 4 out of 4", plan)) == scans


def test_a_key_that_repeats_without_end_is_one_row(spark, log, tmp_path):
    many = spark.range(30_000).select(
        F.lit("a").alias("clase_name"), F.lit(1).alias("label_id"), F.lit("t").alias("transaction_id"),
        F.lit("2020-01-01 00:00:00").alias("transaction_start_time"), F.col("id").alias("device_id"), F.col("id").cast("string").alias("s3_key"),
        F.lit("x/f.jpg").alias("local_path"), F.lit("s1").alias("dataset_folder"))
    buckets = BucketedLog.create(spark, str(tmp_path), 4)
    buckets.append(many)
    for name in ("files", "names", "transactions"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 1
    assert buckets.newest_of(spark.createDataFrame([("t",)], "transaction_id string")).first()["_logged"]["device_id"] == "9999"
