"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fleetcheck.registry import QUERIES
from conftest import SMALL
from fleetcheck.tables import AS_OF
from weighlens.functions.ranking import first_per_group, sample_per_group
from weighlens.operators import models, references
from weighlens.sources.transactions import scan_transactions

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")

# queries that write and re-read whole reports: their tables are checked through the operators
WRITING = {"quality_report", "candidate_report", "write_report", "register_dataset", "list_image_files", "deployment_report", "merge_sets"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    assert not [word for word in FORBIDDEN if word in plan]


def test_scan_pushes_filters_and_prunes_columns(fleet):
    df = scan_transactions(fleet.raw, 3, AS_OF, 400, model_id=30).select("transaction_id", "transaction_data.model_id")
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    for part in ("In(transaction_metric", "EqualTo(deployment_id,3)", "GreaterThanOrEqual(transaction_start_time",
                 "EqualTo(transaction_data.model_id,30)"):
        assert part in pushed
    assert "predicted_codes" not in read and "device_name" not in read


def test_fact_rows_are_summed_before_the_product_join(fleet):
    plan = plan_of(references.reference_metrics(fleet.tx, fleet.catalogue))
    scan = next(i for i, line in enumerate(plan.splitlines()) if "transaction_data" in line and "FileScan" in line)
    above = [line for line in plan.splitlines()[:scan] if "Aggregate" in line or "Join" in line]
    assert "partial_count" in above[-1]  # nearest operator above the fact scan


def test_constant_limit_is_applied_before_the_shuffle(fleet):
    for n, limits in ((5, 2), (1000, 2)):  # before and after the one shuffle
        df = first_per_group(fleet.tx, ["deployment_id"], [F.col("transaction_id")], n, "n", "transaction_id")
        assert plan_of(df).count("WindowGroupLimit") == limits and plan_of(df).count("Exchange hashpartitioning") == 1


def test_limits_of_wide_shuffles_go_by_slice_first(spark, fleet):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000000")
    try:
        df = first_per_group(fleet.tx, ["deployment_id"], [F.col("transaction_id")], 5, "n", "transaction_id")
        assert plan_of(df).count("WindowGroupLimit") == 4  # per slice and per group, each before and after its shuffle
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_bounded_sample_reads_its_rows_once(fleet):
    plan = plan_of(sample_per_group(fleet.tx, ["device_id"], "transaction_id", 50))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_latest_rows_need_no_full_sort(fleet):
    plan = plan_of(models.active_model(fleet.tx))
    assert "HashAggregate(keys=[deployment_id" in plan


def test_sample_ranks_by_bucket_after_a_shuffle_of_its_own(spark, fleet):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = sample_per_group(fleet.tx, ["device_id"], "transaction_id", F.lit(3))
        lines = plan_of(df).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    window = next(i for i, line in enumerate(lines) if "Window " in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert any("Exchange hashpartitioning" in line for line in lines[window:join])
