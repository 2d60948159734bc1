"""Samples against brute force, with one group that holds a third of all rows."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weighlens.functions.ranking import first_per_group, number_all, sample_per_group
from weighlens.operators.sampling import dataset_candidates, exclude_used, limit_decisions, sample_per_device, sample_per_reference


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(30000).select(key.alias("key"), F.col("id").cast("string").alias("tx")).repartition(7)


def expected(df, wanted):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.key].append((hashlib.md5(f"42|{r.tx}".encode()).hexdigest(), r.tx))
    return {(k, tx) for k, v in groups.items() for _, tx in sorted(v)[: wanted(k)]}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("n", [0, 1, 7, 25, 9000, 20000])
def test_equals_brute_force(spark, skewed, n, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = {tuple(r) for r in sample_per_group(skewed, ["key"], "tx", F.lit(n)).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected(skewed, lambda k: n)


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 1001])
def test_bounded_samples_are_the_same_rows(spark, skewed, n):
    assert {tuple(r) for r in sample_per_group(skewed, ["key"], "tx", n).collect()} == expected(skewed, lambda k: n)
    wanted = F.when(F.col("key") == "hot", n).otherwise(2)
    assert {tuple(r) for r in sample_per_group(skewed, ["key"], "tx", wanted, most=max(n, 2)).collect()} == expected(skewed, lambda k: n if k == "hot" else 2)


def test_wanted_per_group(skewed):
    wanted = F.when(F.col("key") == "hot", 4321).otherwise(2)
    got = {tuple(r) for r in sample_per_group(skewed, ["key"], "tx", wanted).collect()}
    assert got == expected(skewed, lambda k: 4321 if k == "hot" else 2)


def test_same_rows_for_any_partitioning(skewed):
    a = {tuple(r) for r in sample_per_group(skewed.coalesce(1), ["key"], "tx", F.lit(9)).collect()}
    b = {tuple(r) for r in sample_per_group(skewed.repartition(23, "tx"), ["key"], "tx", F.lit(9)).collect()}
    assert a == b


def test_hot_rows_are_ranked_in_many_tasks(spark, skewed):
    """No window group of the plan may hold the hot key whole, even when all of it is wanted."""
    buckets = skewed.filter("key = 'hot'").groupBy(F.substring(F.md5(F.concat(F.lit("42|"), "tx")), 1, 3)).count()
    assert buckets.agg(F.max("count")).first()[0] < 30


@pytest.mark.parametrize("n", [3, 1500])
def test_first_per_group(skewed, n):
    got = first_per_group(skewed, ["key"], [F.col("tx")], n, "rank", "tx").collect()
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r.key].append(r.tx)
    want = {(k, tx, i) for k, v in groups.items() for i, tx in enumerate(sorted(v)[:n], 1)}
    assert {(r.key, r.tx, r["rank"]) for r in got} == want


@pytest.fixture
def small(rows):
    decisions = rows(
        [(1, "A", "apple", "si", 2, "fruit", 1), (2, "B", "pear", "sí", None, "fruit", 2), (3, "C", "fig", "no", 5, "fruit", 3)],
        "reference_id int, reference_code string, reference_name string, incluir_dataset string, num_imagenes_dataset int, class string, label_id bigint")
    tx = rows(
        [(str(i), "ABC"[i % 3], 7 + i % 2) for i in range(30)] + [("x", None, 7), ("y", "A", None)],
        "transaction_id string, selected_reference_code string, device_id int")
    return decisions, tx


def test_sample_is_part_of_the_candidates(small):
    from weighlens.sources.decisions import marked_for_dataset
    decisions, tx = small
    chosen = marked_for_dataset(decisions)
    candidates = dataset_candidates(chosen, tx)
    picked = sample_per_reference(candidates, chosen)
    counts = {r.reference_name: r["count"] for r in picked.groupBy("reference_name").count().collect()}
    assert counts == {"apple": 2, "pear": 10}  # two asked for; fallback 50 meets 10 available
    assert picked.select("transaction_id").subtract(candidates.select("transaction_id")).count() == 0


def test_empty_device_list_means_no_filter(small, rows):
    decisions, tx = small
    none = rows([], "device_id double, incluir_dataset string")
    assert dataset_candidates(decisions, tx, devices=none).count() == 31
    assert dataset_candidates(decisions, tx, devices=rows([(7.0, "no")], "device_id double, incluir_dataset string")).count() == 31


def test_device_ids_are_compared_as_numbers(small, rows):
    decisions, tx = small
    one = rows([(7.0, "si")], "device_id double, incluir_dataset string")
    as_double = tx.withColumn("device_id", tx.device_id.cast("double"))
    assert dataset_candidates(decisions, tx, devices=one).count() == dataset_candidates(decisions, as_double, devices=one).count() == 15


def test_device_limit_counts_asking_devices_only(small, rows):
    decisions, tx = small
    devices = rows([(float(d), "si", 3 if d == 7 else 0) for d in range(1, 11)],
                   "device_id double, incluir_dataset string, num_imagenes_dataset_adicionales int")
    for seed in range(4):
        assert sample_per_device(devices, decisions, tx, seed=seed, limit=1).count() == 3


def test_used_rows_never_return(small, rows):
    decisions, tx = small
    used = rows([(str(i),) for i in range(0, 30, 2)] + [(None,)], "transaction_id string")
    left = {r.transaction_id for r in exclude_used(tx, used).collect()}
    assert left == {str(i) for i in range(1, 30, 2)} | {"x", "y"}


def test_device_sample_avoids_taken_rows(small, rows):
    decisions, tx = small
    devices = rows([(7.0, "si", 4), (8.0, "sí", 100), (9.0, "si", 0)],
                   "device_id double, incluir_dataset string, num_imagenes_dataset_adicionales int")
    taken = rows([("0",), ("1",)], "transaction_id string")
    got = sample_per_device(devices, decisions, tx, taken).collect()
    by_device = defaultdict(set)
    for r in got:
        by_device[r.valor_motivo].add(r.transaction_id)
        assert r.selected_reference_code in ("A", "B")
    assert len(by_device["7"]) == 4 and by_device["8"] == {str(i) for i in range(1, 30, 2) if i % 3 != 2} - {"1"}


def test_limit_decisions_is_reproducible(small):
    decisions, _ = small
    a = [r.reference_code for r in limit_decisions(decisions, "reference_code", 2).collect()]
    assert len(a) == 2 and a == [r.reference_code for r in limit_decisions(decisions.repartition(3), "reference_code", 2).collect()]
    assert limit_decisions(decisions, "reference_code", None).count() == 3


def test_number_all(skewed, tmp_path):
    got = number_all(skewed, ["key"], ["tx"], "rank", str(tmp_path / "work")).collect()
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r.key].append(r.tx)
    assert {(r.key, r.tx, r["rank"]) for r in got} == {(k, tx, i) for k, v in groups.items() for i, tx in enumerate(sorted(v), 1)}
