"""What is moved, and to how many tasks: rows that sort as equal, a transaction's lines, rows without copies."""

import re

import pytest
from pyspark.sql import functions as F

from fleetcheck import tables
from weighlens.operators.images import extract_image_urls
from weighlens.operators.models import accuracy_stats
from weighlens.operators.pairs import add_pair_similarity
from weighlens.plans import candidates, training_set
from weighlens.sinks.logs import dataset_log_rows
from weighlens.sinks.tables import write_report


@pytest.fixture
def all_partitions(spark):
    """Small partitions are not put together, as they are not with larger tables."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_rows_that_sort_as_equal_are_spread(spark, all_partitions, tmp_path):
    """Most rows of a report are equal in what it is sorted by; one task must not get them all."""
    table = spark.range(8000).select("id", F.when(F.col("id") < 40, F.col("id")).otherwise(0).alias("n"), F.lit(None).cast("string").alias("s"))
    table = table.withColumn("m", F.create_map(F.lit("k"), F.col("id")))
    path = write_report({"t": table}, str(tmp_path), sort={"t": [F.col("n").desc()]})["t"]
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    files = back.groupBy("file").agg(F.count("id").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("file").collect()
    assert sum(f.rows for f in files) == 8000 and max(f.rows for f in files) < 6000
    assert all(a.low >= b.high for a, b in zip(files, files[1:]))  # still in the order asked for
    assert sorted(r.id for r in back.select("id").collect()) == list(range(8000))


def test_lines_are_moved_to_their_order_as_plain_columns(spark, fleet):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = fleet.build_raw()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(l_orderkey", line)]
    below = plan[plan.index(moved[0]):]
    assert len(moved) == 1 and "ObjectHashAggregate" not in below and "upper(" not in below


def test_candidate_report_finds_copies_by_fingerprint(spark, fleet, monkeypatch, tmp_path):
    """Two copies of every tenth row; the wide rows are compared by the operator that moves only those that may have copies."""
    fleet.tx.unionByName(fleet.tx.filter("device_id % 10 = 0")).write.parquet(f"{tmp_path}/tx")
    calls, real = [], candidates.dedupe_stored
    monkeypatch.setattr(candidates, "dedupe_stored", lambda tx: calls.append(1) or real(tx))
    written = candidates.candidate_report(
        spark.read.parquet(f"{tmp_path}/tx"), fleet.pairs, fleet.descriptions, fleet.activations, fleet.derived("fx_folders"), f"{tmp_path}/report", 2)
    assert calls and spark.read.parquet(written["deduplicated"]).count() == fleet.tx.distinct().count()


def test_lines_are_sorted_by_order_once_in_tasks_of_bounded_size(spark, fleet, monkeypatch):
    """No aggregation that sorts lines and buffers again; more lines get more tasks, and the same rows."""
    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    before = fleet.build_raw()
    lines = [x for x in plan_of(before).splitlines() if "Sort [" in x and "l_orderkey" in x]
    assert "ObjectHashAggregate" not in plan_of(before) and len(lines) == 1
    monkeypatch.setattr(tables, "LINES_PER_TASK", 500)
    after = fleet.build_raw()
    tasks = -(-fleet.given("lineitem").count() // 500)
    assert re.search(rf"Exchange hashpartitioning\(l_orderkey#\d+L?, {tasks}\)", plan_of(after))
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_urls_are_ranked_without_a_second_copy_of_their_keys(rows):
    """The sorts and the shuffle of distinct URLs carry deployment, code and URL once."""
    tx = rows([(1, "t1", "c", "http://a"), (1, "t2", "c", "http://b"), (1, "t3", "c", "http://a"), (2, "t4", "c", "http://a")],
              "deployment_id int, transaction_id string, reference_code string, image_url string").withColumn("transaction_start_time", F.col("transaction_id"))
    found = extract_image_urls(tx, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(deployment_id#\d+, reference_code#\d+, \d+\)", plan) and "_w0" not in plan and "_key" not in plan
    assert {(r.deployment_id, r.url, r.image_no) for r in found.collect()} == {(1, "http://a", 1), (1, "http://b", 2), (2, "http://a", 1)}


def _manifest(spark, listed):
    rows = spark.createDataFrame(listed, "clase_name string, label_id bigint, transaction_id string")
    return dataset_log_rows(rows.withColumn("dataset_folder", F.lit("set")))


def _written(spark, listed, path):
    """Files and tasks of a manifest's folders, and its rows read back."""
    manifest = _manifest(spark, listed)
    training_set.write_manifest(manifest, str(path))
    files = [(f.parent.parent.name, f.parent.name, f.name.split("-")[1]) for f in path.glob("*/*/*.parquet")]
    back = spark.read.parquet(str(path)).select("clase_name", "label_id", "transaction_id")
    assert sorted(map(str, back.collect())) == sorted(str(r) for r in manifest.select(*back.columns).collect())
    return files


def test_manifest_tasks_go_by_folders(spark, tmp_path):
    """Folders cost, not their bytes: 300 small ones are made by three tasks, a class by one as a rule, with one file each."""
    listed = [(f"class_{n // 3}", n, f"{n}-{i}") for n in range(300) for i in range(2)]
    listed += [(None, 1, "a"), ("x", None, "b"), (None, None, None), (None, None, None)]
    files = _written(spark, listed, tmp_path / "set")
    assert len(files) == len({f[:2] for f in files}) == 303
    assert len({task for *_, task in files}) > 2
    assert len({(c, task) for c, _, task in files}) <= 102 + 3


def test_large_folder_of_a_manifest_has_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(training_set, "ROWS_PER_FILE", 10)
    files = _written(spark, [("a", 1, str(i)) for i in range(95)] + [("a", 2, "x"), ("b", None, "y"), (None, 3, None)], tmp_path / "set")
    assert sum(f[:2] == ("class=a", "label=1") for f in files) > 5
    assert len(files) - sum(f[:2] == ("class=a", "label=1") for f in files) == 3


def test_empty_manifest(spark, tmp_path):
    manifest = _manifest(spark, [])
    training_set.write_manifest(manifest, str(tmp_path / "set"))
    assert not list((tmp_path / "set").glob("class=*"))


@pytest.fixture
def large_tables(spark):
    """Joins as they are between tables too large to be sent to every task; hot tasks are split from a few hundred bytes on."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500b",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500b", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _moved(df):
    """What each shuffle of a plan moves: its keys and its columns."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"Exchange\s+Input \[\d+\]: \[(.*?)\]\s+Arguments: hashpartitioning\((.*?), \d+\)", text), text


def test_similarity_moves_lists_whole_and_pairs_once(spark, large_tables):
    """A code that all lists hold: its task is split, and no pair is copied for that.  Rows do not carry their lists to the counts."""
    data = spark.range(50).selectExpr("'1' as deployment_id", "7 as result_index", "cast(id as string) as code", "true as valid")
    tx = spark.range(2000).selectExpr(
        "cast(id as string) transaction_id", "1 deployment_id", "7 result_index", "array('3', '3', cast(id + 40 as string)) predicted_codes",
        "if(id % 2 = 0, '3', 'x') selected_reference_code", "3 num_candidatos")
    got = add_pair_similarity(tx.unionByName(tx.limit(100)), data).drop("predicted_codes")
    moved, text = _moved(got)
    assert len(re.findall(r"^\(\d+\) Generate", text, re.M)) == 1 and len(moved) >= 4
    assert all("predicted_codes" in keys for columns, keys in moved if "predicted_codes" in columns)
    found = got.collect()
    assert len(found) == 2100 and "SortMergeJoin(skew=true)" in got._jdf.queryExecution().executedPlan().toString()
    for r in found:
        good = 2 + (int(r.transaction_id) + 40 < 50)
        assert (r.num_referencias_similares, r.num_referencias_no_similares) == (good, 3 - good)
        assert r.producto_seleccionado_similar == int(int(r.transaction_id) % 2 == 0)


def test_whole_rows_of_the_candidate_report_are_shuffled_once(spark, fleet, large_tables, monkeypatch, tmp_path):
    """Look-ups move the columns they ask by; rows may be equal in these, and a product may have two accuracies."""
    fleet.tx.unionByName(fleet.tx.filter("device_id % 10 = 0")).repartition(3).write.parquet(f"{tmp_path}/tx")
    tx = spark.read.parquet(f"{tmp_path}/tx")
    stats = accuracy_stats(tx, 1)
    stats = stats.unionByName(stats.filter("total_transactions > 1").withColumn("pct_ok_modelo", F.lit(0.5)))
    rest = fleet.pairs, fleet.activations, fleet.derived("fx_folders"), stats
    done, seen = candidates.processed_stored(tx, *rest), []
    whole = [columns for columns, _ in _moved(done)[0] if "predicted_names" in columns and "transaction_id" in columns]
    assert len(whole) == 1
    expected = candidates.processed_transactions(tx, *rest)
    assert done.columns == expected.columns and expected.count() > tx.count()
    assert sorted(map(str, done.collect())) == sorted(map(str, expected.collect()))
    monkeypatch.setattr(candidates, "processed_stored", lambda *a: seen.append(1) or candidates.processed_transactions(*a))
    candidates.candidate_report(tx, fleet.pairs, fleet.descriptions, fleet.activations, fleet.derived("fx_folders"), f"{tmp_path}/report", 2)
    assert seen
