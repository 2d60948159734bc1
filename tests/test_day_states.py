"""Kept sums against full runs: late files, repeated runs, edge days, files that are read."""

import random

import pytest
from pyspark.sql import functions as F

from weighlens.operators import devices, models
from weighlens.plans.day_states import DayStates, Extension
from weighlens.sinks.commits import Conflict

KIND = """transaction_id string, deployment_id bigint, model_id bigint, device_id bigint, device_name string, transaction_metric string,
    Ok int, Ok_modelo int, selected_reference_is_trained boolean, transaction_start_time timestamp_ntz"""


def _transactions(spark, seed, n, first_day, days):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        day = first_day + draw.randrange(days)
        time = None if draw.random() < 0.05 else f"2024-03-{day:02d} {draw.randrange(4):02d}:00:00"
        out.append((
            f"{seed}-{i}", draw.choice([1, 1, 2, None]), draw.choice([10, 11, 12, None]), draw.choice([1, 2, 3, None]),
            draw.choice(["a", "b", None]), draw.choice(["WSPROCESSCOMPLETED03", "WSREFERENCEIMAGEAC01"]),
            draw.randrange(2), draw.choice([0, 1, None]), draw.choice([True, False, None]), time))
    return spark.createDataFrame(out, KIND.replace("transaction_start_time timestamp_ntz", "t string")).withColumn(
        "transaction_start_time", F.col("t").cast("timestamp_ntz")).drop("t")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_extended_states_equal_full_runs(spark, tmp_path):
    source, read = f"{tmp_path}/in coming", lambda: spark.read.parquet(f"{tmp_path}/in coming")
    first = _transactions(spark, 1, 300, 5, 4)
    first.repartition(3).write.parquet(source)
    state = DayStates(spark, f"{tmp_path}/state", first.schema)
    assert state.extend(source) == Extension(3, 300, 0)
    assert state.extend(source) == Extension(0, 0, 0)
    late = _transactions(spark, 2, 200, 3, 8)
    late.repartition(2).write.mode("append").parquet(source)
    got = DayStates(spark, f"{tmp_path}/state", first.schema).extend(source)
    newest = {r[0]: r[1] for r in first.groupBy("deployment_id").agg(F.max(F.to_date("transaction_start_time"))).collect()}
    behind = sum(
        r.transaction_start_time is None or r.transaction_start_time.date() < newest[r.deployment_id] for r in late.collect())
    assert got == Extension(2, 200, behind) and behind > 0
    for recent in (1, 7, 60, 1000):
        full = _rows(models.active_model(read(), recent).filter("deployment_id is not null"))
        assert _rows(state.active_model(recent)) == full and full
    active = models.active_model(read(), 60).filter("deployment_id is not null")
    assert _rows(state.device_metrics(state.active_model(60))) == _rows(devices.device_metrics(read(), active))
    assert _rows(state.device_metrics()) == _rows(devices.device_metrics(read()))


def test_the_cut_opens_only_files_of_its_last_day(spark, tmp_path, monkeypatch):
    for seed, day in ((1, 5), (2, 6), (3, 7)):
        _transactions(spark, seed, 80, day, 1).filter("transaction_start_time is not null").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    state = DayStates(spark, f"{tmp_path}/state", spark.read.parquet(f"{tmp_path}/in").schema)
    state.extend(f"{tmp_path}/in")
    opened = []
    monkeypatch.setattr(state, "_rows", lambda files: opened.extend(files) or DayStates._rows(state, files))
    assert _rows(state.active_model(5)) == _rows(models.active_model(spark.read.parquet(f"{tmp_path}/in"), 5).filter("deployment_id is not null"))
    assert len(opened) == 1


def test_two_runs_cannot_add_the_same_file(spark, tmp_path, monkeypatch):
    rows = _transactions(spark, 1, 20, 5, 1).coalesce(1)
    rows.write.parquet(f"{tmp_path}/in")
    one, other = (DayStates(spark, f"{tmp_path}/state", rows.schema) for _ in range(2))
    seen = other.files()
    rows.write.mode("append").parquet(f"{tmp_path}/in")
    before = other.table.snapshot()
    assert one.extend(f"{tmp_path}/in").files == 2
    monkeypatch.setattr(other, "files", lambda version=None: seen)
    monkeypatch.setattr(other.table, "snapshot", lambda version=None: before)
    one_file = next(str(p) for p in (tmp_path / "in").iterdir() if p.name.endswith(".parquet"))
    with pytest.raises(Conflict):
        other.extend(one_file)


def test_empty_source_and_files_without_rows(spark, tmp_path):
    rows = _transactions(spark, 1, 20, 5, 1)
    rows.limit(0).coalesce(1).write.parquet(f"{tmp_path}/in")
    state = DayStates(spark, f"{tmp_path}/state", rows.schema)
    state.extend(f"{tmp_path}/in")
    assert state.active_model().count() == 0 and state.device_metrics().count() == 0
    assert state.extend(f"{tmp_path}/in") == Extension(0, 0, 0)
