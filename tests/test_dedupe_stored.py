"""Duplicates by fingerprints: the rows of a whole comparison, and what is shuffled for them."""

import pytest
from pyspark.sql import functions as F

from weighlens.operators.labelling import dedupe_stored, dedupe_transactions


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def wide(spark, tmp_path):
    """Rows of about 600 bytes, a third of them copies of one row, some in pairs, the rest once."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.floor(F.col("id") / 100) * 100 + 1).otherwise(F.col("id")).alias("k"))
    # one odd number in a hundred repeats; text follows from the key
    rows = rows.select(F.col("k").cast("string").alias("transaction_id"), *[F.sha2(F.concat(F.lit(str(i)), F.col("k").cast("string")), 256).alias(f"c{i}") for i in range(9)])
    rows.write.parquet(f"{tmp_path}/wide")
    return spark.read.parquet(f"{tmp_path}/wide")


@pytest.mark.parametrize("buckets", [1, 1024])
def test_the_rows_are_those_of_a_whole_comparison(wide, buckets):
    """One bucket of bits for thousands of fingerprints: many rows share a bit with a copy and are kept."""
    assert _rows(dedupe_stored(wide, buckets)) == _rows(dedupe_transactions(wide)) == _rows(wide.distinct())


def test_only_copies_are_shuffled_whole(wide):
    plan = dedupe_stored(wide)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # fingerprints and bitmaps (the same for both halves, so done once when it runs), and one exchange of the rows that have copies
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("c8" in line for line in exchanges) == 1 and len(exchanges) == 5
    copied = wide.count() - wide.groupBy(*wide.columns).count().filter("count = 1").count()
    final = dedupe_stored(wide)
    assert final.count() == wide.distinct().count() and copied < wide.count() // 2


def test_nulls_maps_and_empty_tables(rows):
    kind = "a string, b string, m map<string,int>, x double"
    df = rows([(None, "1", {"k": 1}, 0.0), ("1", None, {"k": 1}, 0.0), (None, "1", {"k": 1}, -0.0), (None, None, None, None), (None, None, None, None)], kind)
    assert dedupe_stored(df).count() == dedupe_transactions(df).count() == 3
    assert dedupe_stored(rows([], kind)).count() == 0
