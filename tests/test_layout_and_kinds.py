"""Clustered files: what a scan opens.  JSON of unknown keys: kinds found in the data."""

import json
from datetime import datetime

from pyspark.sql import functions as F, types as T

from weighlens.operators.checks import flatten_variant, json_kind
from weighlens.sources.clustered import files_to_read, scan_clustered, write_clustered
from weighlens.sources.transactions import flatten_transactions, scan_transactions

AS_OF = datetime(2024, 6, 20, 9, 0)


def _fleet(spark, n=40_000):
    """Forty deployments and 400 days; a third of all rows is of deployment 7."""
    of = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(40)))
    day = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(400)).cast("int")
    start = F.date_sub(F.lit("2024-06-20").cast("date"), day).cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("WSPROCESSCOMPLETED03").alias("transaction_metric"),
        F.when(F.col("id") % 1000 != 1, of).alias("deployment_id"), F.when(F.col("id") % 1000 != 2, start).alias("transaction_start_time"),
        F.lit(1).alias("model_id"))


def test_a_scan_opens_few_files_and_loses_no_row(spark, tmp_path):
    tx = _fleet(spark)
    files = write_clustered(tx, f"{tmp_path}/c", rows_per_file=400)
    assert 80 <= files <= 100
    assert spark.read.parquet(f"{tmp_path}/c/data").exceptAll(tx).count() == 0 and spark.read.parquet(f"{tmp_path}/c/data").count() == 40_000
    assert spark.read.parquet(f"{tmp_path}/c/ranges").agg(F.max("row_count")).first()[0] <= 1000  # the hot deployment is cut
    for deployment in (3, 7, 39):
        for days in (0, 3, 30):
            got = scan_clustered(spark, f"{tmp_path}/c", tx.schema, deployment, AS_OF, days)
            want = scan_transactions(tx, deployment, AS_OF, days)
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()
            assert len(files_to_read(spark, f"{tmp_path}/c", deployment, AS_OF, days)) <= files // 8
    assert scan_clustered(spark, f"{tmp_path}/c", tx.schema, 99, AS_OF).count() == 0


def test_clustered_empty_table(spark, tmp_path):
    tx = _fleet(spark).limit(0)
    write_clustered(tx, f"{tmp_path}/c")
    assert scan_clustered(spark, f"{tmp_path}/c", tx.schema, 7, AS_OF).count() == 0


def test_kinds_come_from_the_data(rows):
    texts = [
        '{"a": 1, "b": {"c": true, "d": "x"}, "l": [1, 2], "o": [{"k": 1}, {"k": 2}], "m": 1}',
        '{"a": 20000000000, "b": {"e": 1.5}, "m": "one", "OBJECT<": 3}', "no json", None, '{"n": null}', "[1]"]
    df = rows([(i, t) for i, t in enumerate(texts[:5])], "id int, j string")
    kind = {f.name: f.dataType for f in json_kind(df, "j").fields}
    assert kind["a"] == T.LongType() and kind["m"] == T.StringType() and kind["l"] == T.ArrayType(T.LongType())
    assert {f.name for f in kind["b"].fields} == {"c", "d", "e"}
    got = {r["id"]: r.asDict() for r in flatten_variant(df, "j").collect()}
    assert got[0]["j_a"] == 1 and got[0]["j_b_c"] is True and got[0]["j_l"] == "1, 2" and got[0]["j_o_1_k"] == 2 and got[0]["j_m"] == "1"
    assert got[1]["j_a"] == 20_000_000_000 and float(got[1]["j_b_e"]) == 1.5 and got[1]["j_m"] == "one" and got[1]["j_OBJECT<"] == 3
    assert all(v is None for k, v in got[2].items() if k != "id") and got[3]["j_a"] is None
    mixed = rows([(i, t) for i, t in enumerate(texts)], "id int, j string")
    assert json_kind(mixed, "j") == T.StringType()
    assert json.loads(flatten_variant(mixed, "j").filter("id = 5").first()["j"]) == [1]
    assert flatten_variant(df.limit(0), "j").count() == 0


def test_undeclared_keys_keep_their_kinds(rows):
    text = '{"model_id": 4, "extra": {"deep": [1, 2.5]}, "count": 7, "none": null}'
    tx = rows([("1", text), ("2", None)], "transaction_id string, transaction_data string")
    flat = flatten_transactions(tx, other_keys="rest", typed=True)
    kinds = flat.select("transaction_id", F.explode("rest").alias("k", "v")).select(
        "k", F.schema_of_variant("v").alias("kind"), F.try_variant_get("v", "$.deep[1]", "double").alias("deep"))
    got = {r.k: (r.kind, r.deep) for r in kinds.collect()}
    assert set(got) == {"extra", "count", "none"} and got["count"][0] == "BIGINT" and got["extra"][1] == 2.5
    assert flat.filter("transaction_id = '2'").first()["rest"] is None
