"""Row-level labels and features of transactions: projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.functions.bitmaps import BITS, bit_is_set
from weighlens.functions.quality import flag, is_client, metric_class, model_result, result_class, topk_class
from weighlens.schemas import LONG_LIST, USER_METRIC, column_or, is_false, is_true, require, with_missing
from weighlens.sources.transactions import flatten_transactions, normalize_times


def add_result_class(tx: DataFrame) -> DataFrame:
    """``Result`` and its three 0-1 flags."""
    confidence = column_or(tx, "confidence", F.lit(None).cast("string"))
    topk = column_or(tx, "topk", F.lit(None).cast("bigint"))
    result = result_class(confidence, topk)
    return tx.withColumns({
        "Result": result,
        "Ok": flag(result == "Ok"),
        "No_result": flag(result == "No_result"),
        "Error": flag(result == "Error"),
    })


def add_model_result(tx: DataFrame) -> DataFrame:
    """``Result_modelo`` and ``Ok_modelo``."""
    tx = with_missing(tx, {
        "selected_reference_is_trained": "boolean", "result_index": "int", "selected_reference_index": "int",
    })
    verdict = model_result(
        F.col("transaction_metric"),
        is_true(tx, "selected_reference_is_trained"), is_false(tx, "selected_reference_is_trained"),
        F.col("result_index"), F.col("selected_reference_index"),
    )
    return tx.withColumns({"Result_modelo": verdict, "Ok_modelo": flag(verdict == "SUCCESS")})


def label_transactions(raw: DataFrame) -> DataFrame:
    """Raw transactions to flat, labelled ones: one projection over the scan."""
    return add_model_result(add_result_class(normalize_times(flatten_transactions(raw))))


def add_metric_class(tx: DataFrame) -> DataFrame:
    return tx.withColumn("metric_class", metric_class(F.col("transaction_metric")))


def client_rows(tx: DataFrame) -> DataFrame:
    return tx.filter(is_client(F.col("transaction_metric")))


def filter_by_transaction_type(tx: DataFrame, mode: str = "ambas") -> DataFrame:
    """Review filter: 'cliente' is the user metric alone, 'manuales' everything else, 'ambas' all."""
    user = F.coalesce(F.col("transaction_metric") == USER_METRIC, F.lit(False))
    if mode == "cliente":
        return tx.filter(user)
    return tx.filter(~user) if mode == "manuales" else tx


def add_candidate_features(tx: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Length of the candidate list and its long / single flags."""
    require(tx, "predicted_codes")
    n = F.coalesce(F.size("predicted_codes"), F.lit(0))
    n = F.when(n < 0, F.lit(0)).otherwise(n)
    return tx.withColumns({
        "num_candidatos": n,
        "lista_larga": flag(n > long_list),
        "lista_un_candidato": flag(n == 1),
    })


def add_topk_class(tx: DataFrame) -> DataFrame:
    """Class of the chosen list position and its three flags; blanks without such a column."""
    name = next((c for c in ("top_k", "topk") if c in tx.columns), None)
    chosen = topk_class(F.col(name)) if name else F.lit("")
    return tx.withColumns({
        "pos_candidato_elegido": chosen,
        **{c: flag(chosen == c) for c in ("top_k_0", "top_k_medio", "top_k_alto")},
    })


def add_is_trained(tx: DataFrame) -> DataFrame:
    if "selected_reference_is_trained" not in tx.columns:
        return tx.withColumn("is_trained", F.lit(0))
    text = F.col("selected_reference_is_trained").cast("string")
    return tx.withColumn("is_trained", flag(text.isin("true", "True", "1", "1.0")))


def add_model_ok_general_fail(tx: DataFrame) -> DataFrame:
    """1 where the model was right and the system as a whole wrong."""
    name = next((c for c in ("Ok_modelo", "ok_modelo") if c in tx.columns), None)
    if name is None or "Result" not in tx.columns:
        return tx.withColumn("model_ok_general_fail", F.lit(0))
    return tx.withColumn(
        "model_ok_general_fail", flag((F.col(name) == 1) & (F.col("Result") == "Error"))
    )


def dedupe_transactions(tx: DataFrame) -> DataFrame:
    """Drop fully equal rows; maps and variants, which have no equality, compare by their JSON."""
    opaque = [f.name for f in tx.schema.fields if f.dataType.typeName() in ("map", "variant")]
    if not opaque:
        return tx.dropDuplicates()
    keyed = tx.withColumns({f"_json_{c}": F.to_json(c) for c in opaque})
    keys = [c for c in keyed.columns if c not in opaque]
    return keyed.dropDuplicates(keys).drop(*[f"_json_{c}" for c in opaque])


def dedupe_stored(tx: DataFrame, buckets: int = 1024) -> DataFrame:
    """``dedupe_transactions`` for wide rows that are read from files, without shuffling those that have no copy.

    Fingerprints of 64 bits are counted; bitmaps (``buckets`` times 4 KB, whatever the data) mark the bits of those met more than
    once.  Copies of a row share its bit, so rows at an unmarked bit are unique and stay where they are; rows at a marked one are
    compared whole.  Rows that share a bit by chance are compared too, and kept.  The input is scanned three times.
    """
    opaque = {f.name for f in tx.schema.fields if f.dataType.typeName() in ("map", "variant")}
    values = [F.to_json(c) if c in opaque else F.col(c) for c in tx.columns]
    # a hash passes over NULLs, so it also takes in where they are
    mark = F.xxhash64(*values, *[v.isNull() for v in values])
    places = {"_bucket": F.pmod(F.floor(F.col("_mark") / BITS), F.lit(buckets)).cast("int"), "_bit": F.pmod("_mark", F.lit(BITS)).cast("int")}
    repeated = tx.select(mark.alias("_mark")).groupBy("_mark").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    marks = repeated.withColumns(places).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    met = tx.withColumn("_mark", mark).withColumns(places).join(F.broadcast(marks), "_bucket", "left")
    copied = F.coalesce(bit_is_set(F.col("_bitmap"), F.col("_bit")), F.lit(False))
    return met.filter(~copied).select(*tx.columns).unionByName(dedupe_transactions(met.filter(copied).select(*tx.columns)))
