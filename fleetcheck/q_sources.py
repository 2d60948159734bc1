"""Scans, lookup tables and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetcheck.registry import query
from fleetcheck.tables import AS_OF, Fleet
from weighlens.operators.checks import clean_for_export, flatten_json, flatten_variant
from weighlens.operators.labelling import label_transactions
from weighlens.sinks.logs import append_dataset_log, read_dataset_log, write_dataset_log, write_review_log
from weighlens.sinks.tables import read_report, write_report, write_semicolon_csv
from weighlens.sources import catalogue, clustered, decisions, files, lookups, transactions
from weighlens.storage import shared_dir

_SCAN = ["transaction_id", "transaction_metric", "deployment_id", "transaction_start_time"]

SPEC = {
    "query_body": {
        "query": {"bool": {"must": [
            {"terms": {"transaction_metric.keyword": ["WSPROCESSCOMPLETED03", "WSREFERENCEIMAGEAC01"]}},
            {"terms": {"deployment_id": [3, 11, 17]}},
            {"range": {"transaction_start_time": {"gte": "now-800d/d", "lt": "now+1d/d"}}},
        ]}},
        "sort": [{"transaction_start_time": {"order": "asc"}}],
    },
}


@query("scan_transactions", """
    select transaction_id, transaction_metric, deployment_id, transaction_start_time from {fx_tx}
    where deployment_id = 3 and transaction_start_time >= timestamp '1997-05-11' and transaction_start_time < timestamp '1998-06-16'""")
def _(f: Fleet) -> DataFrame:
    return transactions.scan_transactions(f.raw, 3, AS_OF, 400).select(*_SCAN)


@query("scan_clustered", """
    select transaction_id, transaction_metric, deployment_id, transaction_start_time from {fx_tx}
    where deployment_id = 3 and transaction_start_time >= timestamp '1997-05-11' and transaction_start_time < timestamp '1998-06-16'""")
def _(f: Fleet) -> DataFrame:
    """All transactions written in files of few deployments and days, then a scan that opens some of them."""
    path = shared_dir(f.spark, "clustered")
    clustered.write_clustered(f.raw, path, rows_per_file=max(1, f.raw.count() // 64))
    return clustered.scan_clustered(f.spark, path, f.raw.schema, 3, AS_OF, 400).select(*_SCAN)


@query("scan_from_spec", """
    select transaction_id, transaction_metric, deployment_id, transaction_start_time from {fx_tx}
    where transaction_metric in ('WSPROCESSCOMPLETED03', 'WSREFERENCEIMAGEAC01') and deployment_id in (3, 11, 17)
      and transaction_start_time >= timestamp '1996-04-06' and transaction_start_time < timestamp '1998-06-16'""")
def _(f: Fleet) -> DataFrame:
    return transactions.scan_from_spec(f.raw, SPEC, AS_OF).select(*_SCAN)


@query("scan_with_model_fallback", """
    select transaction_id, deployment_id, model_id, transaction_start_time from {fx_tx}
    where deployment_id = 5 and model_id = 50
      and transaction_start_time >= timestamp '1995-09-19' and transaction_start_time < timestamp '1998-06-16'""")
def _(f: Fleet) -> DataFrame:
    rows = transactions.scan_with_model_fallback(f.raw, f.derived("fx_deployments"), 5, AS_OF, 1000, 999)
    return rows.select(
        "transaction_id", "deployment_id", F.col("transaction_data.model_id").alias("model_id"), "transaction_start_time"
    )


@query("flatten_transactions", """
    select transaction_start_time, transaction_end_time, transaction_id, transaction_metric, deployment_id, device_id, device_name,
           model_id, result_index, result_label_name, selected_reference_code, selected_reference, selected_reference_name,
           selected_reference_index, selected_reference_is_trained, confidence, topk,
           array_to_string(predicted_codes, ',') as codes, array_to_string(predicted_names, ',') as names from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    flat = transactions.flatten_transactions(f.raw)
    lists = {"codes": F.array_join("predicted_codes", ","), "names": F.array_join("predicted_names", ",")}
    return flat.withColumns(lists).drop("time", "predicted_codes", "predicted_names")


@query("flatten_metric_data", """
    select event_id, ts, user_id, event_type, value, cast(json_extract(props, '$.k') as bigint) as k from events""")
def _(f: Fleet) -> DataFrame:
    from pyspark.sql import types as T
    events = f.given("events").withColumnRenamed("props", "metric_data")
    return transactions.flatten_transactions(events, T.StructType([T.StructField("k", T.LongType())]))


@query("scan_references", """
    select reference_id, reference_code, reference_name, label_id, deployment_id from {fx_references} where deployment_id = 7""")
def _(f: Fleet) -> DataFrame:
    return catalogue.scan_references(f.derived("fx_references"), 7)


@query("scan_labels", "select label_id, label_name from {fx_labels}")
def _(f: Fleet) -> DataFrame:
    return catalogue.scan_labels(f.derived("fx_labels"))


@query("scan_model_classes", """
    with good as (select *, case when left(model_data, 1) = '[' then cast(model_data as json) else json_extract(cast(model_data as json), '$.classes') end as doc
                  from {fx_models} where json_valid(model_data)),
         cls as (select model_id, model_code, cast(unnest(range(cast(json_array_length(doc) as bigint))) as int) as class_pos, doc from good),
         lab as (select model_id, model_code, class_pos, json_extract(doc, '$[' || class_pos || ']') as c from cls)
    select model_id, model_code, true as json_ok, class_pos, cast(json_extract(c, '$.index') as int) as class_index,
           json_extract_string(c, '$.index_name') as class_name, cast(p as int) as label_pos, cast(json_extract(c, '$.trained_labels[' || p || ']') as bigint) as label_id
    from (select *, unnest(case when json_array_length(c, '$.trained_labels') = 0 then [null] else range(cast(json_array_length(c, '$.trained_labels') as bigint)) end) as p from lab) x
    union all select model_id, model_code, false, null, null, null, null, null from {fx_models} where not json_valid(model_data)""")
def _(f: Fleet) -> DataFrame:
    return catalogue.scan_model_classes(f.derived("fx_models"))


@query("resolve_model", """
    select r.deployment_id, coalesce(r.model_id, d.model_id) as model_id, case when r.model_id is null then 'deployment' else 'argument' end as source,
           case when r.model_id is null and d.deployment_id is null then 'unknown_deployment'
                when r.model_id is null and d.model_id is null then 'no_model' else 'ok' end as status,
           coalesce((select string_agg(cast(o.deployment_id as string), ',' order by o.deployment_id) from {fx_deployments} o
                     where r.model_id = o.model_id and r.deployment_id <> o.deployment_id), '') as conflicts
    from (select cast(c_custkey as int) as deployment_id, case when c_mktsegment = 'BUILDING' then c_nationkey * 10 end as model_id from customer) r
         left join {fx_deployments} d on r.deployment_id = d.deployment_id""")
def _(f: Fleet) -> DataFrame:
    requests = f.given("customer").select(
        F.col("c_custkey").cast("int").alias("deployment_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") * 10).alias("model_id"),
    )
    resolved = catalogue.resolve_model(f.derived("fx_deployments"), requests)
    return resolved.withColumn("conflicts", F.array_join("conflict_deployment_ids", ",")).drop("conflict_deployment_ids")


@query("lookup_folders", """
    select transaction_id, folder_url, folder_files from {fx_folders} where transaction_id in (select transaction_id from {fx_used})""")
def _(f: Fleet) -> DataFrame:
    return lookups.folders_of(f.derived("fx_used"), f.derived("fx_folders"))


@query("lookup_folder_urls", """
    select t.transaction_id, d.folder_url from {fx_tx} t left join {fx_folders} d on t.transaction_id = d.transaction_id
    where t.transaction_id in (select transaction_id from {fx_used})""")
def _(f: Fleet) -> DataFrame:
    return lookups.lookup_folder_urls(f.derived("fx_used"), f.tx, f.derived("fx_folders"))


@query("read_semicolon_csv", """
    select transaction_id, folder_url, folder_files from {fx_folders}""")
def _(f: Fleet) -> DataFrame:
    path = shared_dir(f.spark, "csv")
    write_semicolon_csv(f.derived("fx_folders"), path)
    return lookups.read_semicolon_csv(f.spark, path, "transaction_id string, folder_url string, folder_files string")


@query("load_valid_pairs", "select deployment_id, result_index, code, valid from {fx_pairs}")
def _(f: Fleet) -> DataFrame:
    return f.pairs


@query("load_product_descriptions", "select deployment_id, label_index, label_name from {fx_descriptions}")
def _(f: Fleet) -> DataFrame:
    return f.descriptions


@query("load_activations", "select device_id, activated_at from {fx_activations}")
def _(f: Fleet) -> DataFrame:
    return f.activations


def with_links(f: Fleet) -> DataFrame:
    from weighlens.operators.images import add_image_info
    return add_image_info(f.tx, f.derived("fx_folders"))


@query("load_cached_transactions", """
    select transaction_id, selected_reference_code, image_link from {fx_images}
    where selected_reference_code is not null and image_link <> ''""")
def _(f: Fleet) -> DataFrame:
    return lookups.load_cached_transactions(with_links(f)).select("transaction_id", "selected_reference_code", "image_link")


@query("load_review_transactions", """
    select transaction_id, image_link, case when image_link <> '' then 1 else 0 end as has_image from {fx_images}""")
def _(f: Fleet) -> DataFrame:
    return lookups.load_review_transactions(with_links(f)).select("transaction_id", "image_link", "has_image")


@query("load_decisions", """
    select 'product_review' as kind, reference_code as key from {fx_decisions} where lower(trim(revisar_imagenes)) in ('si', 'sí', 'yes', 'y')
    union all select 'product_dataset', reference_code from {fx_decisions} where lower(trim(incluir_dataset)) in ('si', 'sí')
    union all select 'device_review', device_name from {fx_device_decisions} where lower(trim(revisar_imagenes)) in ('si', 'sí', 'yes', 'y')
    union all select 'device_dataset', cast(cast(device_id as bigint) as string) from {fx_device_decisions} where lower(trim(incluir_dataset)) in ('si', 'sí')""")
def _(f: Fleet) -> DataFrame:
    products, devices = f.derived("fx_decisions"), f.derived("fx_device_decisions")

    def rows(df: DataFrame, kind: str, key: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"))

    return (
        rows(decisions.marked_for_review(products), "product_review", "reference_code")
        .unionByName(rows(decisions.marked_for_dataset(products), "product_dataset", "reference_code"))
        .unionByName(rows(decisions.marked_for_review(devices), "device_review", "device_name"))
        .unionByName(rows(decisions.allowed_devices(devices), "device_dataset", "device_id"))
    )


@query("list_image_files", """
    select 'class=' || class || '/label_id=' || label_id as folder, sum(strlen(filename) + 1)::bigint as length from {fx_files} group by class, label_id""")
def _(f: Fleet) -> DataFrame:
    """One text file per class and label stands for its images: their names, a line each; two folder levels."""
    path = shared_dir(f.spark, "set")
    named = f.derived("fx_files").select("class", "label_id", F.col("filename").alias("value"))
    named.repartition("class", "label_id").write.partitionBy("class", "label_id").text(path)
    found = files.list_image_files(f.spark, path, (".TXT",))
    return found.select(F.regexp_extract("path", "(class=.*)/[^/]*$", 1).alias("folder"), "length")


@query("write_report", """
    select kind || '_' || table_name as table_name, key, value from (
        select 'labels' as table_name, cast(label_id as string) as key, label_name as value from {fx_labels}
        union all select 'folders', transaction_id, coalesce(folder_url, '') from {fx_folders}) a, (select unnest(['parquet', 'csv']) as kind) b""")
def _(f: Fleet) -> DataFrame:
    folder = shared_dir(f.spark, "report")
    write_report(
        {"labels": f.derived("fx_labels"), "folders": f.derived("fx_folders")}, folder,
        sort={"labels": [F.col("label_name")]}, csv_copy=True,
    )
    def rows(df: DataFrame, name: str, key: str, value: str) -> DataFrame:
        return df.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"), F.coalesce(value, F.lit("")).alias("value"))

    labels, folders = ("label_id", "label_name"), ("transaction_id", "folder_url")
    return (
        rows(read_report(f.spark, folder, "labels"), "parquet_labels", *labels)
        .unionByName(rows(read_report(f.spark, folder, "folders"), "parquet_folders", *folders))
        .unionByName(rows(lookups.read_semicolon_csv(f.spark, f"{folder}/labels_csv", "label_id bigint, label_name string"), "csv_labels", *labels))
        .unionByName(rows(lookups.read_semicolon_csv(
            f.spark, f"{folder}/folders_csv", "transaction_id string, folder_url string, folder_files string"), "csv_folders", *folders))
    )


@query("write_semicolon_csv", """
    select label_id, label_name from {fx_labels} union all select label_id + 1000000, label_name from {fx_labels}""")
def _(f: Fleet) -> DataFrame:
    path = shared_dir(f.spark, "csv")
    labels = f.derived("fx_labels")
    write_semicolon_csv(labels, path)
    write_semicolon_csv(labels.withColumn("label_id", F.col("label_id") + 1000000), path, append=True)
    return lookups.read_semicolon_csv(f.spark, path, "label_id bigint, label_name string")


_LOG = """select reference_name, clase_name, label_id, transaction_id, transaction_start_time, device_id, s3_key, local_path, download_status,
    error_reason, dataset_folder, motivo_descarga,
    case when motivo_descarga = 'device' then cast(device_id as string) else valor_motivo end as valor_motivo, 'crear_dataset' as origen, '' as dataset_original, """


@query("append_dataset_log", _LOG + "'' as relative_folder from {fx_log} union all " + _LOG + """
    clase_name || '/' || cast(label_id as string) from (select * replace (regexp_extract(local_path, '^out/([^/]*)', 1) as dataset_folder) from {fx_log}) x""")
def _(f: Fleet) -> DataFrame:
    log = f.derived("fx_log")
    return append_dataset_log(log, log.withColumn("dataset_folder", F.regexp_extract("local_path", "^out/([^/]*)", 1)))


@query("write_dataset_log", _LOG + "'' as relative_folder from {fx_log} union all " + _LOG + """
    clase_name || '/' || cast(label_id as string) from (select * replace (regexp_extract(local_path, '^out/([^/]*)', 1) as dataset_folder) from {fx_log}) x""")
def _(f: Fleet) -> DataFrame:
    """Two runs append to one folder; the whole log is read back."""
    log, path = f.derived("fx_log"), shared_dir(f.spark, "log")
    write_dataset_log(log, path)
    write_dataset_log(log.withColumn("dataset_folder", F.regexp_extract("local_path", "^out/([^/]*)", 1)), path)
    return read_dataset_log(f.spark, path)


def _review_log(f: Fleet) -> DataFrame:
    return f.derived("fx_log").select(
        "reference_name", F.col("clase_name").alias("product_name"),
        F.when(F.col("motivo_descarga") == "device", "device").otherwise("clase_principal").alias("product_type"),
        "download_status", "transaction_id", F.concat(F.col("device_id").cast("string"), F.lit(".0")).alias("device_id"),
        F.lit("name").alias("device_name"), F.lit("label").alias("result_label_name"), "s3_key", "local_path",
    )


@query("write_review_log", """
    select case when motivo_descarga = 'device' then 'devices_imagenes_bajadas' else 'revisar_imagenes_bajadas' end as log_table,
           reference_name, clase_name as product_name, case when motivo_descarga = 'device' then 'device' else 'clase_principal' end as product_type,
           download_status, transaction_id, case when motivo_descarga = 'device' then cast(device_id as string) else cast(device_id as string) || '.0' end as device_id,
           'name' as device_name, 'label' as result_label_name, s3_key, local_path
    from {fx_log}""")
def _(f: Fleet) -> DataFrame:
    """Both log tables, written and read back."""
    written = write_review_log(_review_log(f), shared_dir(f.spark, "review-log"))
    parts = [
        f.spark.read.parquet(path).withColumns({"log_table": F.lit(n), "device_id": F.col("device_id").cast("string")})
        for n, path in written.items()
    ]
    return parts[0].unionByName(parts[1])


@query("clean_for_export", """
    select transaction_id, coalesce(selected_reference_code, '') as selected_reference_code, coalesce(result_index, 0) as result_index,
           coalesce('[' || '"' || array_to_string(predicted_codes, '","') || '"' || ']', '') as predicted_codes,
           case when confidence = 'LOW' then 0.0 else 1e0 / 4 end as ratio, confidence as text
    from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    odd = f.tx.select(
        "transaction_id", "selected_reference_code", "result_index", "predicted_codes",
        F.when(F.col("confidence") == "LOW", F.lit(float("inf"))).otherwise(F.lit(0.25)).alias("ratio"),
        F.concat(F.lit("\x00"), "confidence", F.lit("�")).alias("text"),
    )
    return clean_for_export(odd)


@query("flatten_json", """
    select event_id, cast(json_extract(props, '$.k') as bigint) as props_k from events""")
def _(f: Fleet) -> DataFrame:
    return flatten_json(f.given("events").select("event_id", "props"), "props", "struct<k:bigint>")


@query("flatten_variant", """
    select event_id, cast(json_extract(props, '$.k') as bigint) as props_k from events""")
def _(f: Fleet) -> DataFrame:
    """The keys and their types found in the data."""
    flat = flatten_variant(f.given("events").select("event_id", "props"), "props")
    return flat.withColumn("props_k", F.col("props_k").cast("bigint"))


@query("label_transactions", """
    select transaction_id, transaction_start_time, "Date", "time", Result, Ok, No_result, Error, Result_modelo, Ok_modelo from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    return label_transactions(f.raw).select(
        "transaction_id", "transaction_start_time", "Date", "time", "Result", "Ok", "No_result", "Error", "Result_modelo", "Ok_modelo")
