"""Row-level operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetcheck.registry import query
from fleetcheck.q_sources import with_links
from fleetcheck.tables import Fleet
from weighlens.functions import codes, paths
from weighlens.operators import checks, devices, images, labelling, models, pairs, references, reports
from weighlens.sources.transactions import flatten_transactions, normalize_times
from weighlens.storage import shared_dir


@query("normalize_times", """
    select transaction_id, transaction_start_time, transaction_end_time, "Date", "time" from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    text = flatten_transactions(f.raw).withColumns({
        "transaction_start_time": F.concat(F.col("transaction_start_time").cast("string"), F.lit(".75")),
        "transaction_end_time": F.col("transaction_end_time").cast("string"),
    })
    return normalize_times(text).select("transaction_id", "transaction_start_time", "transaction_end_time", "Date", "time")


@query("result_class", "select transaction_id, Result, Ok, No_result, Error from {fx_tx}")
def _(f: Fleet) -> DataFrame:
    return labelling.add_result_class(flatten_transactions(f.raw)).select("transaction_id", "Result", "Ok", "No_result", "Error")


@query("model_result", "select transaction_id, Result_modelo, Ok_modelo from {fx_tx}")
def _(f: Fleet) -> DataFrame:
    return labelling.add_model_result(flatten_transactions(f.raw)).select("transaction_id", "Result_modelo", "Ok_modelo")


@query("classify_metric", """
    select transaction_id, case when is_client then 'client' when is_manual then 'manual' else 'other' end as metric_class from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    return labelling.add_metric_class(f.tx).select("transaction_id", "metric_class")


@query("filter_by_transaction_type", """
    select 'cliente' as mode, transaction_id from {fx_tx} where transaction_metric = 'GFRSUSERPROCESSCOM03'
    union all select 'manuales', transaction_id from {fx_tx} where transaction_metric <> 'GFRSUSERPROCESSCOM03'
    union all select 'ambas', transaction_id from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    parts = [labelling.filter_by_transaction_type(f.tx, m).select(F.lit(m).alias("mode"), "transaction_id")
             for m in ("cliente", "manuales", "ambas")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("candidate_list_features", """
    select transaction_id, cast(coalesce(len(predicted_codes), 0) as int) as num_candidatos,
           case when len(predicted_codes) > 6 then 1 else 0 end as lista_larga, case when len(predicted_codes) = 1 then 1 else 0 end as lista_un_candidato
    from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    return labelling.add_candidate_features(f.tx).select("transaction_id", "num_candidatos", "lista_larga", "lista_un_candidato")


@query("topk_class", """
    select transaction_id, p as pos_candidato_elegido, case when p = 'top_k_0' then 1 else 0 end as top_k_0,
           case when p = 'top_k_medio' then 1 else 0 end as top_k_medio, case when p = 'top_k_alto' then 1 else 0 end as top_k_alto
    from (select transaction_id, case when topk is null or topk = -1 then 'NO_CLASIFICADO' when topk = 0 then 'top_k_0'
                                      when topk between 1 and 4 then 'top_k_medio' else 'top_k_alto' end as p from {fx_tx}) a""")
def _(f: Fleet) -> DataFrame:
    return labelling.add_topk_class(f.tx).select("transaction_id", "pos_candidato_elegido", "top_k_0", "top_k_medio", "top_k_alto")


@query("is_trained_flag", "select transaction_id, cast(trained as int) as is_trained from {fx_tx}")
def _(f: Fleet) -> DataFrame:
    return labelling.add_is_trained(f.tx).select("transaction_id", "is_trained")


@query("model_ok_general_fail", """
    select transaction_id, case when Ok_modelo = 1 and Result = 'Error' then 1 else 0 end as model_ok_general_fail from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    return labelling.add_model_ok_general_fail(f.tx).select("transaction_id", "model_ok_general_fail")


_PAIR = """left join {fx_pairs} p on cast(t.deployment_id as string) = p.deployment_id and t.result_index = p.result_index
    and cast(cast(t.selected_reference_code as bigint) as string) = p.code"""


@query("validate_pair", """
    select t.transaction_id, case when p.valid then 'Válida' else 'No válida' end as validacion, p.valid is not null as pareja_en_fichero_ref
    from {fx_tx} t """ + _PAIR)
def _(f: Fleet) -> DataFrame:
    return pairs.validate_pair(f.tx, f.pairs).select("transaction_id", "validacion", "pareja_en_fichero_ref")


@query("normalize_code", """
    select c as code, case when regexp_full_match(trim(c), '[+-]?[0-9]+') then cast(cast(trim(c) as bigint) as string) else trim(c) end as normal
    from (select unnest([reference_code, ' ' || reference_code, reference_name, cast(reference_id as string) || '.0', '+' || reference_code]) as c
          from {fx_references}) a""")
def _(f: Fleet) -> DataFrame:
    refs = f.catalogue
    variants = F.array(
        "reference_code", F.concat(F.lit(" "), "reference_code"), "reference_name",
        F.concat(F.col("reference_id").cast("string"), F.lit(".0")), F.concat(F.lit("+"), "reference_code"))
    return refs.select(F.explode(variants).alias("code")).withColumn("normal", codes.normalize_code(F.col("code")))


@query("pair_similarity_features", """
    select t.transaction_id, cast(n as int) as num_candidatos, cast(bad as int) as num_referencias_no_similares, cast(n - bad as int) as num_referencias_similares,
           case when bad = 0 and n > 0 then 1 else 0 end as lista_similar_completa, case when p.valid then 1 else 0 end as producto_seleccionado_similar
    from (select t.*, coalesce(len(predicted_codes), 0) as n, coalesce(len(predicted_codes), 0) - coalesce(good, 0) as bad
          from {fx_tx} t left join (select x.transaction_id, count(*) as good
                from (select transaction_id, deployment_id, result_index, unnest(predicted_codes) as code from {fx_tx}) x
                     join {fx_pairs} p on cast(x.deployment_id as string) = p.deployment_id and x.result_index = p.result_index
                          and cast(cast(x.code as bigint) as string) = p.code
                where p.valid group by 1) g on t.transaction_id = g.transaction_id) t """ + _PAIR)
def _(f: Fleet) -> DataFrame:
    return pairs.add_pair_similarity(labelling.add_candidate_features(f.tx), f.pairs).select(
        "transaction_id", "num_candidatos", "num_referencias_no_similares", "num_referencias_similares",
        "lista_similar_completa", "producto_seleccionado_similar")


@query("device_status", """
    select t.transaction_id, case when a.device_id is not null and t.transaction_start_time >=
             coalesce(a.activated_at, (select min(transaction_start_time) - interval 1 month from {fx_tx})) then 'Encendido' else 'Silencioso' end as estado_dispositivo
    from {fx_tx} t left join {fx_activations} a on cast(t.device_id as string) = a.device_id""")
def _(f: Fleet) -> DataFrame:
    return devices.add_device_status(f.tx, f.activations).select("transaction_id", "estado_dispositivo")


@query("activation_label", """
    select t.transaction_id, case when a.device_id is null then 'No en archivo' when a.activated_at is null then 'Sin fecha'
             else strftime(a.activated_at, '%Y-%m-%d') end as fecha_encendido
    from {fx_tx} t left join {fx_activations} a on cast(t.device_id as string) = a.device_id""")
def _(f: Fleet) -> DataFrame:
    return devices.add_activation_label(f.tx, f.activations).select("transaction_id", "fecha_encendido")


@query("parse_folder_files", """
    select transaction_id, case when left(folder_files, 2) = '[''' then replace(folder_files[3:-3], ''', ''', '|') else '' end as files,
           cast(case when left(folder_files, 2) = '[''' then len(string_split(folder_files, ', ')) else 0 end as int) as n from {fx_folders}""")
def _(f: Fleet) -> DataFrame:
    listed = images.folder_file_list(F.col("folder_files"))
    return f.derived("fx_folders").select("transaction_id", F.array_join(listed, "|").alias("files"), F.size(listed).alias("n"))


@query("image_info", "select transaction_id, has_image, cast(num_images as int) as num_images, image_link from {fx_images}")
def _(f: Fleet) -> DataFrame:
    return with_links(f).select("transaction_id", "has_image", "num_images", "image_link")


@query("clean_image_link", """
    select transaction_id, case when image_url is null or lower(image_url) in ('', 'none', 'null') then null
                                else regexp_replace(trim(image_url), '^/+', '') end as key,
           coalesce(regexp_matches(lower(image_url), '\\.(jpg|jpeg|png|gif|bmp|webp)$'), false) as is_file
    from (select transaction_id, trim(trim(trim(image_path), '"'), '''') as image_url from
          (select transaction_id, case when image_path = 'p/q' then '''None''' else ' "/' || thumb_image_url || '"' end as image_path from {fx_urls}) a) b""")
def _(f: Fleet) -> DataFrame:
    link = F.when(F.col("image_path") == "p/q", F.lit("'None'")).otherwise(F.concat(F.lit(' "/'), "thumb_image_url", F.lit('"')))
    rows = f.derived("fx_urls").select("transaction_id", link.alias("link"))
    key = paths.clean_image_link(F.col("link"))
    return rows.select("transaction_id", key.alias("key"), paths.has_extension(key).alias("is_file"))


@query("normalize_device_id", """
    select device_id, case when try_cast(device_id as double) is not null then cast(cast(try_cast(device_id as double) as bigint) as string) else trim(device_id) end as normal
    from (select unnest([device_id, trim(device_id), 'dev ' || trim(device_id) || ' ']) as device_id from {fx_activations_raw}) a""")
def _(f: Fleet) -> DataFrame:
    variants = F.array("device_id", F.trim("device_id"), F.concat(F.lit("dev "), F.trim("device_id"), F.lit(" ")))
    return f.derived("fx_activations_raw").select(F.explode(variants).alias("device_id")).withColumn(
        "normal", codes.normalize_device_id(F.col("device_id")))


@query("normalize_yes_no", """
    select reference_code, case when revisar_imagenes in ('si', 'sí', 'True', 'true', '1') then 'si' else 'no' end as review,
           case when incluir_dataset in ('si', 'sí', 'True', 'true', '1') then 'si' else 'no' end as include,
           case when label_id > 5 then 'si' else 'no' end as flag from {fx_decisions}""")
def _(f: Fleet) -> DataFrame:
    return f.derived("fx_decisions").select(
        "reference_code", codes.normalize_yes_no(F.col("revisar_imagenes")).alias("review"),
        codes.normalize_yes_no(F.col("incluir_dataset")).alias("include"),
        codes.normalize_yes_no(F.col("label_id") > 5).alias("flag"))


@query("decision_columns", """
    select reference_code, case when num_cliente >= 8 then 'si' else 'no' end as incluir_dataset, 'devices_seleccionados' as devices_incluir,
           case when num_cliente >= 8 then 150 end as num_imagenes_dataset, case when num_cliente >= 8 then producto_trained end as producto_a_entrenar,
           case when num_cliente >= 8 then label_id end as label_considerar, 'no' as revisar_imagenes from {fx_analysed}""")
def _(f: Fleet) -> DataFrame:
    return reports.decision_columns(analysed(f), 8).select(
        "reference_code", "incluir_dataset", "devices_incluir", "num_imagenes_dataset", "producto_a_entrenar", "label_considerar", "revisar_imagenes")


def analysed(f: Fleet) -> DataFrame:
    known = references.references_with_model(
        references.references_with_labels(f.catalogue, f.derived("fx_labels")), f.derived("fx_classes"))
    return references.reference_metrics(f.tx, known, models.active_model(f.tx))


@query("device_decision_columns", """
    select device_id, device_name, num_cliente, num_manual, pct_ok_sistema, pct_ok_modelo, 'no' as revisar_imagenes,
           cast(first_transaction_date as date) as first_transaction_date, 'si' as incluir_dataset, 0 as num_imagenes_dataset_adicionales from {fx_devices}""")
def _(f: Fleet) -> DataFrame:
    return devices.device_decision_columns(devices.device_metrics(f.tx, models.active_model(f.tx)))


@query("dataset_filename", """
    select t.transaction_id, strftime(transaction_start_time, '%Y%m%d%H%M%S') || '_' || t.transaction_id || '_' || name as filename
    from (select u.*, case when thumb_image_url is null then 'image.jpg' when thumb_image_url = 'thumb/none' then 'none.jpg'
                 else regexp_extract(thumb_image_url, '([^/]*)$', 1) end as name from {fx_urls} u) t""")
def _(f: Fleet) -> DataFrame:
    name = paths.dataset_filename(F.col("transaction_start_time"), F.col("transaction_id"), F.col("thumb_image_url"))
    return f.derived("fx_urls").select("transaction_id", name.alias("filename"))


@query("parse_dataset_filename", """
    select dataset, filename, coalesce(string_split(filename, '_')[2], '') as transaction_id from
    (select dataset, unnest([filename, replace(filename, '_', '-')]) as filename from {fx_files}) a""")
def _(f: Fleet) -> DataFrame:
    both = F.explode(F.array("filename", F.replace(F.col("filename"), F.lit("_"), F.lit("-"))))
    return f.derived("fx_files").select("dataset", both.alias("filename")).withColumn(
        "transaction_id", paths.filename_transaction_id(F.col("filename")))


@query("relative_folder", """
    select transaction_id, case when dataset_folder = 'a' then '' else clase_name || '/' || cast(label_id as string) end as inside, '.' as at_top
    from {fx_log}""")
def _(f: Fleet) -> DataFrame:
    log = f.derived("fx_log")
    folder = F.when(F.col("dataset_folder") == "a", F.lit("a")).otherwise(F.regexp_extract("local_path", "^out/([^/]*)", 1))
    return log.select(
        "transaction_id", paths.relative_folder(F.col("local_path"), folder).alias("inside"),
        paths.relative_folder(F.col("local_path"), F.col("label_id").cast("string")).alias("at_top"))


@query("sanitize_path", """
    select reference_code, concat_ws('/', regexp_replace(trim(reference_name), '[^a-zA-Z0-9_.-]', '_', 'g'), nullif(regexp_replace(trim(label_id), '[^a-zA-Z0-9_.-]', '_', 'g'), '')) as folder,
           reference_name || ' ñ' as shown
    from {fx_references}""")
def _(f: Fleet) -> DataFrame:
    refs = f.catalogue
    shown = paths.safe_name(F.concat("reference_name", F.lit(" (ñ) /?")))
    return refs.select(
        "reference_code", paths.target_folder(F.col("reference_code"), [F.col("reference_name"), F.col("label_id")]).alias("folder"),
        shown.alias("shown"))


@query("image_extension", """
    select transaction_id, '.png' as ext_url, '.jpg' as ext_thumb, case when image_path like '%.jpeg' then '.jpeg' else '.jpg' end as ext_path from {fx_urls}""")
def _(f: Fleet) -> DataFrame:
    return f.derived("fx_urls").select(
        "transaction_id", paths.image_extension(F.col("image_url")).alias("ext_url"),
        paths.image_extension(F.col("thumb_image_url")).alias("ext_thumb"), paths.image_extension(F.col("image_path")).alias("ext_path"))


@query("label_placeholder", """
    select reference_code, l.label_id, case when l.label_id is null then 'NO_LABEL_ASSIGNED'
           else coalesce(b.label_name, 'LABEL_ID_' || cast(l.label_id as string) || '_NOT_FOUND') end as label_name
    from {fx_label_of_reference} l left join {fx_labels} b on l.label_id = b.label_id""")
def _(f: Fleet) -> DataFrame:
    return references.add_label_placeholder(f.catalogue, f.derived("fx_labels")).select("reference_code", "label_id", "label_name")


@query("parse_storage_uri", """
    select dataset_name, 'sets' as bucket, regexp_extract(s3_path, '^s3://[^/]*/([^#?]*)', 1) as key from {fx_registry}""")
def _(f: Fleet) -> DataFrame:
    uri = F.col("s3_path")
    return f.derived("fx_registry").select("dataset_name", paths.storage_bucket(uri).alias("bucket"), paths.storage_key(uri).alias("key"))


@query("validate_decisions", """
    select reference_code, trim(producto_a_entrenar) as class, try_cast(label_considerar as bigint) as label_id,
           case when producto_a_entrenar is null then 'missing class or label' when try_cast(label_considerar as bigint) is null then 'label is not a number' end as error
    from {fx_decisions} where lower(trim(incluir_dataset)) in ('si', 'sí')""")
def _(f: Fleet) -> DataFrame:
    return checks.validate_decisions(f.derived("fx_decisions")).select("reference_code", "class", "label_id", "error")


@query("check_required", """
    select 'selected_reference_code' as "column", count(*) filter (where selected_reference_code is null) as missing_rows from {fx_tx}
    union all select 'result_index', count(*) filter (where result_index is null) from {fx_tx}
    union all select 'transaction_id', count(*) filter (where transaction_id is null) from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    return checks.check_required(f.tx, ["selected_reference_code", "result_index", "transaction_id"])


@query("dedupe_transactions", """
    select transaction_id, Result, cast(coalesce(len(predicted_codes), -1) as int) as n from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    repeated = f.tx.unionByName(f.tx.filter(F.col("confidence") == "HIGH"))
    return labelling.dedupe_transactions(repeated).select(
        "transaction_id", "Result", F.coalesce(F.size("predicted_codes"), F.lit(-1)).alias("n"))


@query("dedupe_stored", """
    select transaction_id, Result, cast(coalesce(len(predicted_codes), -1) as int) as n from {fx_tx}""")
def _(f: Fleet) -> DataFrame:
    """Stored rows, a part of them twice: only those are compared whole."""
    path = shared_dir(f.spark, "repeated")
    f.tx.unionByName(f.tx.filter(F.col("confidence") == "HIGH")).write.parquet(path)
    return labelling.dedupe_stored(f.spark.read.parquet(path)).select(
        "transaction_id", "Result", F.coalesce(F.size("predicted_codes"), F.lit(-1)).alias("n"))
