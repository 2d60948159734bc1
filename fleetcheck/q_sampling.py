"""Samples, sets, suggestions and whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetcheck.q_metrics import RUN_SUMMARY
from fleetcheck.q_rows import analysed
from fleetcheck.registry import query
from fleetcheck.tables import AS_OF, Fleet
from weighlens.operators import datasets, images, review, sampling, suggestions
from weighlens.operators.checks import validate_decisions
from weighlens.plans import candidates, deployment, downloads, extract, image_review, merging, quality, registry, training_set
from weighlens.sinks.logs import read_dataset_log, write_dataset_log
from weighlens.sources.log_buckets import BucketedLog
from weighlens.sources.decisions import marked_for_dataset, marked_for_review
from weighlens.sources.lookups import load_review_transactions
from weighlens.sources.used_index import UsedIndex
from weighlens.storage import shared_dir

# SQL parts
_GOOD = """good as (select *, trim(producto_a_entrenar) as class, cast(try_cast(label_considerar as double) as bigint) as label
    from {fx_decisions} where lower(trim(incluir_dataset)) in ('si', 'sí') and producto_a_entrenar is not null and try_cast(label_considerar as double) is not null)"""
_DEVICES = "(select cast(cast(device_id as bigint) as string) from {fx_device_decisions} where lower(trim(incluir_dataset)) in ('si', 'sí'))"
_CACHED = "cached as (select * from {fx_images} where selected_reference_code is not null and image_link <> '')"
_CANDIDATES = """candidates as (select g.reference_code, g.reference_name, g.class, g.label, g.num_imagenes_dataset, t.transaction_id, t.transaction_start_time, t.device_id, t.image_link
    from good g join cached t on g.reference_code = t.selected_reference_code
    where t.transaction_id not in (select transaction_id from {fx_used}) and cast(t.device_id as string) in """ + _DEVICES + ")"
_PICKED = """picked as (select * from (select *, row_number() over (partition by reference_name order by md5('42|' || transaction_id), transaction_id) as rn from candidates) a
    where rn <= coalesce(num_imagenes_dataset, 50))"""
_EXTRA = """extra as (select * from (select g.reference_name, g.class, g.label, t.transaction_id, t.transaction_start_time, t.device_id, t.image_link, d.n,
           row_number() over (partition by t.device_id order by md5('42|' || t.transaction_id), t.transaction_id) as rn
    from cached t join (select cast(device_id as bigint) as device_id, num_imagenes_dataset_adicionales as n from {fx_device_decisions}
                        where lower(trim(incluir_dataset)) in ('si', 'sí') and num_imagenes_dataset_adicionales > 0) d on t.device_id = d.device_id
         join good g on g.reference_code = t.selected_reference_code
    where t.transaction_id not in (select transaction_id from {fx_used}) and t.transaction_id not in (select transaction_id from picked)) a where rn <= n)"""
_TRAINING = "with " + ",\n".join([_GOOD, _CACHED, _CANDIDATES, _PICKED, _EXTRA])


def _good(f: Fleet) -> DataFrame:
    return validate_decisions(f.derived("fx_decisions")).filter("error is null").drop("error")


def _cached(f: Fleet) -> DataFrame:
    from weighlens.sources.lookups import load_cached_transactions
    return load_cached_transactions(f.cached)


def _candidates(f: Fleet) -> DataFrame:
    return sampling.dataset_candidates(_good(f), _cached(f), f.derived("fx_used"), f.derived("fx_device_decisions"))


@query("dataset_candidates", _TRAINING + " select reference_code, reference_name, class, label as label_id, transaction_id, device_id from candidates")
def _(f: Fleet) -> DataFrame:
    return _candidates(f).select("reference_code", "reference_name", "class", "label_id", "transaction_id", "device_id")


@query("exclude_used", "select transaction_id, Result from {fx_tx} where transaction_id not in (select transaction_id from {fx_used})")
def _(f: Fleet) -> DataFrame:
    return sampling.exclude_used(f.tx, f.derived("fx_used")).select("transaction_id", "Result")


@query("exclude_used_index", "select transaction_id, Result from {fx_tx} where transaction_id not in (select transaction_id from {fx_used})")
def _(f: Fleet) -> DataFrame:
    """The same from an index that two runs have written."""
    index = UsedIndex.create(f.spark, shared_dir(f.spark, "used-index"), expected_ids=1_000_000, buckets=32)
    used = f.derived("fx_used")
    for run in range(2):
        index.append(used.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == run))
    return sampling.exclude_used(f.tx, index).select("transaction_id", "Result")


@query("images_per_reference", """
    select d.reference_code, cast(coalesce(num_imagenes_dataset, 50) as bigint) as requested, coalesce(n, 0) as available,
           least(cast(coalesce(num_imagenes_dataset, 50) as bigint), coalesce(n, 0)) as num_imagenes
    from {fx_decisions} d left join (select selected_reference_code, count(*) as n from {fx_tx} group by 1) t on d.reference_code = t.selected_reference_code
    where lower(trim(incluir_dataset)) in ('si', 'sí')""")
def _(f: Fleet) -> DataFrame:
    return sampling.images_per_reference(marked_for_dataset(f.derived("fx_decisions")), f.tx).select(
        "reference_code", "requested", "available", "num_imagenes")


@query("sample_per_reference", _TRAINING + " select reference_name, transaction_id, class, label as label_id from picked")
def _(f: Fleet) -> DataFrame:
    return sampling.sample_per_reference(_candidates(f), _good(f)).select("reference_name", "transaction_id", "class", "label_id")


@query("sample_per_device", _TRAINING + " select cast(device_id as string) as valor_motivo, transaction_id, reference_name, class, label as label_id from extra")
def _(f: Fleet) -> DataFrame:
    path = shared_dir(f.spark, "taken")
    sampling.sample_per_reference(_candidates(f), _good(f)).select("transaction_id").write.parquet(path)
    taken = f.spark.read.parquet(path)
    return sampling.sample_per_device(
        f.derived("fx_device_decisions"), _good(f), _cached(f), taken, f.derived("fx_used")
    ).select("valor_motivo", "transaction_id", "reference_name", "class", "label_id")


@query("limit_decisions", """
    select reference_code, incluir_dataset from {fx_decisions} order by md5('42|' || reference_code), reference_code limit 25""")
def _(f: Fleet) -> DataFrame:
    return sampling.limit_decisions(f.derived("fx_decisions"), "reference_code", 25).select("reference_code", "incluir_dataset")


_SUBS = """subs as (select distinct lower(t.result_label_name) as similar_name, t.selected_reference_code, d.reference_code, d.reference_name, d.label_id, d.label_name
    from {fx_tx} t join {fx_decisions} d on t.selected_reference_code = d.reference_code where Ok = 1 and Ok_modelo = 1 and t.result_label_name is not null)"""
_ENTRIES = """marked as (select * from {fx_decisions} where lower(revisar_imagenes) in ('si', 'yes')),
    tops as (select reference_id, reference_name, 'similar_top1' as type, top1_result_index as result_index, top1_result_label_name as parent from marked
             union all select reference_id, reference_name, 'similar_top2', top2_result_index, top2_result_label_name from marked where top2_result_label_name is not null),
    entries as (select coalesce(label_name, lower(reference_name)) as name, 'clase_principal' as type, cast(null as int) as result_index, reference_id, reference_name,
                       cast(null as string) as parent_similar_name, cast(label_id as string) as label_id, reference_code, cast(null as string) as selected_reference_code from marked
                union all
                select case when s.selected_reference_code is not null then s.label_name else t.parent end, t.type, t.result_index, t.reference_id, t.reference_name, t.parent,
                       cast(s.label_id as string), s.reference_code, s.selected_reference_code
                from tops t left join subs s on lower(t.parent) = s.similar_name)"""
_REVIEW = "with " + ",\n".join([_SUBS, _ENTRIES])


@query("similar_sub_products", "with " + _SUBS + " select * from subs")
def _(f: Fleet) -> DataFrame:
    return review.similar_sub_products(f.tx, f.derived("fx_decisions"))


def _entries(f: Fleet) -> DataFrame:
    decisions = f.derived("fx_decisions")
    return review.products_to_review(marked_for_review(decisions), review.similar_sub_products(f.tx, decisions))


@query("products_to_review", _REVIEW + """
    select name, type, result_index, reference_id, reference_name, parent_similar_name, label_id, reference_code, selected_reference_code from entries""")
def _(f: Fleet) -> DataFrame:
    return _entries(f).drop("entry_id")


_REVIEW_ROWS = """,
    found as (select e.*, t.transaction_id, t.device_id, t.device_name, t.image_link, t.result_label_name, t.transaction_start_time, t.selected_reference_name, t.confidence,
           t.Ok, t.Ok_modelo from entries e join {fx_images} t on t.image_link <> '' and (
                  (e.type = 'clase_principal' and upper(t.selected_reference_name) = upper(e.reference_name))
               or (e.type <> 'clase_principal' and e.selected_reference_code is not null and t.selected_reference_code = e.selected_reference_code and Ok = 1 and Ok_modelo = 1)
               or (e.type <> 'clase_principal' and e.selected_reference_code is null and lower(t.result_label_name) = lower(e.name) and Ok = 1 and Ok_modelo = 1))),
    chosen as (select * from (select *, row_number() over (partition by reference_id, type, parent_similar_name, selected_reference_code order by md5('42|' || transaction_id), transaction_id) as rn from found) a where rn <= 3)"""


@query("sample_for_review", _REVIEW + _REVIEW_ROWS + """
    select reference_name, name as product_name, type as product_type, parent_similar_name, label_id, transaction_id from chosen""")
def _(f: Fleet) -> DataFrame:
    tx = load_review_transactions(f.cached)
    return review.sample_for_review(_entries(f), tx, 3).select(
        "reference_name", "product_name", "product_type", "parent_similar_name", "label_id", "transaction_id")


_DEVICE_ROWS = """(select * from (select d.device_name as product_name, t.*, row_number() over (partition by t.device_id order by md5('42|' || t.transaction_id), t.transaction_id) as rn
    from {fx_device_decisions} d join {fx_images} t on cast(d.device_id as bigint) = t.device_id where revisar_imagenes = 'sí' and t.image_link <> '') a where rn <= 3)"""


@query("sample_devices_for_review", "select product_name, device_id, transaction_id, 'device' as product_type from " + _DEVICE_ROWS + " x")
def _(f: Fleet) -> DataFrame:
    tx = load_review_transactions(f.cached)
    return review.sample_devices_for_review(f.derived("fx_device_decisions"), tx, 3).select(
        "product_name", "device_id", "transaction_id", "product_type")


@query("first_n_per_folder", """
    select transaction_id, path as s3_key, cast(rn as int) as image_no, transaction_id || '_' || cast(rn as string) || '.jpg' as filename
    from (select d.transaction_id, l.path, row_number() over (partition by d.transaction_id order by l.path) as rn
          from {fx_folders} d join {fx_listing} l on d.folder_url = regexp_extract(l.path, '^(.*/)', 1)) a where rn <= 2""")
def _(f: Fleet) -> DataFrame:
    return images.first_n_per_folder(f.derived("fx_folders"), f.derived("fx_listing"), 2)


@query("all_images_per_folder", """
    select transaction_id, path as s3_key, cast(rn as bigint) as image_no, transaction_id || '_' || cast(rn as string) || '.jpg' as filename
    from (select d.transaction_id, l.path, row_number() over (partition by d.transaction_id order by l.path) as rn
          from {fx_folders} d join {fx_listing} l on d.folder_url = regexp_extract(l.path, '^(.*/)', 1)) a""")
def _(f: Fleet) -> DataFrame:
    return images.first_n_per_folder(
        f.derived("fx_folders"), f.derived("fx_listing"), None, work_dir=shared_dir(f.spark, "numbered"))


def _bucketed_log(f: Fleet) -> BucketedLog:
    """The log in buckets, added in two runs."""
    log, buckets = f.derived("fx_log"), BucketedLog.create(f.spark, shared_dir(f.spark, "log-buckets"), 16)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    buckets.append(log.filter(late))
    buckets.append(log.filter(~late))
    return buckets


@query("latest_per_transaction", """
    select t.transaction_id, case when l.newer then 'log' else cast(device_id as string) end as device_id,
           case when l.newer then timestamp '2005-01-01' else transaction_start_time end as transaction_start_time
    from {fx_tx} t left join (select transaction_id, bool_or(motivo_descarga = 'device') as newer from {fx_log} group by 1) l on t.transaction_id = l.transaction_id""")
def _(f: Fleet) -> DataFrame:
    """The log is newer for device rows and older for the others."""
    log = f.derived("fx_log").withColumns({
        "transaction_start_time": F.when(F.col("motivo_descarga") == "device", "2005-01-01 00:00:00").otherwise("1990-01-01 00:00:00"),
        "device_id": F.lit("log")})
    return datasets.latest_per_transaction([log, f.tx, f.derived("fx_labels")])


@query("dataset_versions", """
    select cast(p[1] as int) as deployment_id, p[2] as day, count(*) as datasets, max(cast(p[3] as int)) as version, max(cast(p[3] as int)) + 1 as next_version
    from (select distinct dataset_folder, regexp_extract_all(replace(dataset_folder, '_v1_', '_'), '([0-9]+)') as p from {fx_sets} where dataset_folder like '%\\_v%' escape '\\') a group by 1, 2""")
def _(f: Fleet) -> DataFrame:
    return datasets.dataset_versions(f.derived("fx_sets"))


_MERGED = "(select class, label_id, filename, arg_max(dataset, set_order) as dataset_original, count(*) as copies from {fx_files} group by 1, 2, 3)"


@query("merge_datasets", "select * from " + _MERGED + " m")
def _(f: Fleet) -> DataFrame:
    return datasets.merge_datasets(f.derived("fx_files"))


@query("merge_counts", "select cast(sum(copies) as bigint) as copied, cast(sum(copies) - count(*) as bigint) as overwritten, count(*) as unique_files, "
       "count(*) filter (where filename like '%.JPG') as unique_images from " + _MERGED + " m")
def _(f: Fleet) -> DataFrame:
    return datasets.merge_counts(datasets.merge_datasets(f.derived("fx_files")))


@query("merge_log", """
    select 'merged' as dataset_folder, class as clase_name, label_id, filename, 'merged/' || class || '/' || label_id || '/' || filename as local_path,
           'merged' as download_status, 'juntar_datasets' as origen, dataset_original, class || '/' || label_id as relative_folder from """ + _MERGED + " m")
def _(f: Fleet) -> DataFrame:
    return datasets.merge_log(datasets.merge_datasets(f.derived("fx_files")), "merged", f.derived("fx_log"))


@query("merge_log_enrichment", """
    select m.class, m.label_id, m.filename, m.dataset_original, l.reference_name, l.transaction_id, cast(l.device_id as string) as device_id, l.s3_key
    from """ + _MERGED + """ m left join (select *, regexp_extract(local_path, '([^/]*)$', 1) as filename from {fx_log}) l on m.filename = l.filename""")
def _(f: Fleet) -> DataFrame:
    return datasets.merge_log_enrichment(datasets.merge_datasets(f.derived("fx_files")), f.derived("fx_log")).select(
        "class", "label_id", "filename", "dataset_original", "reference_name", "transaction_id", "device_id", "s3_key")


@query("merge_log_bucketed", """
    select m.class, cast(m.label_id as varchar) as label_id, m.filename, m.dataset_original, m.copies, l.reference_name, l.transaction_id,
           cast(l.transaction_start_time as varchar) as transaction_start_time, cast(l.device_id as varchar) as device_id, l.s3_key, l.motivo_descarga
    from """ + _MERGED + """ m left join (select *, regexp_extract(local_path, '([^/]*)$', 1) as filename from {fx_log}) l on m.filename = l.filename""")
def _(f: Fleet) -> DataFrame:
    return datasets.merge_log_enrichment(datasets.merge_datasets(f.derived("fx_files")), _bucketed_log(f)).select(
        "class", "label_id", "filename", "dataset_original", "copies", "reference_name", "transaction_id", "transaction_start_time",
        "device_id", "s3_key", "motivo_descarga")


@query("merge_sets", """
    select m.class as clase_name, m.label_id, 'merged/' || m.class || '/' || m.label_id || '/' || m.filename as local_path, m.dataset_original,
           'merged' as dataset_folder, l.reference_name, l.transaction_id, l.s3_key
    from """ + _MERGED + """ m
         left join (select *, regexp_extract(local_path, '([^/]*)$', 1) as filename from {fx_log}) l on m.filename = l.filename""")
def _(f: Fleet) -> DataFrame:
    """The log starts with the earlier rows; the merge's rows are read back from it."""
    path = shared_dir(f.spark, "merge-log")
    write_dataset_log(f.derived("fx_log"), path)
    merging.merge_sets(f.derived("fx_files"), path, "merged")
    return read_dataset_log(f.spark, path).filter("dataset_folder = 'merged'").select(
        "clase_name", F.col("label_id").cast("string").alias("label_id"), "local_path", "dataset_original", "dataset_folder",
        "reference_name", "transaction_id", "s3_key")


_SUMMARY = """select string_split(x.filename, '_')[2] as transaction_id, cast(l.device_id as string) as device_id, l.transaction_start_time,
    cast(l.transaction_start_time as date) as "Date", x.class as clase, x.label_id, x.filename, x.class || '/' || x.label_id as file_name_path
    from {fx_files} x left join {fx_log} l on string_split(x.filename, '_')[2] = l.transaction_id where x.filename like '%.JPG'"""


@query("dataset_summary", _SUMMARY)
def _(f: Fleet) -> DataFrame:
    return datasets.dataset_summary(f.derived("fx_files"), [f.derived("fx_log")])


@query("dataset_summary_bucketed", _SUMMARY)
def _(f: Fleet) -> DataFrame:
    return datasets.dataset_summary(f.derived("fx_files"), [_bucketed_log(f)])


@query("registry_upsert", """
    select dataset_name, created_at, deployment_id, coalesce(trained_model, '') as trained_model, description, s3_path from {fx_registry}
    where dataset_name not in (select dataset_name from {fx_registry_new})
    union all select dataset_name, created_at, deployment_id, trained_model, description, s3_path from {fx_registry_new}""")
def _(f: Fleet) -> DataFrame:
    return datasets.registry_upsert(f.derived("fx_registry"), f.derived("fx_registry_new"))


_URLS = """urls as (select code as reference_code, url, min(lpad(cast(pos as string), 2, '0') || cast(transaction_start_time as string) || '|' || transaction_id) as seen from (
        select distinct transaction_id, transaction_start_time, unnest([reference_code, product_code]) as code, unnest([0, 0]) as z, image_url, thumb_image_url, image_path from {fx_urls}) a,
        lateral (select unnest([image_url, thumb_image_url, image_path]) as url, unnest([0, 1, 2]) as pos) b
    where code is not null and (url like 'http%' or url like '/%') group by 1, 2),
    ranked as (select *, row_number() over (partition by reference_code order by seen, url) as rn from urls)"""


@query("extract_image_urls", "with " + _URLS + " select reference_code, url, cast(rn as int) as image_no from ranked where rn <= 4")
def _(f: Fleet) -> DataFrame:
    return images.extract_image_urls(f.derived("fx_urls"), 4).select("reference_code", "url", "image_no")


@query("suggestions_wide", """
    select reference_code, total_detections, """ + ", ".join(
    f"""all_suggestions[{i}].label_id as sugerencia_{i}_label_id,
        case when all_suggestions[{i}] is not null then printf('%.1f%%', round(all_suggestions[{i}].percentage, 1)) end as sugerencia_{i}_porcentaje""" for i in (1, 2, 3)) + " from {fx_suggestions}")
def _(f: Fleet) -> DataFrame:
    return suggestions.suggestions_wide(f.derived("fx_suggestions")).select(
        "reference_code", "total_detections", *[f"sugerencia_{i}_{c}" for i in (1, 2, 3) for c in ("label_id", "porcentaje")])


_LONG = """(select reference_code, reference_name, s.label_id as suggested_label_id, s."count" as "count", printf('%.1f%%', round(s.percentage, 1)) as percentage,
    total_detections, suggestion_confidence as confidence_level from (select *, unnest(all_suggestions) as s from {fx_suggestions}) a)"""


@query("suggestions_long", "select * from " + _LONG + " x")
def _(f: Fleet) -> DataFrame:
    return suggestions.suggestions_long(f.derived("fx_suggestions"))


@query("similar_class_urls", """
    with rows_of as (select distinct transaction_id, transaction_start_time, unnest([predicted_label_id, label_id]) as label_id, unnest([0, 0]) as z, image_url, thumb_image_url from {fx_urls}),
    urls as (select label_id, transaction_start_time, transaction_id, unnest([image_url, thumb_image_url]) as url, unnest([0, 1]) as pos from rows_of
             where label_id in (select suggested_label_id from """ + _LONG + """ s)),
    ranked as (select *, row_number() over (partition by label_id order by pos, transaction_start_time, transaction_id) as rn from urls where url is not null)
    select r.label_id, coalesce(b.label_name, 'label_' || cast(r.label_id as string)) as label_name, url, cast(rn as int) as image_no,
           'label_' || cast(r.label_id as string) || '_' || coalesce(b.label_name, 'label_' || cast(r.label_id as string)) as directory,
           'image_' || lpad(cast(rn - 1 as string), 4, '0') || case when pos = 0 then '.png' when url like '%.bmp' then '.bmp' else '.jpg' end as filename
    from ranked r left join {fx_labels} b on r.label_id = b.label_id where rn <= 5""")
def _(f: Fleet) -> DataFrame:
    return suggestions.similar_class_urls(f.derived("fx_suggestions"), f.derived("fx_urls"), f.derived("fx_labels"), 5)


@query("new_references_report", """
    select 'new_references' as part, a.reference_code, a.reference_name, cast(a.num_cliente as bigint) as num_cliente, coalesce(d.downloaded, 0) as imagenes_descargadas,
           coalesce(s.suggestion_confidence, 'Sin datos') as level, printf('%.1f%%', round(coalesce(cast(s.main_suggestion_percentage as double), 0), 1)) as percentage, null as label_id, null as "count"
    from {fx_analysed} a left join {fx_downloads} d on a.reference_code = d.reference_code left join {fx_suggestions} s on a.reference_code = s.reference_code
    where not a.is_trained_elastic
    union all select 'suggestions', reference_code, reference_name, total_detections, null, confidence_level, percentage, suggested_label_id, "count" from """ + _LONG + " x")
def _(f: Fleet) -> DataFrame:
    parts = suggestions.new_references_report(analysed(f), f.derived("fx_downloads"), f.derived("fx_suggestions"))
    detail = parts["suggestions"].selectExpr(
        "'suggestions' as part", "reference_code", "reference_name", "total_detections as num_cliente", "confidence_level as level", "percentage",
        "suggested_label_id as label_id", "count")
    return parts["new_references"].selectExpr(
        "'new_references' as part", "reference_code", "reference_name", "num_cliente", "imagenes_descargadas", "nivel_confianza as level", "porcentaje_sugerencia as percentage"
    ).unionByName(detail, allowMissingColumns=True)


# Jobs


@query("deployment_extract", """
    select transaction_id, deployment_id, Result, Result_modelo, has_image, cast(num_images as int) as num_images, image_link, "Date" from {fx_images}
    where deployment_id = 5 and model_id = 50 and transaction_start_time >= timestamp '1995-09-19' and transaction_start_time < timestamp '1998-06-16'""")
def _(f: Fleet) -> DataFrame:
    """One deployment's extract, written by deployment and read back."""
    path = shared_dir(f.spark, "deployment")
    extract.write_extract(
        extract.deployment_extract(f.raw, f.derived("fx_deployments"), f.derived("fx_folders"), 5, AS_OF, 1000, 999), path)
    return f.spark.read.parquet(path).filter("deployment_id = 5").select(
        "transaction_id", "deployment_id", "Result", "Result_modelo", "has_image", "num_images", "image_link", "Date")


@query("deployment_report", """
    select p.reference_id, p.reference_code, coalesce(c, 0) as num_cliente, coalesce(m, 0) as num_manuales, l.label_name
    from {fx_fleet_products} p left join (
        select reference_id, count(*) filter (where is_client) as c, count(*) filter (where is_manual) as m from {fx_fleet_matches}
        where deployment_id = 5 and model_id = 50 and transaction_start_time >= timestamp '1995-09-19' and transaction_start_time < timestamp '1998-06-16' group by 1) x
        on p.reference_id = x.reference_id
        left join {fx_labels} l on cast(p.label_id as bigint) = l.label_id
    where p.deployment_id = 5""")
def _(f: Fleet) -> DataFrame:
    """The whole job for one deployment; its product table is read back."""
    written = deployment.deployment_report(
        f.raw, f.derived("fx_deployments"), f.derived("fx_models"), f.derived("fx_fleet_products"), f.derived("fx_labels"), f.derived("fx_folders"),
        5, AS_OF, shared_dir(f.spark, "deployment-report"), 1000)
    return f.spark.read.parquet(written["products"]).select("reference_id", "reference_code", "num_cliente", "num_manuales", "label_name")


@query("fleet_report", """
    with own as (select deployment_id, max(model_id) as own from {fx_deployments} group by 1 having max(model_id) is not null),
    window_of as (select t.*, own from {fx_tx} t join own using (deployment_id)
                  where transaction_start_time >= timestamp '1995-09-19' and transaction_start_time < timestamp '1998-06-16'),
    has as (select distinct deployment_id from window_of where model_id = own),
    taken as (select transaction_id from window_of where model_id = own or deployment_id not in (select deployment_id from has))
    select 'product' as kind, p.reference_id, p.deployment_id, p.reference_code, coalesce(c, 0) as num_cliente, coalesce(m, 0) as num_manuales, l.label_name,
           case when c >= 2 then 'si' else 'no' end as incluir_dataset
    from {fx_fleet_products} p join own on p.deployment_id = own.deployment_id left join (
        select reference_id, count(*) filter (where is_client) as c, count(*) filter (where is_manual) as m from {fx_fleet_matches}
        where transaction_id in (select transaction_id from taken) group by 1) x on p.reference_id = x.reference_id
        left join {fx_labels} l on cast(p.label_id as bigint) = l.label_id
    union all select 'skipped', null, deployment_id, null, null, null, null, null from {fx_deployments} group by deployment_id having max(model_id) is null
    union all select 'extract', null, deployment_id, null, count(*), null, null, null from window_of where transaction_id in (select transaction_id from taken) group by deployment_id""")
def _(f: Fleet) -> DataFrame:
    """The job for all deployments at once; its products, skipped deployments and extract are read back."""
    written = deployment.fleet_report(
        f.raw, f.derived("fx_deployments"), f.derived("fx_models"), f.derived("fx_fleet_products"), f.derived("fx_labels"), f.derived("fx_folders"),
        AS_OF, shared_dir(f.spark, "fleet-report"), 1000, 2)
    read = lambda table: f.spark.read.parquet(written[table])
    products = read("products").selectExpr(
        "'product' as kind", "reference_id", "deployment_id", "reference_code", "num_cliente", "num_manuales", "label_name", "incluir_dataset")
    extracted = read("extract").groupBy("deployment_id").agg(F.count(F.lit(1)).alias("num_cliente")).withColumn("kind", F.lit("extract"))
    skipped = read("skipped").select(F.lit("skipped").alias("kind"), "deployment_id")
    return products.unionByName(skipped, allowMissingColumns=True).unionByName(extracted, allowMissingColumns=True)


# a fleet in one frame: a code is sampled, looked up and downloaded in its own deployment only
_FLEET_REVIEW = (_REVIEW + _REVIEW_ROWS).replace("{fx_decisions}", "{fx_fleet_decisions}")
for _one, _fleet in (
    ("select distinct lower(t.result_label_name)", "select distinct t.deployment_id, lower(t.result_label_name)"),
    ("on t.selected_reference_code = d.reference_code where", "on t.deployment_id = d.deployment_id and t.selected_reference_code = d.reference_code where"),
    ("tops as (select reference_id,", "tops as (select deployment_id, reference_id,"),
    ("union all select reference_id, reference_name, 'similar_top2'", "union all select deployment_id, reference_id, reference_name, 'similar_top2'"),
    ("entries as (select coalesce", "entries as (select deployment_id, coalesce"),
    ("select case when s.selected_reference_code is not null", "select t.deployment_id, case when s.selected_reference_code is not null"),
    ("on lower(t.parent) = s.similar_name", "on t.deployment_id = s.deployment_id and lower(t.parent) = s.similar_name"),
    ("{fx_images} t on t.image_link <> ''", "{fx_images} t on t.deployment_id = e.deployment_id and t.image_link <> ''"),
):
    assert _one in _FLEET_REVIEW
    _FLEET_REVIEW = _FLEET_REVIEW.replace(_one, _fleet)


def _fleet_entries(f: Fleet) -> DataFrame:
    decisions = f.derived("fx_fleet_decisions")
    return review.products_to_review(marked_for_review(decisions), review.similar_sub_products(f.tx, decisions))


@query("fleet_similar_sub_products", _FLEET_REVIEW.split("marked as")[0].rstrip().rstrip(",") + " select * from subs")
def _(f: Fleet) -> DataFrame:
    return review.similar_sub_products(f.tx, f.derived("fx_fleet_decisions"))


@query("fleet_products_to_review", _FLEET_REVIEW + """
    select deployment_id, name, type, result_index, reference_id, reference_name, parent_similar_name, label_id, reference_code, selected_reference_code from entries""")
def _(f: Fleet) -> DataFrame:
    return _fleet_entries(f).drop("entry_id")


@query("fleet_sample_for_review", _FLEET_REVIEW + """
    select deployment_id, reference_name, name as product_name, type as product_type, parent_similar_name, label_id, transaction_id from chosen""")
def _(f: Fleet) -> DataFrame:
    return review.sample_for_review(_fleet_entries(f), load_review_transactions(f.cached), 3).select(
        "deployment_id", "reference_name", "product_name", "product_type", "parent_similar_name", "label_id", "transaction_id")


@query("fleet_images_per_reference", """
    select d.reference_id, d.deployment_id, d.reference_code, cast(num_imagenes_dataset as bigint) as requested, coalesce(n, 0) as available,
           least(cast(num_imagenes_dataset as bigint), coalesce(n, 0)) as num_imagenes
    from {fx_fleet_decisions} d left join (select deployment_id, selected_reference_code, count(*) as n from {fx_tx} group by 1, 2) t
         on d.deployment_id = t.deployment_id and d.reference_code = t.selected_reference_code where incluir_dataset = 'si'""")
def _(f: Fleet) -> DataFrame:
    return sampling.images_per_reference(marked_for_dataset(f.derived("fx_fleet_decisions")), f.tx).select(
        "reference_id", "deployment_id", "reference_code", "requested", "available", "num_imagenes")


@query("fleet_sample_per_reference", """
    select * exclude (rn, n) from (
        select d.deployment_id, d.reference_name, d.reference_code, t.transaction_id, num_imagenes_dataset as n,
               row_number() over (partition by d.deployment_id, d.reference_name order by md5('42|' || t.transaction_id), t.transaction_id) as rn
        from {fx_fleet_decisions} d join {fx_images} t on d.deployment_id = t.deployment_id and d.reference_code = t.selected_reference_code
        where incluir_dataset = 'si' and image_link <> '' and t.transaction_id not in (select transaction_id from {fx_used})) a where rn <= n""")
def _(f: Fleet) -> DataFrame:
    decisions = validate_decisions(f.derived("fx_fleet_decisions")).filter("error is null").drop("error")
    found = sampling.dataset_candidates(decisions, _cached(f), f.derived("fx_used"))
    return sampling.sample_per_reference(found, decisions).select("deployment_id", "reference_name", "reference_code", "transaction_id")


_FLEET_URLS = """urls as (select deployment_id, code as reference_code, url, min(lpad(cast(pos as string), 2, '0') || cast(transaction_start_time as string) || '|' || transaction_id) as seen from (
        select distinct deployment_id, transaction_id, transaction_start_time, unnest([reference_code, product_code]) as code, unnest([0, 0]) as z, image_url, thumb_image_url from {fx_fleet_urls}) a,
        lateral (select unnest([image_url, thumb_image_url]) as url, unnest([0, 1]) as pos) b
    where code is not null and (url like 'http%' or url like '/%') group by 1, 2, 3),
    ranked as (select *, row_number() over (partition by deployment_id, reference_code order by seen, url) as rn from urls)"""


@query("fleet_extract_image_urls", "with " + _FLEET_URLS + " select deployment_id, reference_code, url, cast(rn as int) as image_no from ranked where rn <= 4")
def _(f: Fleet) -> DataFrame:
    return images.extract_image_urls(f.derived("fx_fleet_urls"), 4).select("deployment_id", "reference_code", "url", "image_no")


@query("fleet_reference_image_plan", "with " + _FLEET_URLS + """
    select r.deployment_id, r.reference_code, p.reference_name, url, cast(rn as int) as image_no, 'out/' || r.reference_code || '_' || p.reference_name as directory,
           'image_' || lpad(cast(rn - 1 as string), 4, '0') || case when url like '%.png?%' then '.png' else '.jpg' end as filename
    from ranked r join {fx_fleet_products} p on r.deployment_id = p.deployment_id and r.reference_code = p.reference_code where rn <= 4""")
def _(f: Fleet) -> DataFrame:
    return downloads.reference_image_plan(f.derived("fx_fleet_products"), f.derived("fx_fleet_urls"), "out", 4)


@query("write_manifest", _TRAINING + """
    select class, label, reference_name, transaction_id, 'dataset_1' as dataset_folder
    from (select class, label, reference_name, transaction_id from picked union all select class, label, reference_name, transaction_id from extra) x""")
def _(f: Fleet) -> DataFrame:
    """The training set's manifest in its folder layout, read back."""
    path = shared_dir(f.spark, "manifest")
    training_set.write_manifest(training_set.create_dataset(
        f.derived("fx_decisions"), f.derived("fx_device_decisions"), f.cached, f.derived("fx_used"), "dataset_1",
        work_dir=shared_dir(f.spark, "training"), skip_bad=True), path)
    return f.spark.read.parquet(path).select("class", "label", "reference_name", "transaction_id", "dataset_folder")

@query("quality_report", """
    select 'products' as table_name, reference_code as key, coalesce(label_name, '') as name, num_cliente, num_manuales, pct_ok_sistema, pct_ok_modelo,
           case when num_cliente >= 8 then 'si' else 'no' end as include from {fx_analysed}
    union all select 'devices', cast(device_id as string), device_name, num_cliente, num_manual, pct_ok_sistema, pct_ok_modelo, 'si' from {fx_devices}
    union all select 'active_model', cast(deployment_id as string), cast(model_id as string), frequency, total_records, percentage, 0, '' from {fx_active}
    union all select 'labels', cast(label_id as string), label_name, 0, 0, 0, 0, '' from {fx_labels}
    union all select 'model_classes', class_name, '', count(*), count(label_id), 0, 0, '' from {fx_classes} group by class_name
    union all select 'consistency', '', '', 7, 0, 0, 0, ''
    union all select 'summary', '', '', 11 + 3 * count(*), 0, 0, 0, '' from {fx_active}""")
def _(f: Fleet) -> DataFrame:
    """Every table of the written report, read back."""
    written = quality.quality_report(
        f.tx, f.catalogue, f.derived("fx_labels"), f.derived("fx_classes"), shared_dir(f.spark, "quality"), 8)

    def part(table: str, key: str, name: str, *values: str) -> DataFrame:
        exprs = [v if " as " in v else f"{v} as {n}" for v, n in zip(values, ("num_cliente", "num_manuales", "pct_ok_sistema", "pct_ok_modelo", "include"))]
        return f.spark.read.parquet(written[table]).selectExpr(f"'{table}' as table_name", f"cast({key} as string) as key", f"{name} as name", *exprs)

    def counted(table: str, group: str, filled: str) -> DataFrame:
        return f.spark.read.parquet(written[table]).groupBy(F.expr(group).alias("key")).agg(
            F.count(F.lit(1)).alias("num_cliente"), F.expr(filled).alias("num_manuales")
        ).selectExpr(f"'{table}' as table_name", "key", "'' as name", "num_cliente", "num_manuales", "0D as pct_ok_sistema", "0D as pct_ok_modelo", "'' as include")

    rows = part("products", "reference_code", "coalesce(label_name, '')", "num_cliente", "num_manuales", "pct_ok_sistema", "pct_ok_modelo", "incluir_dataset")
    for other in (
        part("devices", "device_id", "device_name", "num_cliente", "num_manual", "pct_ok_sistema", "pct_ok_modelo", "incluir_dataset"),
        part("active_model", "deployment_id", "cast(model_id as string)", "frequency", "total_records", "percentage", "0D", "''"),
        part("labels", "label_id", "label_name", "0L", "0L", "0D", "0D", "''"),
        counted("model_classes", "class_name", "count(label_id)"),
        counted("consistency", "''", "0L"),
        counted("summary", "''", "0L"),
    ):
        rows = rows.unionByName(other)
    return rows


@query("candidate_report", RUN_SUMMARY)
def _(f: Fleet) -> DataFrame:
    written = candidates.candidate_report(
        f.tx, f.pairs, f.descriptions, f.activations, f.derived("fx_folders"), shared_dir(f.spark, "candidates"), 2)
    return f.spark.read.parquet(written["run_summary"])


_FIRST_KEY = "firsts as (select regexp_extract(path, '^(.*/)', 1) as folder, min(path) as key from {fx_listing} group by 1)"


@query("create_dataset", _TRAINING + ", " + _FIRST_KEY + """
    select reference_name, class as clase_name, label as label_id, transaction_id, strftime(transaction_start_time, '%Y-%m-%d %H:%M:%S') as transaction_start_time, device_id,
           coalesce(key, '') as s3_key,
           case when key is null then '' else 'dataset_1/' || class || '/' || cast(label as string) || '/' || strftime(transaction_start_time, '%Y%m%d%H%M%S') || '_' || transaction_id || '_'
                || regexp_extract(key, '([^/]*)$', 1) end as local_path,
           case when key is null then 'failed' else 'planned' end as download_status, case when key is null then 'Imagen no encontrada en S3' else '' end as error_reason,
           'dataset_1' as dataset_folder, motivo_descarga, valor_motivo, 'crear_dataset' as origen, '' as dataset_original,
           case when key is null then '' else class || '/' || cast(label as string) end as relative_folder
    from (select reference_name, class, label, transaction_id, transaction_start_time, device_id, image_link, 'reference' as motivo_descarga, reference_name as valor_motivo from picked
          union all select reference_name, class, label, transaction_id, transaction_start_time, device_id, image_link, 'device', cast(device_id as string) from extra) x
         left join firsts on x.image_link = firsts.folder""")
def _(f: Fleet) -> DataFrame:
    return training_set.create_dataset(
        f.derived("fx_decisions"), f.derived("fx_device_decisions"), f.cached, f.derived("fx_used"), "dataset_1", f.derived("fx_listing"),
        work_dir=shared_dir(f.spark, "training"), skip_bad=True)


@query("download_summary", _TRAINING + ", " + _FIRST_KEY + """
    select motivo_descarga, count(*) as total, count(key) as planned, count(*) - count(key) as failed, round(100.0 * count(key) / count(*), 2) as success_rate
    from (select image_link, 'reference' as motivo_descarga from picked union all select image_link, 'device' from extra) x left join firsts on x.image_link = firsts.folder group by 1""")
def _(f: Fleet) -> DataFrame:
    from weighlens.operators.reports import download_summary
    return download_summary(training_set.create_dataset(
        f.derived("fx_decisions"), f.derived("fx_device_decisions"), f.cached, f.derived("fx_used"), "dataset_1", f.derived("fx_listing"),
        work_dir=shared_dir(f.spark, "training"), skip_bad=True))


@query("review_images", _REVIEW + _REVIEW_ROWS + ", " + _FIRST_KEY + """
    select case when type = 'device' then 'unknown' else reference_name end as reference_name, name as product_name, type as product_type, transaction_id, coalesce(key, '') as s3_key,
           case when key is null then '' else 's3://images/' || key end as s3_url,
           case when key is null then '' else folder_to || '/' || transaction_id || regexp_extract(key, '(\\.[^.]*)$', 1) end as local_path,
           case when key is null then 'failed' else 'planned' end as download_status, case when key is null then 'Imagen no encontrada en S3' else '' end as error_reason,
           transaction_start_time, cast(device_id as string) as device_id, device_name, selected_reference_name, result_label_name, confidence, Ok, Ok_modelo
    from (select reference_name, name, type, transaction_id, image_link, transaction_start_time, device_id, device_name, selected_reference_name, result_label_name,
                 confidence, Ok, Ok_modelo,
                 case when type = 'clase_principal' then 'revisar_imagenes/productos/' || reference_name || '/' || name
                      else 'revisar_imagenes/productos/' || reference_name || '/Reference_similar_' || parent_similar_name || '/' || coalesce(label_id, 'unknown') || '_' || coalesce(name, '') end as folder_to
          from chosen
          union all select '', product_name, 'device', transaction_id, image_link, transaction_start_time, device_id, device_name, selected_reference_name,
                 result_label_name, confidence, Ok, Ok_modelo, 'revisar_imagenes/devices/' || cast(device_id as string) from """ + _DEVICE_ROWS + """ y) x
         left join firsts on x.image_link = firsts.folder""")
def _(f: Fleet) -> DataFrame:
    return image_review.review_images(
        f.derived("fx_decisions"), f.derived("fx_device_decisions"), f.cached, f.derived("fx_listing"), 3)


@query("folder_download_plan", """
    with req as (select transaction_id, 'base' || coalesce('/' || regexp_replace(trim(selected_reference_name), '[^a-zA-Z0-9_.-]', '_', 'g'), '') || '/' || confidence as target_folder
                 from {fx_tx} where transaction_id in (select transaction_id from {fx_used}))
    select req.transaction_id, target_folder, s3_key, cast(rn as int) as image_no, req.transaction_id || '_' || cast(rn as string) || '.jpg' as filename,
           target_folder || '/' || req.transaction_id || '_' || cast(rn as string) || '.jpg' as local_path
    from req join (select d.transaction_id, l.path as s3_key, row_number() over (partition by d.transaction_id order by l.path) as rn
                   from {fx_folders} d join {fx_listing} l on d.folder_url = regexp_extract(l.path, '^(.*/)', 1)) i on req.transaction_id = i.transaction_id where rn <= 2""")
def _(f: Fleet) -> DataFrame:
    requests = f.tx.join(f.derived("fx_used"), "transaction_id", "left_semi").select(
        "transaction_id", "selected_reference_name", "confidence")
    return downloads.folder_download_plan(requests, f.tx, f.derived("fx_folders"), f.derived("fx_listing"), "base", 2)


@query("reference_image_plan", "with " + _URLS + """
    select r.reference_code, a.reference_name, url, cast(rn as int) as image_no, 'out/' || r.reference_code || '_' || a.reference_name as directory,
           'image_' || lpad(cast(rn - 1 as string), 4, '0') || case when url like '%.png?%' then '.png' when url like '%.jpeg' then '.jpeg' else '.jpg' end as filename
    from ranked r join {fx_analysed} a on r.reference_code = a.reference_code where rn <= 4 and not a.is_trained_elastic""")
def _(f: Fleet) -> DataFrame:
    return downloads.reference_image_plan(analysed(f).filter("not is_trained_elastic"), f.derived("fx_urls"), "out", 4)


@query("register_dataset", """
    select 'registry' as table_name, dataset_name as key, created_at as value from {fx_registry}
    union all select 'registry', 'set_new', '15/06/1998'
    union all select 'summary', filename || '|' || clase, coalesce(device_id, '') from (""" + _SUMMARY + """) s
    union all select 'totals', cast(count(*) as string), cast(count(distinct class || '/' || label_id) as string) from {fx_files}""")
def _(f: Fleet) -> DataFrame:
    written = registry.register_dataset(
        f.derived("fx_registry"), f.derived("fx_files"), [f.derived("fx_log")], "set_new", "15/06/1998", "3", "", "all", "s3://x/y",
        shared_dir(f.spark, "registry"))

    def part(table: str, key: str, value: str) -> DataFrame:
        return f.spark.read.parquet(written[table]).selectExpr(f"'{table}' as table_name", f"{key} as key", f"{value} as value")

    return (
        part("registry", "dataset_name", "created_at")
        .unionByName(part("summary", "filename || '|' || clase", "coalesce(device_id, '')"))
        .unionByName(part("totals", "cast(files as string)", "cast(folders as string)"))
    )
