"""Joins, aggregations and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetcheck.q_rows import analysed
from fleetcheck.q_sources import with_links
from fleetcheck.registry import query
from fleetcheck.tables import Fleet
from weighlens.operators import devices, images, labelling, models, pairs, references, reports
from weighlens.plans import candidates, day_states, quality
from weighlens.storage import shared_dir


@query("references_with_labels", """
    select reference_code, l.label_id, b.label_name from {fx_label_of_reference} l left join {fx_labels} b on l.label_id = b.label_id""")
def _(f: Fleet) -> DataFrame:
    return references.references_with_labels(f.catalogue, f.derived("fx_labels")).select(
        "reference_code", "label_id", "label_name")


@query("references_with_model", """
    select reference_code, c.label_id is not null as is_in_dataset, last_class as producto_trained
    from {fx_label_of_reference} l left join {fx_class_of_label} c on l.label_id = c.label_id""")
def _(f: Fleet) -> DataFrame:
    return references.references_with_model(f.catalogue, f.derived("fx_classes")).select(
        "reference_code", "is_in_dataset", "producto_trained")


@query("transactions_by_reference", "select reference_id, transaction_id, matched_by, Result from {fx_matches}")
def _(f: Fleet) -> DataFrame:
    return references.transactions_by_reference(f.tx, f.catalogue).select(
        "reference_id", "transaction_id", "matched_by", "Result")


_FREQUENT = """(select selected_reference_code as reference_code, count(*) filter (where is_client) as cliente_appearances,
    count(*) filter (where is_manual) as num_manuales, count(*) filter (where is_client and trained) as trained_count,
    count(*) filter (where is_client and selected_reference_is_trained = false) as not_trained_count
    from {fx_tx} where selected_reference_code is not null group by 1 having count(*) filter (where is_client) >= 5)"""


@query("frequent_references", "select r.reference_code, cliente_appearances, num_manuales from {fx_references} r join " + _FREQUENT
       + " c on r.reference_code = c.reference_code")
def _(f: Fleet) -> DataFrame:
    return references.frequent_references(f.tx, f.catalogue).select(
        "reference_code", "cliente_appearances", "num_manuales")


@query("expected_accuracy", """
    select t.transaction_id, a.pct_ok_modelo as pct_ok_modelo_previsto from {fx_tx} t left join {fx_accuracy} a
    on t.deployment_id = a.deployment_id and t.selected_reference_code = a.selected_reference_code""")
def _(f: Fleet) -> DataFrame:
    return models.add_expected_accuracy(f.tx, models.accuracy_stats(f.tx, 2)).select("transaction_id", "pct_ok_modelo_previsto")


@query("accuracy_stats", """
    select deployment_id, selected_reference_code, selected_reference_name, total_transactions, successful_transactions, pct_ok_modelo from {fx_accuracy}""")
def _(f: Fleet) -> DataFrame:
    return models.accuracy_stats(f.tx, 2)


METRICS = ["reference_id", "reference_code", "reference_name", "label_id", "num_cliente", "num_manuales", "is_trained_elastic",
           "pct_ok_sistema", "pct_ok_modelo", "revisar_imagenes"] + [
    f"top{i}_{c}" for i in (1, 2, 3) for c in ("result_index", "result_label_name", "pct_pesadas", "pct_ok")]


@query("reference_metrics", "select " + ", ".join(METRICS) + " from {fx_analysed}")
def reference_metrics_query(f: Fleet) -> DataFrame:
    return analysed(f).select(*METRICS)


@query("top3_results", """
    select r.reference_id, """ + ", ".join(
    f"""t{i}.result_index as top{i}_result_index, t{i}.result_label_name as top{i}_result_label_name,
    coalesce(round(100.0 * t{i}.n / m.num_cliente, 2), 0.0) as top{i}_pct_pesadas, coalesce(round(100.0 * t{i}.ok / t{i}.n, 2), 0.0) as top{i}_pct_ok"""
    for i in (1, 2, 3)) + """
    from {fx_references} r join {fx_metrics} m on r.reference_id = m.reference_id and m.num_cliente > 0
    """ + " ".join(f"left join {{fx_top3}} t{i} on r.reference_id = t{i}.reference_id and t{i}.rn = {i}" for i in (1, 2, 3)))
def _(f: Fleet) -> DataFrame:
    return references.top3_results(f.tx, f.catalogue)


@query("device_metrics", "select * from {fx_devices}")
def _(f: Fleet) -> DataFrame:
    return devices.device_metrics(f.tx, models.active_model(f.tx))


@query("reference_stats", """
    select deployment_id, selected_reference_code as reference_code, count(*) as total_transactions, count(*) filter (where is_client) as client_transactions,
           count(*) filter (where is_manual) as manual_transactions, count(*) filter (where trained) as trained_transactions,
           count(*) filter (where selected_reference_is_trained = false) as not_trained_transactions,
           round(100.0 * count(*) filter (where trained) / count(*), 2) as training_percentage
    from {fx_tx} where selected_reference_code is not null group by 1, 2""")
def _(f: Fleet) -> DataFrame:
    return references.reference_stats(f.tx)


# a fleet in one frame: codes and names repeat among deployments


@query("fleet_transactions_by_reference", "select reference_id, matched_by, transaction_id from {fx_fleet_matches}")
def _(f: Fleet) -> DataFrame:
    return references.transactions_by_reference(f.tx, f.derived("fx_fleet_products")).select("reference_id", "matched_by", "transaction_id")


_FLEET_COUNTS = """(select reference_id, count(*) filter (where is_client) as num_cliente, count(*) filter (where is_manual) as num_manuales,
           count(*) filter (where is_client and trained) as trained_count from {fx_fleet_matches} group by 1)"""


@query("fleet_reference_metrics", """
    select p.reference_id, p.deployment_id, coalesce(num_cliente, 0) as num_cliente, coalesce(num_manuales, 0) as num_manuales,
           coalesce(trained_count, 0) as trained_count
    from {fx_fleet_products} p left join """ + _FLEET_COUNTS + " m on p.reference_id = m.reference_id")
def _(f: Fleet) -> DataFrame:
    return references.reference_metrics(f.tx, f.derived("fx_fleet_products"), models.active_model(f.tx)).select(
        "reference_id", "deployment_id", "num_cliente", "num_manuales", "trained_count")


@query("fleet_frequent_references", """
    select p.reference_id, p.deployment_id, cliente_appearances from {fx_fleet_products} p
    join (select deployment_id, selected_reference_code as code, count(*) filter (where is_client) as cliente_appearances from {fx_tx} group by 1, 2) n
         on p.deployment_id = n.deployment_id and p.reference_code = n.code where cliente_appearances >= 2""")
def _(f: Fleet) -> DataFrame:
    return references.frequent_references(f.tx, f.derived("fx_fleet_products"), 2).select("reference_id", "deployment_id", "cliente_appearances")


@query("fleet_training_status", """
    select p.reference_id, p.reference_code, n.num_cliente, c.class_name as producto_trained, c.class_name is not null as is_in_dataset
    from {fx_fleet_products} p
         join (select deployment_id, selected_reference_code as code, count(*) filter (where is_client) as num_cliente from {fx_tx} group by 1, 2) n
              on p.deployment_id = n.deployment_id and p.reference_code = n.code and num_cliente >= 1
         left join (select model_id, label_id, arg_min(class_name, class_pos * 10 + label_pos) as class_name from {fx_fleet_classes} where label_id is not null group by 1, 2) c
              on c.model_id = p.deployment_id * 10 and cast(p.label_id as bigint) = c.label_id""")
def _(f: Fleet) -> DataFrame:
    return references.training_status(
        f.tx, f.derived("fx_fleet_products"), f.derived("fx_fleet_classes"), f.derived("fx_labels"), 1, f.derived("fx_fleet_models")
    ).select("reference_id", "reference_code", "num_cliente", "producto_trained", "is_in_dataset")


FLEET_COLUMNS = [*METRICS, "deployment_id", "label_name", "producto_trained", "is_in_dataset", "trained_count"]


def fleet_analysed(f: Fleet) -> DataFrame:
    return quality.complete_analysis(
        f.tx, f.derived("fx_fleet_products"), f.derived("fx_labels"), f.derived("fx_fleet_classes"), deployments=f.derived("fx_fleet_models")
    )["complete_analysis"]


@query("fleet_complete_analysis", "select " + ", ".join(FLEET_COLUMNS) + " from {fx_fleet_analysed}")
def _(f: Fleet) -> DataFrame:
    return fleet_analysed(f).select(*FLEET_COLUMNS)


_EDITED = """case when num_cliente >= 2 then 'si' else 'no' end as incluir_dataset, case when num_cliente >= 2 then 150 end as num_imagenes_dataset,
           case when num_cliente >= 2 then producto_trained end as producto_a_entrenar, case when num_cliente >= 2 then label_id end as label_considerar"""


@query("fleet_consolidated_references", "select " + ", ".join(c for c in FLEET_COLUMNS if c != "label_id") + ", cast(label_id as string) as label_id, " + _EDITED + " from {fx_fleet_analysed}")
def _(f: Fleet) -> DataFrame:
    found = reports.consolidated_references(f.derived("fx_fleet_products"), fleet_analysed(f), 2, fleet=True)
    return found.select(*FLEET_COLUMNS, "incluir_dataset", "num_imagenes_dataset", "producto_a_entrenar", "label_considerar")


@query("fleet_download_stats_join", """
    select p.reference_id, p.deployment_id, p.reference_code, coalesce(d.downloaded, 0) as imagenes_descargadas, coalesce(d.total_urls, 0) as total_urls_encontradas,
           printf('%.1f%%', round(coalesce(d.success_rate, 0), 1)) as tasa_exito_descarga, coalesce(d.output_directory, 'N/A') as directorio_imagenes,
           coalesce(cast(s.confident_suggestion as string), 'N/A') as sugerencia_confiable, coalesce(cast(s.main_suggestion_label_id as string), 'N/A') as sugerencia_principal,
           printf('%.1f%%', round(coalesce(cast(s.main_suggestion_percentage as double), 0), 1)) as porcentaje_sugerencia, coalesce(s.suggestion_confidence, 'Sin datos') as nivel_confianza
    from {fx_fleet_products} p left join {fx_fleet_downloads} d on p.deployment_id = d.deployment_id and p.reference_code = d.reference_code
         left join {fx_fleet_suggestions} s on p.deployment_id = s.deployment_id and p.reference_code = s.reference_code""")
def _(f: Fleet) -> DataFrame:
    from weighlens.operators.suggestions import download_stats_join
    products = f.derived("fx_fleet_products").select("reference_id", "deployment_id", "reference_code")
    return download_stats_join(products, f.derived("fx_fleet_downloads"), f.derived("fx_fleet_suggestions"))


@query("training_status", """
    select r.reference_id, r.reference_code, r.reference_name, l.label_id,
           case when l.label_id is null then 'NO_LABEL_ASSIGNED' else coalesce(b.label_name, 'LABEL_ID_' || cast(l.label_id as string) || '_NOT_FOUND') end as label_name,
           cliente_appearances as num_cliente, num_manuales, trained_count / cliente_appearances >= 0.5 as is_trained_elastic,
           c.label_id is not null as is_in_dataset, first_class as producto_trained, trained_count, not_trained_count, cliente_appearances
    from {fx_references} r join """ + _FREQUENT + """ n on r.reference_code = n.reference_code
         join {fx_label_of_reference} l on r.reference_id = l.reference_id
         left join {fx_labels} b on l.label_id = b.label_id left join {fx_class_of_label} c on l.label_id = c.label_id""")
def _(f: Fleet) -> DataFrame:
    return references.training_status(f.tx, f.catalogue, f.derived("fx_classes"), f.derived("fx_labels"))


@query("complete_analysis", """
    select 'complete_analysis' as part, count(*) as n, cast(sum(num_cliente) as bigint) as total from {fx_analysed}
    union all select 'filtered_references', count(*), cast(sum(num_cliente) as bigint) from {fx_analysed} where num_cliente >= 5
    union all select 'client_transactions', count(*), cast(sum(Ok) as bigint) from {fx_tx} where is_client
    union all select 'manual_transactions', count(*), cast(sum(Ok) as bigint) from {fx_tx} where is_manual
    union all select 'devices_analysis', count(*), cast(sum(num_cliente) as bigint) from {fx_devices}""")
def _(f: Fleet) -> DataFrame:
    parts = quality.complete_analysis(f.tx, f.catalogue, f.derived("fx_labels"), f.derived("fx_classes"))
    measure = {"complete_analysis": "num_cliente", "filtered_references": "num_cliente", "client_transactions": "Ok",
               "manual_transactions": "Ok", "devices_analysis": "num_cliente"}
    rows = [parts[p].agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("total")).select(F.lit(p).alias("part"), "n", "total")
            for p, c in measure.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_STATS = """(select count(*) as total_references, count(*) filter (where is_trained_elastic) as trained_references,
    count(*) filter (where is_in_dataset) as in_model_references, cast(sum(num_cliente) as bigint) as clients,
    cast(sum(num_manuales) as bigint) as manuals, cast(sum(trained_count) as bigint) as trained_rows from {fx_analysed})"""


@query("summary_stats", """
    select total_references, total_references as total_filtered_references, trained_references, total_references - trained_references as not_trained_references,
           total_references - trained_references as untrained_count, round(100.0 * trained_references / total_references, 2) as training_percentage,
           in_model_references, total_references - in_model_references as not_in_model_references,
           round(100.0 * in_model_references / total_references, 2) as model_coverage_percentage,
           clients as total_client_transactions, manuals as total_manual_transactions, trained_rows as total_trained_transactions,
           cast(0 as bigint) as unassigned_count, cast(0 as bigint) as high_confidence_suggestions, cast(0 as bigint) as low_confidence_suggestions,
           cast(0 as bigint) as total_unassigned, cast(0 as bigint) as consistent_references
    from """ + _STATS + " s")
def _(f: Fleet) -> DataFrame:
    return reports.summary_stats(analysed(f))


_COUNT = "select '{0}' as metric, cast(count(*) as string) as value from {{{1}}} {2}"


@query("executive_summary", " union all ".join([
    _COUNT.format("Total registros Elasticsearch", "fx_tx", ""), _COUNT.format("Total referencias", "fx_references", ""),
    _COUNT.format("Total labels", "fx_labels", ""),
    "select 'Model ID ' || deployment_id, cast(model_id as string) from {fx_active}",
    "select 'Frecuencia ' || deployment_id, cast(frequency as string) from {fx_active}",
    "select 'Porcentaje uso ' || deployment_id, printf('%.1f%%', round(percentage, 1)) from {fx_active}",
    _COUNT.format("Referencias filtradas", "fx_references", ""),
    *[f"select '{m}', '0'" for m in ("Referencias sin asignar", "Sugerencias alta confianza", "Sugerencias baja confianza")],
    _COUNT.format("Referencias no entrenadas", "fx_analysed", "where not is_trained_elastic"),
    _COUNT.format("Total devices", "fx_devices", ""),
    _COUNT.format("Devices activos (>50 trans)", "fx_devices", "where num_cliente > 50"),
    _COUNT.format("Devices con revisar_imagenes=si", "fx_devices", "where revisar_imagenes = 'si'"),
]))
def _(f: Fleet) -> DataFrame:
    active = models.active_model(f.tx)
    return reports.executive_summary(
        f.tx, f.catalogue, f.derived("fx_labels"), active,
        reports.summary_stats(analysed(f)), devices.device_metrics(f.tx, active))


@query("consistency_report", " union all ".join([
    _COUNT.format("Total referencias procesadas", "fx_references", ""), "select 'Referencias sin asignar', '0'",
    _COUNT.format("Referencias no entrenadas", "fx_analysed", "where not is_trained_elastic"),
    _COUNT.format("Referencias entrenadas", "fx_analysed", "where is_trained_elastic"),
    _COUNT.format("Total devices analizados", "fx_devices", ""),
    _COUNT.format("Devices con transacciones > 100", "fx_devices", "where num_cliente > 100"),
    _COUNT.format("Devices con transacciones > 50", "fx_devices", "where num_cliente > 50"),
]))
def _(f: Fleet) -> DataFrame:
    return reports.consistency_report(reports.summary_stats(analysed(f)), devices.device_metrics(f.tx))


@query("one_sided_references", """
    (select 'SOLO SIN ASIGNAR' as categoria, reference_code from {fx_analysed} where label_id is null and is_trained_elastic)
    union all
    (select 'SOLO NO ENTRENADAS', reference_code from {fx_analysed} where label_id is not null and not is_trained_elastic)""")
def _(f: Fleet) -> DataFrame:
    rows = analysed(f)
    return reports.one_sided_references(rows.filter("label_id is null"), rows.filter("not is_trained_elastic"))


@query("active_model", "select * from {fx_active}")
def _(f: Fleet) -> DataFrame:
    return models.active_model(f.tx)


@query("active_model_recent", """
    select deployment_id, model_id, frequency, total_records, 100.0 * frequency / total_records as percentage
    from (select *, cast(sum(frequency) over (partition by deployment_id) as bigint) as total_records,
                 row_number() over (partition by deployment_id order by (model_id is null), frequency desc, model_id) as rn
          from (select deployment_id, model_id, count(*) as frequency
                from (select *, row_number() over (partition by deployment_id order by transaction_start_time desc, transaction_id) as k from {fx_tx}) a
                where k <= 25 group by 1, 2) b) c
    where rn = 1 and model_id is not null""")
def _(f: Fleet) -> DataFrame:
    """Fewer rows than any deployment has, so that the cut is met."""
    return models.active_model(f.tx, recent=25)


def _states(f: Fleet) -> day_states.DayStates:
    """All transactions in a state that was extended twice: by the files of the first years, then by the rest."""
    source, folder = shared_dir(f.spark, "arriving"), shared_dir(f.spark, "day-states")
    state = day_states.DayStates(f.spark, folder, f.raw.schema, labelling.label_transactions)
    later = F.col("transaction_start_time") >= F.lit("1996-01-01").cast("timestamp_ntz")
    for part in (~later, later):
        f.raw.filter(part).write.mode("append").parquet(source)
        state.extend(source)
    return state


@query("active_model_states", "select * from {fx_active}")
def _(f: Fleet) -> DataFrame:
    return _states(f).active_model()


@query("device_metrics_states", "select * from {fx_devices}")
def _(f: Fleet) -> DataFrame:
    state = _states(f)
    return state.device_metrics(state.active_model())


@query("active_model_overall", """
    select model_id, count(*) as frequency, cast(1000 as bigint) as total_records, 100.0 * count(*) / 1000 as percentage
    from (select model_id from {fx_tx} order by transaction_start_time, transaction_id limit 1000) a
    group by 1 order by 2 desc, 1 limit 1""")
def _(f: Fleet) -> DataFrame:
    return models.active_model(f.tx, newest=False, per_deployment=False)


@query("consolidated_references", """
    select a.reference_id, a.reference_code, a.reference_name, r.label_id, label_name, producto_trained, is_in_dataset, num_cliente, num_manuales,
           is_trained_elastic, pct_ok_sistema, pct_ok_modelo, case when num_cliente >= 8 then 'si' else 'no' end as incluir_dataset,
           case when num_cliente >= 8 then 150 end as num_imagenes_dataset, top1_result_index
    from {fx_analysed} a join {fx_references} r on a.reference_id = r.reference_id""")
def _(f: Fleet) -> DataFrame:
    return reports.consolidated_references(f.catalogue, analysed(f), 8).select(
        "reference_id", "reference_code", "reference_name", "label_id", "label_name", "producto_trained", "is_in_dataset", "num_cliente",
        "num_manuales", "is_trained_elastic", "pct_ok_sistema", "pct_ok_modelo", "incluir_dataset", "num_imagenes_dataset", "top1_result_index")


@query("model_class_table", """
    select c.model_id, c.model_code, c.class_index, c.class_name, c.label_id,
           case when c.label_id is null then '' else coalesce(b.label_name, 'Label ' || cast(c.label_id as string)) end as label_name
    from {fx_classes} c left join {fx_labels} b on c.label_id = b.label_id""")
def _(f: Fleet) -> DataFrame:
    return reports.model_class_table(f.derived("fx_classes"), f.derived("fx_labels"))


@query("candidate_pairs", """
    with entries as (
        select deployment_id, result_index, selected_reference_code as code, selected_reference_name as name,
               case when selected_reference_is_trained then 'True' when not selected_reference_is_trained then 'False' else 'None' end as flag from {fx_tx}
        union all
        select deployment_id, result_index, unnest(predicted_codes[1:len(predicted_names)]), unnest(predicted_names), null from {fx_tx}),
    kept as (select * from entries where result_index is not null and code is not null and name is not null),
    flags as (select deployment_id, result_index, code, name, flag, row_number() over (partition by deployment_id, result_index, code, name order by count(*) desc, flag) as rn
              from kept where flag is not null group by 1, 2, 3, 4, 5),
    counts as (select deployment_id, result_index, code, name, count(flag) as veces_seleccionado, count(*) - count(flag) as veces_en_lista
               from kept group by 1, 2, 3, 4)
    select c.result_index as "Result_index", coalesce(d.label_name, '') as producto, c.code as selected_reference, c.name as reference_name,
           case when p.valid then 'Válida' else 'No válida' end as validacion, p.valid is not null as pareja_en_fichero_ref,
           veces_seleccionado, veces_en_lista, coalesce(g.flag, 'False') as is_trained, c.deployment_id
    from counts c
         left join flags g on g.rn = 1 and c.deployment_id = g.deployment_id and c.result_index = g.result_index and c.code = g.code and c.name = g.name
         left join {fx_pairs} p on cast(c.deployment_id as string) = p.deployment_id and c.result_index = p.result_index and cast(cast(c.code as bigint) as string) = p.code
         left join {fx_descriptions} d on cast(c.deployment_id as string) = d.deployment_id and c.result_index = d.label_index""")
def _(f: Fleet) -> DataFrame:
    return pairs.candidate_pairs(f.tx, f.pairs, f.descriptions)


@query("undefined_pairs", """
    with entries as (select deployment_id, result_index, selected_reference_code as code, 1 as chosen from {fx_tx}
                     union all select deployment_id, result_index, unnest(predicted_codes), 0 from {fx_tx}),
    missing as (select e.* from entries e left join {fx_pairs} p on cast(e.deployment_id as string) = p.deployment_id and e.result_index = p.result_index
                     and cast(cast(e.code as bigint) as string) = p.code where e.code is not null and p.valid is null)
    select d.deployment_id, coalesce(n, 0) as num_parejas_no_definidas, coalesce(s, 0) as num_veces_seleccionadas, coalesce(l, 0) as num_veces_listas
    from (select distinct deployment_id from {fx_tx}) d left join
         (select deployment_id, count(distinct coalesce(cast(result_index as string), '-') || '|' || code) as n, cast(sum(chosen) as bigint) as s,
                 cast(sum(1 - chosen) as bigint) as l from missing group by 1) m on d.deployment_id = m.deployment_id""")
def _(f: Fleet) -> DataFrame:
    return pairs.undefined_pairs(f.tx, f.pairs)


RUN_SUMMARY = """
    with pairs_of as (select x.transaction_id, count(*) as good from (select transaction_id, deployment_id, result_index, unnest(predicted_codes) as code from {fx_tx}) x
               join {fx_pairs} p on cast(x.deployment_id as string) = p.deployment_id and x.result_index = p.result_index and cast(cast(x.code as bigint) as string) = p.code
               where p.valid group by 1),
    rows_of as (select t.*, coalesce(len(t.predicted_codes), 0) as n, coalesce(good, 0) as good, i.has_image, i.num_images, p.valid as chosen_valid, a.pct_ok_modelo as expected,
                       act.device_id is not null as listed, act.activated_at
                from {fx_tx} t join {fx_images} i on t.transaction_id = i.transaction_id left join pairs_of g on t.transaction_id = g.transaction_id
                     left join {fx_pairs} p on cast(t.deployment_id as string) = p.deployment_id and t.result_index = p.result_index and cast(cast(t.selected_reference_code as bigint) as string) = p.code
                     left join {fx_accuracy} a on t.deployment_id = a.deployment_id and t.selected_reference_code = a.selected_reference_code
                     left join {fx_activations} act on cast(t.device_id as string) = act.device_id),
    states as (select *, case when listed and transaction_start_time >= coalesce(activated_at, (select min(transaction_start_time) - interval 1 month from {fx_tx})) then 'Encendido' else 'Silencioso' end as state,
                      case when not listed then 'No en archivo' when activated_at is null then 'Sin fecha' else strftime(activated_at, '%Y-%m-%d') end as day from rows_of),
    m as (""" + " union all ".join(f"select '{n}' as metric, {e} as value from states" for n, e in {
    "records": "count(*)", "lista_larga": "count(*) filter (where n > 6)", "lista_un_candidato": "count(*) filter (where n = 1)",
    "top_k_0": "count(*) filter (where topk = 0)", "top_k_medio": "count(*) filter (where topk between 1 and 4)", "top_k_alto": "count(*) filter (where topk > 4)",
    "is_trained": "count(*) filter (where trained)", "lista_similar_completa": "count(*) filter (where n > 0 and good = n)",
    "producto_seleccionado_similar": "count(*) filter (where chosen_valid)", "model_ok_general_fail": "count(*) filter (where Ok_modelo = 1 and Result = 'Error')",
    "no_clasificado": "count(*) filter (where topk is null or topk = -1)", "expected_accuracy": "count(*) filter (where expected is not null)",
    "no_similares": "count(*) filter (where good < n)", "similares": "count(*) filter (where good > 0)",
    "with_image": "count(*) filter (where has_image = 1)", "images": "cast(sum(num_images) as bigint)"}.items()) + """),
    und as (select e.deployment_id, count(distinct coalesce(cast(e.result_index as string), '-') || '|' || e.code) as n, cast(sum(chosen) as bigint) as s, cast(sum(1 - chosen) as bigint) as l
            from (select deployment_id, result_index, selected_reference_code as code, 1 as chosen from {fx_tx} union all select deployment_id, result_index, unnest(predicted_codes), 0 from {fx_tx}) e
                 left join {fx_pairs} p on cast(e.deployment_id as string) = p.deployment_id and e.result_index = p.result_index and cast(cast(e.code as bigint) as string) = p.code
            where e.code is not null and p.valid is null group by 1)
    select 'totals' as section, metric, value from m
    union all select 'device_status', state, count(*) from states group by 2
    union all select * from (select 'activation', day, count(*) from states group by 2) x
    union all select 'undefined_pairs', 'deployments', count(*) from und
    union all select 'undefined_pairs', 'num_parejas_no_definidas', cast(sum(n) as bigint) from und
    union all select 'undefined_pairs', 'num_veces_seleccionadas', cast(sum(s) as bigint) from und
    union all select 'undefined_pairs', 'num_veces_listas', cast(sum(l) as bigint) from und"""


@query("run_summary", RUN_SUMMARY)
def _(f: Fleet) -> DataFrame:
    processed = candidates.processed_transactions(
        f.tx, f.pairs, f.activations, f.derived("fx_folders"), models.accuracy_stats(f.tx, 2))
    return reports.run_summary(processed, pairs.undefined_pairs(f.tx, f.pairs))


@query("download_stats_join", """
    select a.reference_code, coalesce(d.downloaded, 0) as imagenes_descargadas, coalesce(d.total_urls, 0) as total_urls_encontradas,
           printf('%.1f%%', round(coalesce(d.success_rate, 0), 1)) as tasa_exito_descarga, coalesce(d.output_directory, 'N/A') as directorio_imagenes,
           cast(s.confident_suggestion as string) as sugerencia_confiable, cast(s.main_suggestion_label_id as string) as sugerencia_principal,
           printf('%.1f%%', round(cast(s.main_suggestion_percentage as double), 1)) as porcentaje_sugerencia, s.suggestion_confidence as nivel_confianza
    from {fx_analysed} a left join {fx_downloads} d on a.reference_code = d.reference_code left join {fx_suggestions} s on a.reference_code = s.reference_code
    where not a.is_trained_elastic""")
def _(f: Fleet) -> DataFrame:
    from weighlens.operators.suggestions import download_stats_join
    untrained = analysed(f).filter("not is_trained_elastic").select("reference_code")
    return download_stats_join(untrained, f.derived("fx_downloads"), f.derived("fx_suggestions"))


@query("folder_structure", """
    with direct as (select dataset || '/' || class || '/' || label_id as folder, count(*) as n from {fx_files} where lower(filename) like '%.jpg' group by 1),
         folders as (select * from direct union all select dataset || '/' || class, count(*) from {fx_files} where dataset = 'b' and lower(filename) like '%.jpg' group by 1)
    select string_split(folder, '/')[1] as dataset_name, string_split(folder, '/')[-2] as product, string_split(folder, '/')[-1] as label_id,
           substr(folder, 3) as folder_rel, n as images_count
    from folders where len(string_split(folder, '/')) = 3""")
def _(f: Fleet) -> DataFrame:
    """Set b also has images one level up: those folders have sub-folders with images."""
    from weighlens.operators.datasets import folder_structure
    files = f.derived("fx_files")
    deep = files.select(F.concat_ws("/", "dataset", "class", "label_id", "filename").alias("path"))
    upper = files.filter("dataset = 'b'").select(F.concat_ws("/", "dataset", "class", "filename").alias("path"))
    return folder_structure(deep.unionByName(upper))


@query("image_coverage", """
    select count(*) as rows_total, count(*) filter (where has_image = 1) as with_image, cast(sum(num_images) as bigint) as images from {fx_images}""")
def _(f: Fleet) -> DataFrame:
    return with_links(f).agg(
        F.count(F.lit(1)).alias("rows_total"), F.count_if(F.col("has_image") == 1).alias("with_image"),
        F.sum("num_images").cast("bigint").alias("images"))
