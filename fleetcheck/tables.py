"""Domain tables derived from the given tables, for Spark and as SQL text.

Every table uses all rows of what it is derived from, so all of them grow with the data:
one transaction per order, one product per part, one label per supplier, one device per
customer.  Small tables have one SQL text for both engines; the transactions are built
with the DataFrame API for Spark and have their own SQL text for the other engine.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from weighlens.operators.labelling import label_transactions
from weighlens.plans.extract import transaction_extract
from weighlens.sources.lookups import load_activations, load_product_descriptions, load_valid_pairs
from weighlens.storage import shared_dir

AS_OF = datetime(1998, 6, 15, 10, 30)

LINES_PER_TASK = 1_000_000  # about 150 MB of memory to sort them

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# SQL valid in both engines; {name} is a given or derived table.
SHARED = {
    "fx_references": """
        select p_partkey as reference_id, lpad(cast(p_partkey as string), 7, '0') as reference_code,
               upper(p_name) || ' ' || cast(p_partkey as string) as reference_name,
               case when p_size <= 45 then cast(cast(floor(p_partkey / 18.0) as bigint) as string)
                    || case when p_type = 'MEDIUM' then '.0' else '' end end as label_id,
               cast(floor(p_size / 2.0) as int) as deployment_id
        from {part}""",
    "fx_labels": """
        select s_suppkey as label_id, 'LABEL ' || cast(s_suppkey as string) as label_name from {supplier}""",
    "fx_deployments": """
        select n_nationkey as deployment_id,
               case when n_nationkey in (7, 15, 23) then null when n_nationkey = 24 then 0
                    else n_nationkey * 10 end as model_id
        from {nation}""",
    "fx_models": """
        select s_suppkey as model_id, s_name as model_code,
               case when s_acctbal < 1000 then 'broken {{'
                    when s_acctbal < 4000 then '{{"classes":' || list || '}}' else list end as model_data
        from (select *, '[{{"index":' || c || ',"index_name":"class_' || c || '","trained_labels":[' || l || ',' || (n) ||
                     ']}},{{"index":' || l || ',"index_name":"class_' || l || '","trained_labels":[]}}]' as list
              from (select s_suppkey, s_name, s_acctbal, cast(s_nationkey as string) as c,
                           cast(s_suppkey as string) as l, cast(s_suppkey + 1 as string) as n from {supplier}) a) b""",
    "fx_classes": """
        select cast(1 as bigint) as model_id, 'M1' as model_code, k as class_pos, k as class_index,
               'class_' || cast(k as string) as class_name, cast(s_suppkey - 3 * k as int) as label_pos,
               case when s_acctbal >= 1000 then s_suppkey end as label_id
        from (select s_suppkey, s_acctbal, cast(floor(s_suppkey / 3.0) as int) as k from {supplier}) a
        union all
        select cast(1 as bigint), 'M1', k + 1, k + 1, 'class_' || cast(k + 1 as string), 3, s_suppkey
        from (select s_suppkey, s_acctbal, cast(floor(s_suppkey / 3.0) as int) as k from {supplier}) a
        where s_acctbal >= 9000""",
    "fx_descriptions_raw": """
        select cast(s_nationkey as string) as deployment_id,
               case when s_acctbal < 0 then 'n/a' when s_acctbal < 5000 then cast(k as string) || '.0'
                    else ' ' || cast(k as string) || ' ' end as label_index,
               ' ' || s_name || ' ' as label_name, s_suppkey as row_no
        from (select *, cast(floor(s_suppkey / 3.0) as bigint) as k from {supplier}) a""",
    "fx_activations_raw": """
        select case when c_mktsegment = 'BUILDING' then cast(c_custkey as string) || '.0'
                    else ' ' || cast(c_custkey as string) end as device_id,
               case when c_mktsegment = 'FURNITURE' then null
                    when c_mktsegment = 'AUTOMOBILE' then '1998-0' || m || '-15'
                    when c_mktsegment = 'HOUSEHOLD' then '15/0' || m || '/1999'
                    else '1997-0' || m || '-15 08:30:00' end as fecha_encendido,
               c_custkey as row_no
        from (select *, cast(c_nationkey - 9 * cast(floor(c_nationkey / 9.0) as int) + 1 as string) as m from {customer}) a
        where c_mktsegment <> 'MACHINERY'""",
    "fx_decisions": """
        select p_partkey as reference_id, lpad(cast(p_partkey as string), 7, '0') as reference_code,
               upper(p_name) || ' ' || cast(p_partkey as string) as reference_name,
               case when p_type = 'STANDARD' then 'si' when p_type = 'ECONOMY' then ' Sí '
                    when p_type = 'MEDIUM' then null when p_type = 'LARGE' then 'si' else 'no' end as incluir_dataset,
               case when p_size < 4 then 'SI' when p_size < 7 then 'yes' else 'no' end as revisar_imagenes,
               case when p_type <> 'LARGE' then cast(floor(p_size / 10.0) as int) + 1 end as num_imagenes_dataset,
               case when p_size <> 50 then ' class_' || cast(cast(floor(p_partkey / 54.0) as bigint) as string) end as producto_a_entrenar,
               case when p_size = 49 then 'x' else cast(cast(floor(p_partkey / 18.0) as bigint) as string) end as label_considerar,
               case when p_type <> 'ECONOMY' then 'LABEL ' || cast(cast(floor(p_partkey / 18.0) as bigint) as string) end as label_name,
               case when p_size <= 45 then cast(floor(p_partkey / 18.0) as bigint) end as label_id,
               cast(floor(p_partkey / 54.0) as int) as top1_result_index,
               'LABEL ' || cast(cast(floor(p_partkey / 18.0) as bigint) as string) as top1_result_label_name,
               cast(floor(p_partkey / 54.0) as int) + 1 as top2_result_index,
               case when p_size > 2 then 'label ' || cast(cast(floor(p_partkey / 18.0) as bigint) + 3 as string) end as top2_result_label_name,
               cast(null as int) as top3_result_index, cast(null as string) as top3_result_label_name
        from {part}""",
    "fx_device_decisions": """
        select cast(c_custkey as double) as device_id, c_name as device_name,
               case when c_mktsegment = 'MACHINERY' then 'no' when c_mktsegment = 'BUILDING' then 'Sí' else 'si' end as incluir_dataset,
               case when c_mktsegment = 'HOUSEHOLD' then 'sí' else 'no' end as revisar_imagenes,
               case when c_mktsegment = 'BUILDING' then 4 when c_mktsegment = 'AUTOMOBILE' then 2
                    when c_mktsegment = 'FURNITURE' then 0 end as num_imagenes_dataset_adicionales
        from {customer}""",
    "fx_used": """
        select cast(o_orderkey as string) as transaction_id from {orders} where o_orderstatus = 'F'""",
    "fx_registry": """
        select 'set_' || c_name as dataset_name, '01/02/1998' as created_at, cast(c_nationkey as string) as deployment_id,
               case when c_acctbal > 0 then cast(c_custkey as string) end as trained_model, c_mktsegment as description,
               's3://sets/' || c_name as s3_path
        from {customer} where c_mktsegment in ('BUILDING', 'MACHINERY')""",
    "fx_registry_new": """
        select 'set_' || c_name as dataset_name, '15/06/1998' as created_at, cast(c_nationkey as string) as deployment_id,
               cast(c_custkey as string) as trained_model, c_mktsegment as description, 's3://new/' || c_name as s3_path
        from {customer} where c_mktsegment in ('BUILDING', 'HOUSEHOLD')""",
    "fx_downloads": """
        select lpad(cast(p_partkey as string), 7, '0') as reference_code, cast(p_size as bigint) as downloaded,
               cast(p_size + 3 as bigint) as total_urls, 1e2 * p_size / (p_size + 3) as success_rate,
               'out/' || cast(p_partkey as string) as output_directory
        from {part} where p_type in ('PROMO', 'LARGE')""",
    # one catalogue per deployment: every code of a deployment's transactions, so codes and names repeat among deployments
    "fx_fleet_products": """
        select cast(d.deployment_id as bigint) * 100000000 + p_partkey as reference_id, lpad(cast(p_partkey as string), 7, '0') as reference_code,
               upper(p_name) || ' ' || cast(p_partkey as string) as reference_name,
               cast(cast(floor(p_partkey / 18.0) as bigint) + d.deployment_id as string) as label_id, d.deployment_id
        from (select distinct deployment_id, selected_reference_name as name from {fx_flat} where selected_reference_name is not null) d
             join {part} on d.name = upper(p_name) || ' ' || cast(p_partkey as string)""",
    "fx_fleet_models": """
        select nation as deployment_id, nation * 10 as model_id from (select distinct deployment_id as nation from {fx_flat}) a""",
    "fx_fleet_classes": """
        select m.model_id, c.class_pos, c.label_pos, c.label_id, c.class_name || '_of_' || cast(m.model_id as string) as class_name
        from (select x.*, class_pos % 25 as d from {fx_classes} x union all select x.*, (class_pos + 1) % 25 from {fx_classes} x
              union all select x.*, (class_pos + 7) % 25 from {fx_classes} x) c join {fx_fleet_models} m on c.d = m.deployment_id""",
    "fx_fleet_decisions": """
        select reference_id, reference_code, reference_name, deployment_id, case when reference_id % 4 < 3 then 'si' else 'no' end as incluir_dataset,
               case when reference_id % 50 < 4 then 'SI' when reference_id % 50 = 7 then 'yes' else 'no' end as revisar_imagenes,
               cast(reference_id % 3 as int) + 1 as num_imagenes_dataset, 'class_' || label_id as producto_a_entrenar, label_id as label_considerar,
               'LABEL ' || label_id as label_name, cast(label_id as bigint) as label_id, cast(cast(label_id as bigint) % 40 as int) as top1_result_index,
               'LABEL ' || cast(cast(floor((reference_id % 100000000) / 18.0) as bigint) as string) as top1_result_label_name,
               cast(3 as int) as top2_result_index,
               case when reference_id % 2 = 0 then 'label ' || cast(cast(floor((reference_id % 100000000) / 18.0) as bigint) + 3 as string) end as top2_result_label_name,
               cast(null as int) as top3_result_index, cast(null as string) as top3_result_label_name
        from {fx_fleet_products}""",
    "fx_fleet_downloads": """
        select deployment_id, reference_code, reference_id % 9 as downloaded, reference_id % 9 + 3 as total_urls,
               1e2 * (reference_id % 9) / (reference_id % 9 + 3) as success_rate, 'out/' || cast(reference_id as string) as output_directory
        from {fx_fleet_products} where reference_id % 3 = 0""",
    "fx_fleet_suggestions": """
        select deployment_id, reference_code, reference_id % 2 = 0 as confident_suggestion, reference_id % 11 as main_suggestion_label_id,
               (reference_id % 70) * 15e-1 as main_suggestion_percentage, 'level ' || cast(reference_id % 5 as string) as suggestion_confidence
        from {fx_fleet_products} where reference_id % 5 > 0""",
    "fx_fleet_urls": """
        select deployment_id, transaction_id, transaction_start_time, selected_reference_code as reference_code, first_code as product_code,
               'http://img.example/' || first_code || '.png?x=1' as image_url,
               case when confidence = 'LOW' then 'thumb/none' else '/thumb/' || transaction_id || '.bmp' end as thumb_image_url
        from {fx_flat}""",
    # from the transactions
    "fx_folders": """
        select transaction_id,
               case when not (transaction_metric = 'WSREFERENCEIMAGEAC01' and model_id <> deployment_id * 10)
                    then 'folders/' || cast(deployment_id as string) || '/' || transaction_id || '/' end as folder_url,
               case when confidence = 'LOW' and transaction_metric = 'WSREFERENCEIMAGEAC01' then 'broken'
                    when confidence = 'LOW' then '[]' else files_text end as folder_files
        from {fx_flat} where predicted_codes is not null""",
    "fx_listing": """
        select folder_url || code || case when confidence = 'HIGH' then '.JPG' else '.jpg' end as path
        from {fx_listed} where folder_url is not null""",
    "fx_pairs_raw": """
        select cast(deployment_id as string) as deployment_id,
               cast(result_index as string) || case when confidence = 'LOW' and transaction_metric = 'WSREFERENCEIMAGEAC01'
                    then 'x' else '' end as result_index,
               cast(cast(code as bigint) as string) as selected_reference,
               case when confidence = 'HIGH' then ' Sí ' when confidence = 'MEDIUM' then 'no' else 'TRUE' end as valida
        from {fx_entries} where model_id = deployment_id * 10""",
    "fx_files": """
        select s as dataset, o as set_order, 'class_' || cast(selected_reference_index as string) as class,
               cast(label as string) as label_id,
               day_text || '000000_' || transaction_id || '_img_1' || case when confidence = 'LOW' then '.txt' else '.JPG' end as filename
        from (select 'a' as s, 1 as o, f.* from {fx_flat} f where transaction_metric in ('WSREFERENCEIMAGEAC01', 'WSPROCESSCOMPLETED03')
              union all
              select 'b', 2, f.* from {fx_flat} f where transaction_metric = 'WSPROCESSCOMPLETED03' or confidence = 'HIGH'
              union all
              select 'c', 3, f.* from {fx_flat} f where transaction_metric = 'GFRSUSERPROCESSCOM03') a
        where selected_reference_index is not null""",
    "fx_log": """
        select selected_reference_name as reference_name, 'class_' || cast(selected_reference_index as string) as clase_name,
               label as label_id, transaction_id, cast(transaction_start_time as string) as transaction_start_time, device_id,
               'key/' || transaction_id as s3_key,
               'out/dataset_' || cast(deployment_id as string) || '/class_' || cast(selected_reference_index as string) || '/' || cast(label as string)
                   || '/' || day_text || '000000_' || transaction_id || '_img_1.JPG' as local_path,
               'success' as download_status, '' as error_reason,
               case when transaction_metric = 'WSREFERENCEIMAGEAC01' then 'a' else 'z' end as dataset_folder,
               case when confidence = 'HIGH' then 'device' else 'reference' end as motivo_descarga,
               case when confidence = 'HIGH' then cast(device_id as string) || '.0' else selected_reference_name end as valor_motivo
        from {fx_flat} where transaction_metric <> 'GFRSUSERPROCESSCOM03' and selected_reference_index is not null""",
    "fx_sets": """
        select 'dataset_' || cast(deployment_id as string) || '_' || day_text2 || case when confidence = 'LOW' then '_v1' else '' end
               || '_v' || case when topk < 8 then '0' else '' end || cast(topk + 2 as string) as dataset_folder
        from {fx_flat} where topk is not null""",
    "fx_urls": """
        select transaction_id, transaction_start_time, selected_reference_code as reference_code, first_code as product_code,
               'http://img.example/' || transaction_id || '.png?x=1' as image_url,
               case when confidence = 'LOW' then 'thumb/none' else '/thumb/' || first_code || '.bmp' end as thumb_image_url,
               case when confidence = 'HIGH' then '/p/' || transaction_id || '.jpeg' else 'p/q' end as image_path,
               cast(floor(cast(first_code as bigint) / 18.0) as bigint) as predicted_label_id, label as label_id
        from {fx_flat}""",
}

_TOP5 = [(f"cast(floor(p_partkey / 18.0) as bigint) + {i}", f"p_size - 3 * {i}", f"1e2 / (p_size + {i})") for i in range(5)]

SPARK_ONLY = {
    "fx_entries": "select *, explode(array_distinct(predicted_codes)) as code from {fx_flat}",
    "fx_suggestions": """
        select lpad(cast(p_partkey as string), 7, '0') as reference_code,
               upper(p_name) || ' ' || cast(p_partkey as string) as reference_name,
               cast(p_size as bigint) as total_detections, p_type as suggestion_confidence,
               p_size > 25 as confident_suggestion, cast(floor(p_partkey / 18.0) as bigint) as main_suggestion_label_id,
               p_size * 15e-1 as main_suggestion_percentage,
               slice(array(""" + ", ".join(
        f"named_struct('label_id', {a}, 'count', cast({b} as bigint), 'percentage', cast({c} as double))" for a, b, c in _TOP5
    ) + """), 1, case when p_size > 40 then 5 when p_size > 20 then 2 when p_size > 10 then 1 else 0 end) as all_suggestions
        from {part}""",
    "fx_listed": """
        select x.*, y.folder_url, explode(array_distinct(x.predicted_codes)) as code
        from {fx_flat} x left join {fx_folders} y on x.transaction_id = y.transaction_id""",
}

DUCK_ONLY = {
    "fx_entries": "select *, unnest(list_distinct(predicted_codes)) as code from {fx_flat}",
    "fx_suggestions": """
        select lpad(cast(p_partkey as string), 7, '0') as reference_code,
               upper(p_name) || ' ' || cast(p_partkey as string) as reference_name,
               cast(p_size as bigint) as total_detections, p_type as suggestion_confidence,
               p_size > 25 as confident_suggestion, cast(floor(p_partkey / 18.0) as bigint) as main_suggestion_label_id,
               p_size * 15e-1 as main_suggestion_percentage,
               ([""" + ", ".join(
        f"struct_pack(label_id := {a}, count := cast({b} as bigint), percentage := cast({c} as double))" for a, b, c in _TOP5
    ) + """])[1:case when p_size > 40 then 5 when p_size > 20 then 2 when p_size > 10 then 1 else 0 end] as all_suggestions
        from {part}""",
    "fx_listed": """
        select x.*, y.folder_url, unnest(list_distinct(x.predicted_codes)) as code
        from {fx_flat} x left join {fx_folders} y on x.transaction_id = y.transaction_id""",
    "fx_lines": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_returnflag, p_type,
               lpad(cast(l_partkey as string), 7, '0') as code, upper(p_name) || ' ' || cast(p_partkey as string) as name
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "fx_lists": """
        select l_orderkey, list(code order by l_linenumber, l_partkey, l_suppkey) as codes,
               list(name order by l_linenumber, l_partkey, l_suppkey) as names
        from {fx_lines} where l_returnflag <> 'R' group by 1""",
    "fx_chosen": """
        select l_orderkey, l_partkey, code, name, p_type
        from (select *, row_number() over (partition by l_orderkey
                     order by l_extendedprice desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn from {fx_lines}) a
        where rn = 1""",
    # one row per order, the columns of the flattened Spark table plus helper columns
    "fx_base": """
        select o_orderdate + to_seconds(o_orderkey % 86400) as transaction_start_time,
               o_orderdate + to_seconds(o_orderkey % 86400 + 45) as transaction_end_time,
               cast(o_orderkey as string) as transaction_id,
               case when o_orderpriority = '1-URGENT' then 'WSREFERENCEIMAGEAC01'
                    when o_orderpriority in ('2-HIGH', '3-MEDIUM') then 'WSPROCESSCOMPLETED03'
                    else 'GFRSUSERPROCESSCOM03' end as transaction_metric,
               c_nationkey as deployment_id, o_custkey as device_id, c_name as device_name,
               cast(o_orderdate as date) as "time",
               c_nationkey * 10 + case when o_orderstatus = 'P' then 1 else 0 end as model_id,
               cast(floor(cast(codes[1] as bigint) / 54.0) as int) as result_index,
               'LABEL ' || cast(cast(floor(cast(codes[1] as bigint) / 18.0) as bigint) as string) as result_label_name,
               case when not (o_orderpriority = '1-URGENT' and o_orderstatus = 'F') then code end as selected_reference_code,
               case when o_orderpriority = '1-URGENT' then name end as selected_reference,
               name as selected_reference_name,
               cast(floor(l_partkey / 54.0) as int) as selected_reference_index,
               case when p_type = 'PROMO' then false when p_type <> 'LARGE' then true end as selected_reference_is_trained,
               case when o_totalprice < 60000 then 'LOW' when o_totalprice < 250000 then 'MEDIUM' else 'HIGH' end as confidence,
               case when codes is not null then cast(coalesce(list_position(codes, code), 0) as bigint) - 1 end as topk,
               codes as predicted_codes,
               case when o_orderstatus = 'P' then names[1:len(names) - 1] else names end as predicted_names,
               codes[1] as first_code, cast(floor(l_partkey / 18.0) as bigint) as label
        from {orders} join {customer} on o_custkey = c_custkey
             left join {fx_lists} a on a.l_orderkey = o_orderkey
             left join {fx_chosen} b on b.l_orderkey = o_orderkey""",
    "fx_flat": """
        select *, strftime(transaction_start_time, '%Y%m%d') as day_text, strftime(transaction_start_time, '%d%m%y') as day_text2,
               '[''' || array_to_string(predicted_codes, '.jpg'', ''') || '.jpg'']' as files_text
        from {fx_base}""",
    "fx_tx": """
        select *, case when Result = 'Ok' then 1 else 0 end as Ok, case when Result = 'No_result' then 1 else 0 end as No_result,
               case when Result = 'Error' then 1 else 0 end as Error,
               case when Result_modelo = 'SUCCESS' then 1 else 0 end as Ok_modelo,
               transaction_metric in ('WSPROCESSCOMPLETED03', 'GFRSUSERPROCESSCOM03') as is_client,
               transaction_metric = 'WSREFERENCEIMAGEAC01' as is_manual,
               coalesce(selected_reference_is_trained, false) as trained
        from (select *, cast(transaction_start_time as date) as "Date",
                     case when confidence = 'LOW' then 'No_result' when topk = -1 then 'Error' else 'Ok' end as Result,
                     case when transaction_metric = 'WSREFERENCEIMAGEAC01' then ''
                          when selected_reference_is_trained = false then 'NOT_TRAINED'
                          when selected_reference_is_trained and result_index = selected_reference_index then 'SUCCESS'
                          when selected_reference_is_trained then 'FAIL' else '' end as Result_modelo
              from {fx_flat}) a""",
    "fx_pairs": """
        select deployment_id, try_cast(result_index as int) as result_index, selected_reference as code,
               max(lower(trim(valida)) in ('true', '1', 'yes', 'sí', 'si')) as valid
        from {fx_pairs_raw} where try_cast(result_index as int) is not null group by all""",
    "fx_descriptions": """
        select deployment_id, cast(try_cast(trim(replace(label_index, ' ', '')) as double) as bigint) as label_index,
               arg_max(trim(replace(label_name, ' ', '')), row_no) as label_name
        from {fx_descriptions_raw} where try_cast(trim(replace(label_index, ' ', '')) as double) is not null group by 1, 2""",
    "fx_activations": """
        select regexp_replace(trim(device_id), '\\.0$', '') as device_id,
               case when fecha_encendido like '%/%' then strptime(fecha_encendido, '%d/%m/%Y')
                    else cast(fecha_encendido as timestamp) end as activated_at
        from {fx_activations_raw}""",
    "fx_images": """
        select t.*, case when n > 0 then 1 else 0 end as has_image, n as num_images,
               case when n > 0 then coalesce(folder_url, '') else '' end as image_link
        from (select t.*, f.folder_url, case when left(folder_files, 2) = '[''' then len(string_split(folder_files, ', ')) else 0 end as n
              from {fx_tx} t left join {fx_folders} f on t.transaction_id = f.transaction_id) t""",
    "fx_active": """
        select deployment_id, model_id, frequency, total_records, 100.0 * frequency / total_records as percentage
        from (select *, cast(sum(frequency) over (partition by deployment_id) as bigint) as total_records,
                     row_number() over (partition by deployment_id order by (model_id is null), frequency desc, model_id) as rn
              from (select deployment_id, model_id, count(*) as frequency
                    from (select *, row_number() over (partition by deployment_id
                                 order by transaction_start_time desc, transaction_id) as k from {fx_tx}) a
                    where k <= 1000 group by 1, 2) b) c
        where rn = 1 and model_id is not null""",
    # (kind, key) matches: by code, plus by name
    "fx_matches": """
        select 'code' as matched_by, r.reference_id, t.* from {fx_tx} t join {fx_references} r on t.selected_reference_code = r.reference_code
        union all
        select 'name', r.reference_id, t.* from {fx_tx} t join {fx_references} r on t.selected_reference = r.reference_name""",
    "fx_fleet_matches": """
        select 'code' as matched_by, r.reference_id, t.* from {fx_tx} t join {fx_fleet_products} r
               on t.deployment_id = r.deployment_id and t.selected_reference_code = r.reference_code
        union all
        select 'name', r.reference_id, t.* from {fx_tx} t join {fx_fleet_products} r
               on t.deployment_id = r.deployment_id and t.selected_reference = r.reference_name""",
    "fx_label_of_reference": """
        select r.* exclude (label_id), cast(try_cast(label_id as double) as bigint) as label_id from {fx_references} r""",
    "fx_class_of_label": """
        select label_id, arg_max(class_name, class_pos * 10 + label_pos) as last_class, arg_min(class_name, class_pos * 10 + label_pos) as first_class
        from {fx_classes} where label_id is not null group by 1""",
    "fx_top3": """
        select * from (select reference_id, selected_reference_name, result_index, result_label_name, count(transaction_id) as n, sum(Ok) as ok,
                              row_number() over (partition by reference_id
                                  order by count(transaction_id) desc, selected_reference_name, result_index, result_label_name) as rn
                       from {fx_matches} where is_client and selected_reference_name is not null and result_index is not null
                            and result_label_name is not null group by 1, 2, 3, 4) a where rn <= 3""",
    "fx_metrics": """
        select m.reference_id, count(*) filter (where is_client) as num_cliente, count(*) filter (where is_manual) as num_manuales,
               count(*) filter (where is_client and trained) as trained_count,
               count(*) filter (where is_client and in_use) as ca, count(*) filter (where is_client and in_use and Ok = 1) as oa,
               count(*) filter (where is_client and in_use and trained) as ta,
               count(*) filter (where is_client and in_use and trained and Ok_modelo = 1) as ma
        from (select m.*, (a.model_id is null or coalesce(m.model_id = a.model_id, false)) as in_use
              from {fx_matches} m left join {fx_active} a on m.deployment_id = a.deployment_id) m group by 1""",
    "fx_analysed": """
        select r.reference_id, r.reference_code, r.reference_name, r.deployment_id, l.label_id as label_id, b.label_name,
               c.last_class as producto_trained, c.label_id is not null as is_in_dataset,
               coalesce(m.num_cliente, 0) as num_cliente, coalesce(num_manuales, 0) as num_manuales, coalesce(trained_count, 0) as trained_count,
               case when m.num_cliente > 0 then trained_count / m.num_cliente >= 0.5 else false end as is_trained_elastic,
               case when ca > 0 then round(100.0 * oa / ca, 2) else 0.0 end as pct_ok_sistema,
               case when ta > 0 then round(100.0 * ma / ta, 2) else 0.0 end as pct_ok_modelo,
               """ + ", ".join(
        f"""t{i}.result_index as top{i}_result_index, t{i}.result_label_name as top{i}_result_label_name,
               coalesce(round(100.0 * t{i}.n / m.num_cliente, 2), 0.0) as top{i}_pct_pesadas, coalesce(round(100.0 * t{i}.ok / t{i}.n, 2), 0.0) as top{i}_pct_ok"""
        for i in (1, 2, 3)) + """,
               'no' as revisar_imagenes
        from {fx_references} r join {fx_label_of_reference} l on r.reference_id = l.reference_id
             left join {fx_labels} b on l.label_id = b.label_id left join {fx_class_of_label} c on l.label_id = c.label_id
             left join {fx_metrics} m on r.reference_id = m.reference_id
             """ + " ".join(f"left join {{fx_top3}} t{i} on r.reference_id = t{i}.reference_id and t{i}.rn = {i}" for i in (1, 2, 3)),
    "fx_devices": """
        select device_id, device_name, num_cliente, num_manual, case when ca > 0 then round(100.0 * oa / ca, 1) else 0.0 end as pct_ok_sistema,
               case when ta > 0 then round(100.0 * ma / ta, 1) else 0.0 end as pct_ok_modelo, 'no' as revisar_imagenes, first_transaction_date
        from (select device_id, arg_min(device_name, transaction_start_time) as device_name, min(transaction_start_time) as first_transaction_date,
                     count(*) filter (where is_client) as num_cliente, count(*) filter (where is_manual) as num_manual,
                     count(*) filter (where is_client and in_use) as ca, count(*) filter (where is_client and in_use and Ok = 1) as oa,
                     count(*) filter (where is_client and in_use and trained) as ta,
                     count(*) filter (where is_client and in_use and trained and Ok_modelo = 1) as ma
              from (select t.*, (a.model_id is null or coalesce(t.model_id = a.model_id, false)) as in_use
                    from {fx_tx} t left join {fx_active} a on t.deployment_id = a.deployment_id) t group by 1) d""",
    "fx_accuracy": """
        select *, round(successful_transactions / total_transactions, 4) as pct_ok_modelo
        from (select deployment_id, selected_reference_code, selected_reference_name, count(*) as total_transactions,
                     cast(sum(Ok_modelo) as bigint) as successful_transactions
              from {fx_tx} where trained and selected_reference_code is not null and selected_reference_name is not null
              group by 1, 2, 3) a where total_transactions >= 2""",
}


# the same figures for a fleet's products: matches, labels and classes are those of each product's deployment
_FLEET_NAMES = {
    "{fx_matches}": "{fx_fleet_matches}", "{fx_references}": "{fx_fleet_products}", "{fx_label_of_reference}": "{fx_fleet_label_of_reference}",
    "{fx_metrics}": "{fx_fleet_metrics}", "{fx_top3}": "{fx_fleet_top3}",
    "{fx_class_of_label} c on l.label_id = c.label_id": "{fx_fleet_class_of_label} c on l.label_id = c.label_id and r.deployment_id = c.deployment_id",
}


def _of_fleet(text: str) -> str:
    for one, fleet in _FLEET_NAMES.items():
        text = text.replace(one, fleet)
    return text


for _name in ("fx_metrics", "fx_top3", "fx_label_of_reference", "fx_analysed"):
    DUCK_ONLY[_name.replace("fx_", "fx_fleet_")] = _of_fleet(DUCK_ONLY[_name])
DUCK_ONLY["fx_fleet_class_of_label"] = """
        select model_id // 10 as deployment_id, label_id, arg_max(class_name, class_pos * 10 + label_pos) as last_class
        from {fx_fleet_classes} where label_id is not null group by 1, 2"""


def _names_in(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)))


def oracle(sql: str) -> str:
    """The query text with the derived tables it names as common table expressions."""
    texts = SHARED | DUCK_ONLY
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name not in texts:
            return
        for inner in _names_in(texts[name]):
            visit(inner)
        order.append(name)

    for name in _names_in(sql):
        visit(name)
    names = {n: n for n in (*texts, *BASE)}
    ctes = ",\n".join(f"{n} as materialized ({texts[n].format(**names).strip()})" for n in order)
    body = sql.format(**names).strip()
    if not order:
        return body
    return f"with {ctes},\n{body[len('with '):]}" if body.startswith("with ") else f"with {ctes}\n{body}"


_paths: dict[tuple[str, str, str], str] = {}
_lock = threading.Lock()


class Fleet:
    """The derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

        self._frames: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def derived(self, name: str) -> DataFrame:
        if name not in self._frames:
            text = SHARED.get(name) or SPARK_ONLY[name]
            self._frames[name] = self.spark.sql(text, **{n: self.table(n) for n in _names_in(text)})
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        if name in BASE:
            return self.given(name)
        if name == "fx_flat":
            return self.flat
        return self.derived(name)

    @cached_property
    def raw(self) -> DataFrame:
        """Raw transactions, written once per session to the shared folder and read from there."""
        return self._staged("transactions", self.build_raw)

    @cached_property
    def cached(self) -> DataFrame:
        """Labelled transactions with image links: the extract that later jobs read."""
        return self._staged("extract", lambda: transaction_extract(self.raw, self.derived("fx_folders")))

    def _staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        with _lock:
            path = _paths.get(key)
        if path is None:
            path = shared_dir(self.spark, name)
            build().write.option("compression", "zstd").parquet(path)
            with _lock:
                path = _paths.setdefault(key, path)
        return self.spark.read.parquet(path)

    def build_raw(self) -> DataFrame:
        """One nested transaction per order from orders, customer, lineitem and part.

        A line is moved to its order once, as plain columns with the part's own name; the longer names are made there.  One sort
        by order then serves all that follows: the window makes the lists, the dearest line's row keeps them, and the rows
        are in the order in which they meet the orders.  A task gets a bounded number of lines, so that its sort stays in memory.
        """
        plain = ["l_orderkey", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "is_listed"]
        name = F.concat(F.upper("p_name"), F.lit(" "), F.col("l_partkey"))
        line = F.struct("l_linenumber", "l_partkey", "l_suppkey", name.alias("name"), "is_listed")
        dearest = W.partitionBy("l_orderkey").orderBy(*[F.col(c).desc() for c in ("l_extendedprice", "line", "p_type")])
        whole = dearest.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        given = self.given("lineitem").withColumn("is_listed", F.col("l_returnflag") != "R").select(*plain)
        tasks = -(-given.count() // LINES_PER_TASK)
        more = [tasks] if tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else []
        lines = (
            given.join(self.given("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(*plain, "p_name", "p_type").repartition(*more, "l_orderkey")
            .select("l_orderkey", "l_extendedprice", line.alias("line"), "p_type")
            .withColumns({"rank": F.row_number().over(dearest), "listed": F.collect_list("line").over(whole)})
            .filter(F.col("rank") == 1)
            .select(
                "l_orderkey", F.filter(F.sort_array("listed"), lambda x: x["is_listed"]).alias("listed"),
                F.struct("line.l_partkey", "line.name", "p_type").alias("chosen"))
        )
        orders = (
            self.given("orders").join(self.given("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )

        def code_of(part):
            return F.lpad(part.cast("string"), 7, "0")

        def group_of(part, size):
            return F.floor(part / F.lit(float(size)))

        listed = F.when(F.size("listed") > 0, F.col("listed"))
        codes = F.transform(listed, lambda x: code_of(x["l_partkey"]))
        names = listed["name"]
        first, part = F.get(listed, F.lit(0))["l_partkey"], F.col("chosen.l_partkey")
        code, kind = code_of(part), F.col("chosen.p_type")
        manual, prior = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
        seconds = F.col("o_orderkey") % 86400
        start = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
        nation = F.col("c_nationkey")
        position = F.array_position(codes, F.coalesce(code, F.lit(""))) - 1
        data = F.struct(
            (nation * 10 + F.when(prior == "P", 1).otherwise(0)).alias("model_id"),
            group_of(first, 54).cast("int").alias("result_index"),
            F.concat(F.lit("LABEL "), group_of(first, 18)).alias("result_label_name"),
            F.when(~(manual & (prior == "F")), code).alias("selected_reference_code"),
            F.when(manual, F.col("chosen.name")).alias("selected_reference"),
            F.col("chosen.name").alias("selected_reference_name"),
            group_of(part, 54).cast("int").alias("selected_reference_index"),
            F.when(kind == "PROMO", F.lit(False)).when(kind != "LARGE", F.lit(True)).alias("selected_reference_is_trained"),
            F.when(F.col("o_totalprice") < 60000, "LOW").when(F.col("o_totalprice") < 250000, "MEDIUM")
            .otherwise("HIGH").alias("confidence"),
            position.alias("topk"),
            codes.alias("predicted_codes"),
            F.when(prior == "P", F.slice(names, 1, F.size(names) - 1)).otherwise(names).alias("predicted_names"),
        )
        return orders.select(
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.when(manual, "WSREFERENCEIMAGEAC01")
            .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "WSPROCESSCOMPLETED03")
            .otherwise("GFRSUSERPROCESSCOM03").alias("transaction_metric"),
            nation.alias("deployment_id"),
            start.alias("transaction_start_time"),
            (start + F.make_dt_interval(secs=F.lit(45))).alias("transaction_end_time"),
            F.col("o_custkey").alias("device_id"), F.col("c_name").alias("device_name"),
            F.col("o_orderdate").alias("time"), data.alias("transaction_data"),
        )

    @cached_property
    def tx(self) -> DataFrame:
        return label_transactions(self.raw)

    @cached_property
    def catalogue(self) -> DataFrame:
        """The products as one catalogue for all deployments; fx_fleet_products has one for each."""
        return self.derived("fx_references").drop("deployment_id")

    @cached_property
    def flat(self) -> DataFrame:
        """The transactions with the helper columns the derived tables use."""
        part = F.col("selected_reference_name")
        number = F.regexp_extract(part, r"(\d+)$", 1).try_cast("bigint")
        return self.tx.withColumns({
            "first_code": F.get("predicted_codes", F.lit(0)),
            "label": F.floor(number / F.lit(18.0)),
            "day_text": F.date_format("transaction_start_time", "yyyyMMdd"),
            "day_text2": F.date_format("transaction_start_time", "ddMMyy"),
            "files_text": F.when(F.col("predicted_codes").isNotNull(), F.concat(
                F.lit("['"), F.array_join("predicted_codes", ".jpg', '"), F.lit(".jpg']"))),
        })

    @cached_property
    def pairs(self) -> DataFrame:
        return load_valid_pairs(self.derived("fx_pairs_raw"))

    @cached_property
    def descriptions(self) -> DataFrame:
        return load_product_descriptions(self.derived("fx_descriptions_raw"), "row_no")

    @cached_property
    def activations(self) -> DataFrame:
        return load_activations(self.derived("fx_activations_raw"), "row_no")


_fleets: dict[tuple[str, str], Fleet] = {}


def fleet_of(spark: SparkSession, sf_dir: str) -> Fleet:
    """The session's fleet over a data folder: its lazy tables are defined once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _fleets or _fleets[key].spark is not spark:
        _fleets[key] = Fleet(spark, sf_dir.rstrip("/"))
    return _fleets[key]
