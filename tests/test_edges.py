"""Hand-made frames for cases the generated data does not hold."""

from datetime import datetime

import random

import pytest
from pyspark.sql import functions as F

from weighlens.functions import codes, paths
from weighlens.operators import checks, datasets, devices, images, labelling, models, pairs, references, review, suggestions
from weighlens.schemas import MissingColumns
from weighlens.sinks.tables import write_semicolon_csv
from weighlens.sources import catalogue, files, lookups, transactions


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def mapped(rows, items, expression, kind="string"):
    return values(rows([(i,) for i in items], f"c {kind}").select(expression(F.col("c")).alias("v")))


def test_normalize_code(rows):
    assert mapped(rows, ["00014", " 14 ", "+14", "-3", "14.0", "A14", "", None, "9" * 30], codes.normalize_code) == [
        "14", "14", "14", "-3", "14.0", "A14", "", None, "9" * 30]


def test_normalize_device_id(rows):
    assert mapped(rows, ["10039.0", " 7 ", "abc", "nan", None, "9007199254740993"], codes.normalize_device_id) == [
        "10039", "7", "abc", "nan", None, "9007199254740993"]


def test_strip_decimal_suffix(rows):
    assert mapped(rows, ["10.0", " 10 ", "10.05", "nan", "", None], codes.strip_decimal_suffix) == [
        "10", "10", "10.05", None, None, None]


def test_whole_number(rows):
    assert mapped(rows, ["20.0", "7", "x", "", None, "NaN"], codes.whole_number) == [20, 7, None, None, None, None]


def test_yes_no(rows):
    assert mapped(rows, ["sí", "si", "True", "1", "no", "SI", None], codes.normalize_yes_no) == [
        "si", "si", "si", "si", "no", "no", "no"]


def test_clean_image_link(rows):
    assert mapped(rows, ["'None'", '"/a/b"', "//a.JPG ", " null", "", None], paths.clean_image_link) == [
        None, "a/b", "a.JPG", None, None, None]


def test_dataset_filename(rows):
    keys = ["a/b/x.PNG", "a/b/", "x.tar", ".jpg", "", None, "a.b.gif"]
    df = rows([(k,) for k in keys], "k string").select(
        paths.dataset_filename(F.lit("2024-08-10 15:30:45.9").cast("timestamp_ntz"), F.lit("77"), F.col("k")).alias("v"))
    assert values(df) == [f"20240810153045_77_{n}" for n in ("x.PNG", "b.jpg", "x.jpg", ".jpg.jpg", "image.jpg", "image.jpg", "a.b.gif")]
    no_time = rows([("x.jpg",)], "k string").select(
        paths.dataset_filename(F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string"), F.col("k")).alias("v"))
    assert values(no_time) == ["00000000000000_unknown_x.jpg"]


def test_filename_transaction_id(rows):
    assert mapped(rows, ["x", "d_12", "d_12_a_b.jpg", "_"], paths.filename_transaction_id) == ["", "12", "12", ""]


def test_relative_folder(rows):
    df = rows([("/o/ds/a/1/f.jpg", "ds"), ("o/ds/f.jpg", "ds"), ("o/x/f.jpg", "ds"), ("o/ds", "ds")], "p string, d string")
    assert values(df.select(paths.relative_folder(F.col("p"), F.col("d")).alias("v"))) == ["a/1", ".", "", "."]


def test_target_folder(rows):
    df = rows([("1", " a b ", None), ("2", "", "x/y"), ("3", None, None)], "id string, p string, q string")
    assert values(df.select(paths.target_folder(F.col("id"), [F.col("p"), F.col("q")]).alias("v"))) == ["a_b", "x_y", ""]
    assert values(df.select(paths.target_folder(F.col("id"), []).alias("v"))) == ["1", "2", "3"]


def test_image_extension(rows):
    urls = ["http://h.com/a/b.PNG?x=1.gif", "/a/b", "http://h.com", "a.b/c", "x/.jpg", "a.webp"]
    assert mapped(rows, urls, paths.image_extension) == [".PNG", ".jpg", ".jpg", ".jpg", ".jpg", ".jpg"]
    assert mapped(rows, ["a.webp"], lambda c: paths.image_extension(c, None)) == [".webp"]


def test_storage_uri(rows):
    df = rows([("s3://bucket/a/b/",), ("s3://bucket",)], "u string")
    assert [tuple(r) for r in df.select(paths.storage_bucket(F.col("u")), paths.storage_key(F.col("u"))).collect()] == [
        ("bucket", "a/b/"), ("bucket", "")]


def test_result_class_order(rows):
    tx = rows([("LOW", -1), ("HIGH", -1), ("HIGH", -2), (None, None), ("MEDIUM", 0)], "confidence string, topk bigint")
    assert values(labelling.add_result_class(tx), "Result") == ["No_result", "Error", "Ok", "Ok", "Ok"]


@pytest.mark.parametrize("kind, yes, no", [("boolean", True, False), ("int", 1, 0), ("double", 1.0, 0.0)])
def test_model_result(rows, kind, yes, no):
    client, manual = "GFRSUSERPROCESSCOM03", "WSREFERENCEIMAGEAC01"
    tx = rows(
        [(client, yes, 1, 1), (client, yes, 1, 2), (client, yes, None, 1), (client, no, 1, 1), (client, None, 1, 1), (manual, yes, 1, 1)],
        f"transaction_metric string, selected_reference_is_trained {kind}, result_index int, selected_reference_index int")
    assert values(labelling.add_model_result(tx), "Result_modelo") == ["SUCCESS", "FAIL", "FAIL", "NOT_TRAINED", "", ""]


def test_topk_and_lists(rows):
    tx = rows([(-2, []), (-1, None), (None, ["a"]), (0, ["a"] * 6), (4, ["a"] * 7), (5, ["a", "b"])], "top_k int, predicted_codes array<string>")
    got = labelling.add_candidate_features(labelling.add_topk_class(tx))
    assert values(got, "pos_candidato_elegido") == [
        "top_k_alto", "NO_CLASIFICADO", "NO_CLASIFICADO", "top_k_0", "top_k_medio", "top_k_alto"]
    assert values(got, "num_candidatos") == [0, 0, 1, 6, 7, 2]
    assert values(got, "lista_larga") == [0, 0, 0, 0, 1, 0]


def test_optional_columns_absent(rows):
    tx = rows([("1",)], "transaction_id string")
    assert values(labelling.add_topk_class(tx), "pos_candidato_elegido") == [""]
    assert values(labelling.add_is_trained(tx), "is_trained") == [0]
    assert values(labelling.add_model_ok_general_fail(tx), "model_ok_general_fail") == [0]
    with pytest.raises(MissingColumns):
        labelling.add_candidate_features(tx)


def test_dedupe_with_maps(rows):
    tx = rows([("1", {"a": 1}, ["x"]), ("1", {"a": 1}, ["x"]), ("1", {"a": 2}, ["x"])], "id string, m map<string,int>, l array<string>")
    assert labelling.dedupe_transactions(tx).count() == 2


def test_flatten_clash_and_source_wrapper(rows):
    raw = rows([((("9", (5, "LOW", 3)),))], "_source struct<transaction_id:string,transaction_data:struct<transaction_id:int,confidence:string,topk:int>>")
    flat = transactions.flatten_transactions(raw)
    assert flat.columns == ["transaction_id", "transaction_data_transaction_id", "confidence", "topk"]
    assert tuple(flat.first()) == ("9", 5, "LOW", 3)


def test_flatten_json_text(rows):
    raw = rows([("1", '{"model_id": 4, "predicted_codes": ["a"]}'), ("2", "broken")], "transaction_id string, transaction_data string")
    got = {r.transaction_id: (r.model_id, r.predicted_codes) for r in transactions.flatten_transactions(raw).collect()}
    assert got == {"1": (4, ["a"]), "2": (None, None)}


def test_times(rows):
    tx = rows([("2024-03-31 02:30:15.999", "bad", "2024-03-31T10:00:00")], "transaction_start_time string, transaction_end_time string, time string")
    r = transactions.normalize_times(tx).first()
    assert (r.transaction_start_time, r.transaction_end_time) == (datetime(2024, 3, 31, 2, 30, 15), None)
    assert str(r.Date) == str(r.time) == "2024-03-31"


def test_times_do_not_depend_on_the_zone(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        tx = rows([("2024-03-31 02:30:15.999",)], "transaction_start_time string")  # an hour that zone skips
        assert transactions.normalize_times(tx).selectExpr("cast(transaction_start_time as string) v").first().v == "2024-03-31 02:30:15"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("asked, own, expected", [
    (1, 2, {"a"}), (9, 2, {"b"}), (9, 9, {"a", "b", "c"}), (9, None, {"a", "b", "c"}), (9, 5, set()), (None, 2, {"a", "b", "c"})])
def test_model_fallback(rows, asked, own, expected):
    tx = rows([("a", 1), ("b", 2), ("c", 3)], "transaction_id string, model_id int").selectExpr(
        "*", "'GFRSUSERPROCESSCOM03' transaction_metric", "4 deployment_id", "timestamp_ntz '2024-01-01 10:00:00' transaction_start_time")
    deployments = rows([(4, own)], "deployment_id int, model_id int")
    got = transactions.scan_with_model_fallback(tx, deployments, 4, datetime(2024, 1, 2), 3, asked)
    assert set(values(got, "transaction_id")) == expected


def test_scan_window_edges(rows):
    tx = rows([("2024-01-06 23:59:59",), ("2024-01-07 00:00:00",), ("2024-01-10 23:59:59",), ("2024-01-11 00:00:00",)], "t string").selectExpr(
        "cast(t as timestamp_ntz) transaction_start_time", "'WSREFERENCEIMAGEAC01' transaction_metric", "4 deployment_id")
    got = transactions.scan_transactions(tx, 4, datetime(2024, 1, 10, 15), 3)
    assert [str(r.transaction_start_time) for r in got.collect()] == ["2024-01-07 00:00:00", "2024-01-10 23:59:59"]


def test_model_json_forms(rows):
    one = '[{"index":0,"index_name":"c0","trained_labels":[1,2]},{"index":1,"index_name":"c1","trained_labels":[]}]'
    models_df = rows([(1, "m", one), (2, "m", '{"classes":' + one + "}"), (3, "m", "oops"), (4, "m", None)], "model_id int, model_code string, model_data string")
    got = catalogue.scan_model_classes(models_df).collect()
    assert {(r.model_id, r.class_name, r.label_id) for r in got if r.model_id < 3} == {
        (m, c, l) for m in (1, 2) for c, l in (("c0", 1), ("c0", 2), ("c1", None))}
    assert {(r.model_id, r.json_ok) for r in got if r.model_id > 2} == {(3, False), (4, False)}


def test_last_and_first_class(rows):
    classes = rows([(0, 0, "first", 5), (3, 0, "last", 5), (2, 0, "mid", 5)], "class_pos int, label_pos int, class_name string, label_id bigint")
    refs = rows([(1, "5.0"), (2, None), (3, "x")], "reference_id int, label_id string")
    assert values(references.references_with_model(refs, classes).orderBy("reference_id"), "producto_trained") == ["last", None, None]
    assert values(references.references_with_model(refs, classes, last=False).orderBy("reference_id"), "producto_trained") == ["first", None, None]


def test_double_match_counts_twice(rows):
    tx = rows([("1", "A", "apple"), ("2", "A", None), ("3", None, "apple"), ("4", None, None)], "transaction_id string, selected_reference_code string, selected_reference string")
    refs = rows([(1, "A", "apple"), (2, None, "apple")], "reference_id int, reference_code string, reference_name string")
    got = references.transactions_by_reference(tx, refs).collect()
    assert sorted((r.reference_id, r.transaction_id, r.matched_by) for r in got) == [
        (1, "1", "code"), (1, "1", "name"), (1, "2", "code"), (1, "3", "name")]


def test_reference_stats_of_unknown_code(rows):
    tx = rows([("A", "GFRSUSERPROCESSCOM03", True)], "selected_reference_code string, transaction_metric string, selected_reference_is_trained boolean")
    assert tuple(references.reference_stats(tx, "Z").first()) == ("Z", 0, 0, 0, 0, 0, 0.0)


def test_pair_file_rules(rows):
    raw = rows([("1", "7", "00014", "no"), ("1", "7", " 14", " SÍ"), ("1", "x", "14", "si"), ("1", None, "14", "si"), ("2", "7", "A1", "true")],
               "deployment_id string, result_index string, selected_reference string, valida string")
    got = {tuple(r) for r in lookups.load_valid_pairs(raw).collect()}
    assert got == {("1", 7, "14", True), ("2", 7, "A1", True)}


def test_pairs_without_deployment(rows):
    pairs_df = lookups.load_valid_pairs(rows([(7, "14", "si")], "result_index int, selected_reference string, valida string"))
    tx = rows([("1", 3, 7, "00014"), ("2", 4, 7, "15"), ("3", 4, None, "14")], "transaction_id string, deployment_id int, result_index int, selected_reference_code string")
    assert values(pairs.validate_pair(tx, pairs_df).orderBy("transaction_id"), "validacion") == ["Válida", "No válida", "No válida"]


def test_uneven_candidate_lists(rows):
    tx = rows([(1, 7, "A", "a", True, ["A", "B", "C"], ["a", "b"]), (1, 7, "A", "a", None, None, ["a"]), (1, 7, "nan", "a", False, [""], ["x"])],
              "deployment_id int, result_index int, selected_reference_code string, selected_reference_name string, selected_reference_is_trained boolean, predicted_codes array<string>, predicted_names array<string>")
    got = {(r.selected_reference, r.veces_seleccionado, r.veces_en_lista, r.is_trained) for r in pairs.candidate_pairs(tx).collect()}
    assert got == {("A", 2, 1, "None"), ("B", 0, 1, "False")}


def test_similarity_of_null_class_and_empty_list(rows):
    tx = rows([("1", 1, None, ["A", "B"], "A"), ("2", 1, 7, [], "A"), ("3", 1, 7, ["A", "A", "Z"], "A"), ("4", 1, 7, None, None)],
              "transaction_id string, deployment_id int, result_index int, predicted_codes array<string>, selected_reference_code string")
    pairs_df = lookups.load_valid_pairs(rows([("1", 7, "A", "si")], "deployment_id string, result_index int, selected_reference string, valida string"))
    got = pairs.add_pair_similarity(labelling.add_candidate_features(tx), pairs_df).orderBy("transaction_id").collect()
    assert [(r.num_referencias_no_similares, r.num_referencias_similares, r.lista_similar_completa, r.producto_seleccionado_similar) for r in got] == [
        (2, 0, 0, 0), (0, 0, 0, 1), (1, 2, 0, 1), (0, 0, 0, 0)]


def test_month_before_march_31(rows):
    tx = rows([("1", "10.0", "2024-03-31 10:00:00"), ("2", "11", "2024-03-31 10:00:00"), ("3", "99", "2024-04-01 00:00:00"), ("4", None, "2024-04-01 00:00:00"), ("5", "11", None)],
              "transaction_id string, device_id string, t string").selectExpr("transaction_id", "device_id", "cast(t as timestamp_ntz) transaction_start_time")
    act = rows([("10", None), ("11", "2024-03-31 10:00:01")], "device_id string, a string").selectExpr("device_id", "cast(a as timestamp_ntz) activated_at")
    got = devices.add_activation_label(devices.add_device_status(tx, act), act).orderBy("transaction_id").collect()
    assert [r.estado_dispositivo for r in got] == ["Encendido", "Silencioso", "Silencioso", "Silencioso", "Silencioso"]
    assert [r.fecha_encendido for r in got] == ["Sin fecha", "2024-03-31", "No en archivo", "", "2024-03-31"]


def test_activation_formats(rows):
    raw = rows([("1.0", "2024-02-03"), ("2", "03/02/2024"), ("3", "2024-02-03 04:05:06"), ("4", "03/02/2024 04:05:06"), ("5", "2024-02-03T04:05:06"), ("6", "rubbish"), ("7", ""), ("1", "2025-01-01"), (None, "x")],
               "device_id string, fecha_encendido string").coalesce(1)
    got = {r.device_id: str(r.activated_at) for r in lookups.load_activations(raw).collect()}
    assert got == {"1": "2025-01-01 00:00:00", "2": "2024-02-03 00:00:00", "3": "2024-02-03 04:05:06", "4": "2024-02-03 04:05:06",
                   "5": "2024-02-03 04:05:06", "6": "None", "7": "None"}


def test_active_model_ties_nulls_and_order(rows):
    tx = rows([(1, None, 1), (1, None, 2), (1, 5, 3), (1, 4, 4), (2, None, 1)], "deployment_id int, model_id int, d int").selectExpr(
        "*", "cast(make_date(2024, 1, d) as timestamp_ntz) transaction_start_time", "cast(d as string) transaction_id")
    assert [(r.deployment_id, r.model_id, r.frequency, r.total_records, r.percentage) for r in models.active_model(tx).collect()] == [(1, 4, 1, 4, 25.0)]
    assert [r.model_id for r in models.active_model(tx, recent=3, newest=False).collect()] == [5]
    assert [r.model_id for r in models.active_model(tx, recent=1).collect()] == [4]


def test_folder_files(rows):
    texts = ["['a.jpg', 'b.jpg']", "[]", "broken", None, "", "{'a': 1}", '["it\'s.jpg"]']
    assert mapped(rows, texts, lambda c: F.size(images.folder_file_list(c))) == [2, 0, 0, 0, 0, 0, 1]


def test_first_image_in_nested_folders(rows, tmp_path):
    listing = rows([("f/1/b.jpg",), ("f/1/sub/a.JPG",), ("f/10/a.png",), ("f/1/a.txt",), ("top.jpg",)], "path string")
    folders = rows([("t1", "/f/1/"), ("t2", "f/10"), ("t3", None), ("t4", "f/9/")], "transaction_id string, folder_url string")
    got = {(r.transaction_id, r.s3_key, r.filename) for r in images.first_n_per_folder(folders, listing, 5).collect()}
    assert got == {("t1", "f/1/b.jpg", "t1_1.jpg"), ("t1", "f/1/sub/a.JPG", "t1_2.jpg"), ("t2", "f/10/a.png", "t2_1.jpg")}
    every = images.first_n_per_folder(folders, listing, None, work_dir=str(tmp_path / "work"))
    assert {(r.transaction_id, r.s3_key, r.filename) for r in every.collect()} == got
    links = rows([("1", "/f/1/"), ("2", "f/10"), ("3", "x/y.gif"), ("4", "none"), ("5", "f/9")], "transaction_id string, image_link string")
    keys = {r.transaction_id: r.s3_key for r in images.resolve_image_keys(links, listing).collect()}
    assert keys == {"1": "f/1/b.jpg", "2": "f/10/a.png", "3": "x/y.gif", "4": None, "5": None}


def test_folder_structure_levels(rows):
    listing = rows([(p,) for p in ("a/x.jpg", "a/c/1/x.JPG", "a/c/1/y.png", "a/c/z.jpg", "b/q.jpg", "b/n.txt", "d/e/f/g/x.jpg")], "path string")
    got = {(r.dataset_name, r["product"], r.label_id, r.folder_rel, r.images_count) for r in datasets.folder_structure(listing).collect()}
    assert got == {("a", "c", "1", "c/1", 2), ("b", "", "b", ".", 1), ("d", "f", "g", "e/f/g", 1)}


def test_merge_counts_add_up(rows):
    listing = rows([("a", 1, "c", "1", "x.jpg"), ("b", 2, "c", "1", "x.jpg"), ("b", 2, "c", "1", "y.txt")],
                   "dataset string, set_order int, class string, label_id string, filename string")
    merged = datasets.merge_datasets(listing)
    assert {(r.filename, r.dataset_original) for r in merged.collect()} == {("x.jpg", "b"), ("y.txt", "b")}
    assert tuple(datasets.merge_counts(merged).first()) == (3, 1, 2, 1)
    log = rows([("new",)], "dataset_folder string")
    assert datasets.merge_log(merged, "other", log).count() == 2
    with pytest.raises(Exception, match="already exists"):
        datasets.merge_log(merged, "new", log).collect()


def test_registry_without_replacing(rows):
    old = rows([("a", "old"), ("b", "old")], "dataset_name string, description string")
    new = rows([("b", "new"), ("c", "new")], "dataset_name string, description string")
    kept = {(r.dataset_name, r.description) for r in datasets.registry_upsert(old, new, replace=False).collect()}
    assert kept == {("a", "old"), ("b", "old"), ("c", "new")}
    replaced = {(r.dataset_name, r.description) for r in datasets.registry_upsert(old, new).collect()}
    assert replaced == {("a", "old"), ("b", "new"), ("c", "new")}


def test_dataset_versions(rows):
    log = rows([("dataset_130_010224_v01",), ("dataset_130_010224_v3_v07",), ("dataset_130_010224_v07",), ("dataset_9_010224_v2",), ("other",)], "dataset_folder string")
    got = {tuple(r) for r in datasets.dataset_versions(log).collect()}
    assert got == {(130, "010224", 3, 7, 8), (9, "010224", 1, 2, 3)}


def test_suggestions(rows):
    kind = "all_suggestions array<struct<label_id:bigint,count:bigint,percentage:double>>"
    df = rows([("a", "A", 9, "alta", [(1, 5, 55.55), (2, 4, 44.45)]), ("b", "B", 0, "baja", []), ("c", "C", 0, "baja", None)],
              f"reference_code string, reference_name string, total_detections bigint, suggestion_confidence string, {kind}")
    wide = {r.reference_code: (r.sugerencia_1_label_id, r.sugerencia_2_porcentaje, r.sugerencia_3_label_id) for r in suggestions.suggestions_wide(df).collect()}
    assert wide == {"a": (1, "44.5%", None), "b": (None, None, None), "c": (None, None, None)}
    assert suggestions.suggestions_long(df).count() == 2


def test_review_entries_without_sub_products(rows):
    decisions = rows([(1, "A", "APPLE", None, None, 4, "Red", None, None)],
                     "reference_id int, reference_code string, reference_name string, label_name string, label_id int, top1_result_index int, top1_result_label_name string, top2_result_index int, top2_result_label_name string"
                     ).selectExpr("*", "cast(null as int) top3_result_index", "cast(null as string) top3_result_label_name")
    subs = rows([], "similar_name string, label_name string, label_id string, reference_code string, selected_reference_code string")
    got = {(r.type, r.name) for r in review.products_to_review(decisions, subs).collect()}
    assert got == {("clase_principal", "apple"), ("similar_top1", "Red")}
    assert review.products_to_review(decisions, subs, classes_too=False).count() == 1


def test_decisions_with_errors(rows):
    df = rows([("a", "si", " c ", "3.0"), ("b", "SÍ", "", "3"), ("c", "si", "c", "x"), ("d", "no", None, None)],
              "reference_name string, incluir_dataset string, producto_a_entrenar string, label_considerar string")
    got = {r.reference_name: (r["class"], r.label_id, r.error) for r in checks.validate_decisions(df).collect()}
    assert got["a"] == ("c", 3, None) and got["b"][2] == "missing class or label" and got["c"][2] == "label is not a number"
    with pytest.raises(checks.InvalidDecisions, match="b: missing"):
        checks.valid_decisions(df)
    assert checks.valid_decisions(df.filter("reference_name = 'a'")).count() == 1


def test_deployment_id_check():
    assert checks.check_deployment_id(130) == 130
    for bad in (0, -1, "130", None, True):
        with pytest.raises(ValueError):
            checks.check_deployment_id(bad)


def test_clean_for_export(rows):
    df = rows([("a\x00b" + "x" * 40000, float("inf"), None, ["q"]), (None, float("nan"), 3, None)], "t string, d double, i int, l array<string>")
    a, b = checks.clean_for_export(df, checks.CELL_LIMIT).collect()
    assert len(a.t) == 32767 and a.t.startswith("abx") and (a.d, a.i, a.l) == (0.0, 0, '["q"]')
    assert tuple(b) == ("", 0.0, 3, "")


def test_flatten_nested(rows):
    df = rows([(1, ((2, [3, 4]),), [(5,), (6,)])], "a int, b struct<c:struct<d:int,e:array<int>>>, f array<struct<g:int>>")
    r = checks.flatten_nested(df).first().asDict()
    assert r == {"a": 1, "b_c_d": 2, "b_c_e": "3, 4", "f_0_g": 5, "f_1_g": 6}


def test_csv_keeps_leading_zeros_and_encoding(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    write_semicolon_csv(rows([("00014", "ñ")], "code string, name string"), path)
    write_semicolon_csv(rows([("00015", "a;b")], "code string, name string"), path, append=True)
    assert {tuple(r) for r in lookups.read_semicolon_csv(spark, path, "code string, name string").collect()} == {("00014", "ñ"), ("00015", "a;b")}
    (tmp_path / "latin.csv").write_bytes("code;name\n007;ñ\n".encode("latin-1"))
    assert tuple(lookups.read_semicolon_csv(spark, str(tmp_path / "latin.csv"), "code string, name string", "ISO-8859-1").first()) == ("007", "ñ")


def test_list_image_files(spark, tmp_path):
    names = ["a/b/x.JPG", "a/y.png", "a/z.txt", "A/b/y.Png", "top.jpeg", "deep/1/2/3/4/5/é ü.webp", "a/b/.hidden.jpg", "_work/w.gif"]
    for n, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * n)
    (tmp_path / "empty/also.jpg").mkdir(parents=True)
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        got = {(r.path, r.length, int(r.modificationTime.timestamp())) for r in files.list_image_files(spark, root).collect()}
        walk = [p for p in tmp_path.rglob("*") if p.is_file() and p.suffix.lower() in (".jpg", ".jpeg", ".png", ".gif", ".webp")]
        assert got == {(f"{root.rstrip('/')}/{p.relative_to(tmp_path)}", p.stat().st_size, int(p.stat().st_mtime)) for p in walk}
    (tmp_path / "none").mkdir()
    assert files.list_image_files(spark, str(tmp_path / "none")).count() == 0


def test_first_image_merge_against_a_plain_search(rows):
    rng = random.Random(6)
    parts = ["a", "b", "a b", "é", "a-", "a0", "Z", "~"]
    keys = {"/".join(rng.choices(parts, k=rng.randrange(1, 5))) + rng.choice([".jpg", "/x.PNG", "/n.txt"]) for _ in range(400)}
    asked = {"/".join(rng.choices(parts, k=rng.randrange(1, 5))) + "/" for _ in range(120)} | {"zz/", "\U0001f600/"}
    listing = rows([(k,) for k in keys], "path string").repartition(7)
    spark = listing.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = images.first_image_per_folder(rows([(a,) for a in asked for _ in range(2)], "folder string"), listing)
        got = {r.folder: r.first_key for r in found.collect()}
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    images_only = sorted((k for k in keys if not k.endswith(".txt")), key=str.encode)
    first = {a: next((k for k in images_only if k.startswith(a)), None) for a in asked}
    assert got == {a: k for a, k in first.items() if k}


def test_similarity_with_a_class_that_holds_most_pairs(rows, spark):
    """A third of 100,000 pairs belong to one class: no plan collects them, and the largest task of the join stays small."""
    data = spark.range(100_000).selectExpr(
        "'1' as deployment_id", "cast(if(id % 3 = 0, 7, id % 1000 + 10) as int) as result_index", "cast(id as string) as code", "id % 5 != 0 as valid")
    tx = spark.range(3_000).selectExpr(
        "cast(id as string) transaction_id", "1 deployment_id", "7 result_index", "array('0', cast(id * 3 as string), cast(id as string), '3', null) predicted_codes",
        "cast(id * 3 as string) selected_reference_code", "5 num_candidatos")
    got = pairs.add_pair_similarity(tx, data)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    valid = {i for i in range(0, 100_000, 3) if i % 5}
    for r in got.collect():
        i = int(r.transaction_id)
        good = sum(c in valid for c in (0, i * 3, i, 3))
        assert (r.num_referencias_similares, r.producto_seleccionado_similar) == (good, int(i * 3 in valid))
    spread = data.filter("valid and result_index = 7").repartition(16, "deployment_id", "result_index", "code").groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 2 * 100_000 / 3 / 16


def test_csv_copies_hold_whole_texts(rows, spark, tmp_path):
    from weighlens.sinks.tables import write_report
    write_report({"long": rows([("x" * 40_000,)], "t string")}, str(tmp_path), csv_copy=True)
    assert spark.read.option("sep", ";").option("header", True).csv(f"{tmp_path}/long_csv").first().t == "x" * 40_000


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from weighlens.storage import NoSharedFolder, shared_dir

    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name.replace(".", "_"), default)))

    for master in ("spark://host:7077", "local-cluster[3,2,1000]", "yarn"):
        with pytest.raises(NoSharedFolder):
            shared_dir(session(spark_master=master), "x")
        assert shared_dir(session(spark_master=master, spark_checkpoint_dir="hdfs://c/"), "x").startswith("hdfs://c/x-")
    assert shared_dir(session(spark_master="local[4]"), "x")


def test_flags_as_numbers_and_unknown_keys_in_json(rows):
    from weighlens.sources.transactions import flatten_transactions
    tx = rows([(1, '{"selected_reference_is_trained": 1, "image": "u", "n": {"a": 2}}'), (2, '{"selected_reference_is_trained": 0}'),
               (3, '{"selected_reference_is_trained": true, "topk": 3}'), (4, "broken"), (5, None)], "id int, transaction_data string")
    got = {r.id: (r.selected_reference_is_trained, r.topk, r.rest) for r in flatten_transactions(tx, other_keys="rest").collect()}
    assert got == {1: (True, None, {"image": "u", "n": '{"a":2}'}), 2: (False, None, {}), 3: (True, 3, {}), 4: (None, None, got[4][2]), 5: (None, None, None)}


def test_number_flags_count_as_trained(rows):
    from weighlens.operators.pairs import candidate_pairs
    tx = rows([(1, 5, "a", "A", 1, [], []), (1, 5, "a", "A", 1, [], []), (1, 5, "b", "B", 0, [], [])],
              "deployment_id int, result_index int, selected_reference_code string, selected_reference_name string, selected_reference_is_trained int, predicted_codes array<string>, predicted_names array<string>")
    assert {r.selected_reference: r.is_trained for r in candidate_pairs(tx).collect()} == {"a": "True", "b": "False"}


def test_objects_inside_listed_objects_are_flattened(rows):
    df = rows([('{"a": [{"b": {"c": 1}, "d": [{"e": 2}, {"e": 3}]}, {"b": {"c": 4}}]}',), ('{"a": []}',), (None,)], "j string")
    schema = "struct<a:array<struct<b:struct<c:int>,d:array<struct<e:int>>>>>"
    flat = checks.flatten_json(df, "j", schema)
    assert flat.columns == ["j_a_0_b_c", "j_a_0_d_0_e", "j_a_0_d_1_e", "j_a_1_b_c", "j_a_1_d_0_e", "j_a_1_d_1_e"]
    assert tuple(flat.first()) == (1, 2, 3, 4, None, None)
    given = checks.flatten_json(df, "j", schema, lengths={"j_a": 1, "j_a_d": 1})
    assert given.columns == ["j_a_0_b_c", "j_a_0_d_0_e"]


def test_logs_are_appended_to(spark, rows, tmp_path):
    from weighlens.sinks import logs
    folder = str(tmp_path / "log")
    assert logs.read_dataset_log(spark, folder).count() == 0
    for i in range(2):
        logs.write_dataset_log(rows([(str(i), "set")], "transaction_id string, dataset_folder string"), folder)
    assert sorted(r.transaction_id for r in logs.read_dataset_log(spark, folder).collect()) == ["0", "1"]
    review = rows([("1", "device", "7.0"), ("2", "clase_principal", "x"), ("3", None, None)], "transaction_id string, product_type string, device_id string")
    for _ in range(2):
        written = logs.write_review_log(review, str(tmp_path / "review"))
    assert {n: spark.read.parquet(p).count() for n, p in written.items()} == {"revisar_imagenes_bajadas": 4, "devices_imagenes_bajadas": 2}


def test_blank_links_are_no_links(rows):
    from weighlens.sources.lookups import load_cached_transactions
    cached = rows([("1", "a", "x/"), ("2", "a", ""), ("3", "a", " "), ("4", "a", "None"), ("5", "a", "null"), ("6", "a", None)],
                  "transaction_id string, selected_reference_code string, image_link string")
    assert [r.transaction_id for r in load_cached_transactions(cached).collect()] == ["1"]


def test_bad_decisions_stop_the_training_set(rows, spark, tmp_path):
    from weighlens.plans.training_set import create_dataset
    decisions = rows([("1", "01", "apple", "si", "c", "5"), ("2", "02", "pear", "si", "c", "x")],
                     "reference_id string, reference_code string, reference_name string, incluir_dataset string, producto_a_entrenar string, label_considerar string")
    devices = rows([], "device_id double, incluir_dataset string, num_imagenes_dataset_adicionales int")
    cached = rows([("1", "01", "a/1.jpg", 3, None), ("2", "02", "a/2.jpg", 3, None)],
                  "transaction_id string, selected_reference_code string, image_link string, device_id int, transaction_start_time timestamp")
    with pytest.raises(checks.InvalidDecisions):
        create_dataset(decisions, devices, cached, None, "set")
    made = create_dataset(decisions, devices, cached, None, "set", work_dir=str(tmp_path), skip_bad=True)
    assert [r.transaction_id for r in made.collect()] == ["1"]
    assert spark.read.parquet(f"{tmp_path}/bad_decisions").first().reference_name == "pear"
