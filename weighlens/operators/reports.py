"""Report tables: summaries, decision columns and consolidated products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weighlens.functions.codes import normalize_yes_no, whole_number_in
from weighlens.schemas import IMAGES_PER_PRODUCT, MIN_CLIENT_ROWS, column_or, percent


def summary_stats(references: DataFrame) -> DataFrame:
    """One row over all analysed products."""
    total = F.count(F.lit(1))

    def yes(name: str) -> Column:
        return F.count_if(F.col(name)) if name in references.columns else F.lit(0).cast("bigint")

    def total_of(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint") if name in references.columns else F.lit(0).cast("bigint")

    trained, in_model = yes("is_trained_elastic"), yes("is_in_dataset")
    zero = F.lit(0).cast("bigint")
    return references.agg(
        total.alias("total_references"),
        total.alias("total_filtered_references"),
        trained.alias("trained_references"),
        (total - trained).alias("not_trained_references"),
        (total - trained).alias("untrained_count"),
        percent(trained, total, 2).alias("training_percentage"),
        in_model.alias("in_model_references"),
        (total - in_model).alias("not_in_model_references"),
        percent(in_model, total, 2).alias("model_coverage_percentage"),
        total_of("num_cliente").alias("total_client_transactions"),
        total_of("num_manuales").alias("total_manual_transactions"),
        total_of("trained_count").alias("total_trained_transactions"),
    ).withColumns({
        c: zero for c in (
            "unassigned_count", "high_confidence_suggestions", "low_confidence_suggestions",
            "total_unassigned", "consistent_references",
        )
    })


def as_metric_rows(one_row: DataFrame, names: dict[str, str]) -> DataFrame:
    """A one-row table to (metric, value) rows, values as text."""
    pairs = [F.struct(F.lit(text).alias("metric"), F.col(c).cast("string").alias("value")) for c, text in names.items()]
    return one_row.select(F.inline(F.array(*pairs)))


def _device_counts(devices: DataFrame) -> DataFrame:
    return devices.agg(
        F.count(F.lit(1)).alias("devices"),
        F.count_if(F.col("num_cliente") > 100).alias("over_100"),
        F.count_if(F.col("num_cliente") > 50).alias("over_50"),
        F.count_if(F.col("revisar_imagenes") == "si").alias("review"),
    )


def executive_summary(
    tx: DataFrame, references: DataFrame, labels: DataFrame, active: DataFrame,
    stats: DataFrame, devices: DataFrame,
) -> DataFrame:
    """(metric, value) rows: extraction counts, active models, analysis and device figures."""
    counts = [
        as_metric_rows(df.agg(F.count(F.lit(1)).alias("n")), {"n": text})
        for df, text in (
            (tx, "Total registros Elasticsearch"),
            (references, "Total referencias"),
            (labels, "Total labels"),
        )
    ]
    scope = F.concat(F.lit(" "), F.col("deployment_id")) if "deployment_id" in active.columns else F.lit("")
    usage = {
        "Model ID": F.col("model_id").cast("string"),
        "Frecuencia": F.col("frequency").cast("string"),
        "Porcentaje uso": F.format_string("%.1f%%", F.round("percentage", 1)),
    }
    models = active.select(F.inline(F.array(*[
        F.struct(F.concat(F.lit(text), scope).alias("metric"), value.alias("value")) for text, value in usage.items()
    ])))
    analysis = as_metric_rows(stats, {
        "total_filtered_references": "Referencias filtradas",
        "unassigned_count": "Referencias sin asignar",
        "untrained_count": "Referencias no entrenadas",
        "high_confidence_suggestions": "Sugerencias alta confianza",
        "low_confidence_suggestions": "Sugerencias baja confianza",
    })
    fleet = as_metric_rows(_device_counts(devices), {
        "devices": "Total devices",
        "over_50": "Devices activos (>50 trans)",
        "review": "Devices con revisar_imagenes=si",
    })
    rows = counts[0]
    for part in (*counts[1:], models, analysis, fleet):
        rows = rows.unionByName(part)
    return rows


def consistency_report(stats: DataFrame, devices: DataFrame) -> DataFrame:
    """(metric, value) rows of the consistency tab."""
    products = stats.withColumn("trained_count", F.col("total_references") - F.col("untrained_count"))
    return as_metric_rows(products, {
        "total_references": "Total referencias procesadas",
        "unassigned_count": "Referencias sin asignar",
        "untrained_count": "Referencias no entrenadas",
        "trained_count": "Referencias entrenadas",
    }).unionByName(as_metric_rows(_device_counts(devices), {
        "devices": "Total devices analizados",
        "over_100": "Devices con transacciones > 100",
        "over_50": "Devices con transacciones > 50",
    }))


def one_sided_references(unassigned: DataFrame, untrained: DataFrame, shown: int | None = None) -> DataFrame:
    """Products that are only unassigned and products that are only untrained; of each kind the first ``shown``, if given."""
    def side(a: DataFrame, b: DataFrame, text: str) -> DataFrame:
        codes = a.select("reference_code").distinct().join(b.select("reference_code"), "reference_code", "left_anti")
        codes = codes.orderBy("reference_code").limit(shown) if shown is not None else codes
        return codes.select(F.lit(text).alias("categoria"), "reference_code")

    return side(unassigned, untrained, "SOLO SIN ASIGNAR").unionByName(
        side(untrained, unassigned, "SOLO NO ENTRENADAS"))


def decision_columns(
    references: DataFrame, min_client: int = MIN_CLIENT_ROWS, images: int = IMAGES_PER_PRODUCT
) -> DataFrame:
    """Columns a person edits: include from ``min_client`` client rows on, with class and label."""
    clients = column_or(references, "num_cliente", F.lit(0))
    included = F.coalesce(clients.try_cast("double"), F.lit(0.0)) >= min_client
    trained_class = column_or(references, "producto_trained", F.lit(None).cast("string"))
    label = whole_number_in(references, "label_id") if "label_id" in references.columns else F.lit(None).cast("bigint")
    columns = {
        "incluir_dataset": F.when(included, F.lit("si")).otherwise(F.lit("no")),
        "devices_incluir": F.lit("devices_seleccionados"),
        "num_imagenes_dataset": F.when(included, F.lit(images)),
        "producto_a_entrenar": F.when(included, trained_class),
        "label_considerar": F.when(included, label),
    }
    if "revisar_imagenes" in references.columns:
        columns["revisar_imagenes"] = normalize_yes_no(F.col("revisar_imagenes"))
    return references.withColumns(columns)


def consolidated_references(
    references: DataFrame, analysed: DataFrame, min_client: int = MIN_CLIENT_ROWS, fleet: bool = False
) -> DataFrame:
    """Catalogue rows with their metrics and decision columns, without audit columns.

    A ``fleet`` report keeps ``deployment_id``: decisions made from it name their deployment.  Rows meet by reference_id, else by code (and deployment): one row per catalogue row.
    """
    added = [c for c in analysed.columns if c not in references.columns]
    keys = ["reference_id"] if {"reference_id"} <= {*references.columns} & {*analysed.columns} else [
        c for c in ("deployment_id", "reference_code") if c in references.columns and c in analysed.columns]
    merged = references.join(analysed.select(*keys, *added), keys, "left")
    return decision_columns(merged, min_client).drop(
        "created_at", "updated_at", "num_apariciones", *([] if fleet else ["deployment_id"])
    )


def model_class_table(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per class and trained label with the label's name; classes without labels stay."""
    names = labels.select(whole_number_in(labels, "label_id").alias("_label"), "label_name")
    return classes.join(names, F.col("label_id") == F.col("_label"), "left").select(
        "model_id", "model_code", "class_index",
        F.coalesce("class_name", F.lit("No hay datos de clases disponibles")).alias("class_name"),
        "label_id",
        F.when(F.col("label_id").isNotNull(), F.coalesce("label_name", F.concat(F.lit("Label "), F.col("label_id"))))
        .otherwise(F.lit("")).alias("label_name"),
    )


def run_summary(processed: DataFrame, undefined: DataFrame, top_dates: int | None = None) -> DataFrame:
    """(section, metric, value) rows: flag totals, image coverage, status, dates, undefined pairs.

    With ``top_dates`` only so many of the most frequent activation dates.
    """
    def count_where(c: Column) -> Column:
        return F.count_if(c).cast("bigint")

    total = F.count(F.lit(1)).cast("bigint")
    flags = ("lista_larga", "lista_un_candidato", "top_k_0", "top_k_medio", "top_k_alto", "is_trained",
             "lista_similar_completa", "producto_seleccionado_similar", "model_ok_general_fail")
    measures = {
        "records": total,
        **{f: F.sum(f).cast("bigint") for f in flags},
        "no_clasificado": count_where(F.col("pos_candidato_elegido") == "NO_CLASIFICADO"),
        "expected_accuracy": count_where(F.col("pct_ok_modelo_previsto").isNotNull()),
        "no_similares": count_where(F.col("num_referencias_no_similares") > 0),
        "similares": count_where(F.col("num_referencias_similares") > 0),
        "with_image": count_where(F.col("has_image") == 1),
        "images": F.sum("num_images").cast("bigint"),
    }
    # one pass over the rows: sums per (status, date), from which every section is added up
    cells = processed.groupBy("estado_dispositivo", "fecha_encendido").agg(
        *[m.alias(f"_{n}") for n, m in measures.items()]
    )

    def entry(section: str, metric: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), metric.alias("metric"), value.alias("value"))

    sections = F.array(
        *[entry("totals", F.lit(n), F.col(f"_{n}")) for n in measures],
        entry("device_status", F.col("estado_dispositivo"), F.col("_records")),
        entry("activation", F.col("fecha_encendido"), F.col("_records")),
    )
    rows = cells.select(F.inline(sections)).groupBy("section", "metric").agg(F.sum("value").alias("value"))
    # there are as many dates as days with activations, so ranking them is small
    place = F.row_number().over(W.partitionBy("section").orderBy(F.col("value").desc(), "metric"))
    rows = (
        rows.withColumn("_place", place)
        .filter((F.col("section") != "activation") | (F.col("_place") <= top_dates if top_dates is not None else F.lit(True))).drop("_place")
    )
    pairs = undefined.agg(
        count_where(F.col("num_parejas_no_definidas") > 0).alias("deployments"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in
          ("num_parejas_no_definidas", "num_veces_seleccionadas", "num_veces_listas")],
    )
    return rows.unionByName(pairs.select(F.inline(F.array(*[
        entry("undefined_pairs", F.lit(c), F.col(c)) for c in pairs.columns
    ]))))


def download_summary(manifest: DataFrame) -> DataFrame:
    """Planned, failed and total images per reason and their success rate."""
    good = F.count_if(F.col("download_status") != "failed")
    total = F.count(F.lit(1))
    return manifest.groupBy("motivo_descarga").agg(
        total.alias("total"), good.alias("planned"), (total - good).alias("failed"),
        percent(good, total, 2).alias("success_rate"),
    )
