"""Label suggestions and reports on new products.

``all_suggestions`` is an array of (label_id, count, percentage), best first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighlens.functions.paths import image_extension, safe_name
from weighlens.functions.ranking import first_per_group
from weighlens.schemas import IMAGES_FALLBACK, require, shared_scope


def percent_text(value: Column) -> Column:
    return F.format_string("%.1f%%", F.round(F.coalesce(value.cast("double"), F.lit(0.0)), 1))


def suggestions_wide(suggestions: DataFrame) -> DataFrame:
    """The three best suggestions as columns."""
    columns = {}
    for i in range(3):
        item = F.get("all_suggestions", F.lit(i))
        columns[f"sugerencia_{i + 1}_label_id"] = item["label_id"]
        columns[f"sugerencia_{i + 1}_porcentaje"] = F.when(item.isNotNull(), percent_text(item["percentage"]))
    return suggestions.withColumns(columns).drop("all_suggestions")


def suggestions_long(suggestions: DataFrame) -> DataFrame:
    """One row per suggestion, with the deployment if the suggestions have one."""
    require(suggestions, "reference_code", "reference_name", "total_detections", "suggestion_confidence")
    scope = shared_scope(suggestions)
    return suggestions.select(
        *scope, "reference_code", "reference_name", "total_detections",
        F.col("suggestion_confidence").alias("confidence_level"), F.inline("all_suggestions"),
    ).select(
        *scope, "reference_code", "reference_name", F.col("label_id").alias("suggested_label_id"), "count",
        percent_text(F.col("percentage")).alias("percentage"), "total_detections", "confidence_level",
    )


def similar_class_urls(
    suggestions: DataFrame, tx: DataFrame, labels: DataFrame, images: int = IMAGES_FALLBACK
) -> DataFrame:
    """First image URLs of every suggested label and the folder they go to.

    Rows count for their predicted and for their own label.  URLs are ranked per label and
    only then met with the suggestions' distinct labels, so nothing is ranked twice.  A label is one of a deployment
    where suggestions and rows both have ``deployment_id``.
    """
    scope = shared_scope(suggestions, tx)
    keys = [*scope, "label_id"]
    wanted = suggestions_long(suggestions).select(*scope, F.col("suggested_label_id").cast("bigint").alias("label_id")).dropna().distinct()
    names = [c for c in tx.columns if "image" in c.lower() and "url" in c.lower()]
    values = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(c).alias("url")) for i, c in enumerate(names)])
    ids = F.array_distinct(F.array_compact(F.array(F.col("predicted_label_id").cast("bigint"), F.col("label_id").cast("bigint"))))
    urls = (
        tx.select(*scope, F.explode(ids).alias("label_id"), "transaction_start_time", "transaction_id", values.alias("_v"))
        .join(wanted, keys, "left_semi")
        .select(*keys, "transaction_start_time", "transaction_id", F.inline("_v"))
        .filter(F.col("url").isNotNull())
    )
    first = first_per_group(
        urls, keys, [F.col("pos"), F.col("transaction_start_time"), F.col("transaction_id")],
        images, "image_no", "transaction_id",
    )
    of_label = ["label_id", *(shared_scope(labels) if scope else [])]
    named = labels.select(*of_label[1:], F.col("label_id").cast("bigint").alias("label_id"), "label_name")
    name = F.coalesce("label_name", F.concat(F.lit("label_"), F.col("label_id")))
    return first.join(named, of_label, "left").select(
        *scope, "label_id", name.alias("label_name"), "url", "image_no",
        F.concat(F.lit("label_"), F.col("label_id"), F.lit("_"), safe_name(name)).alias("directory"),
        F.concat(
            F.lit("image_"), F.lpad((F.col("image_no") - 1).cast("string"), 4, "0"), image_extension(F.col("url"), None)
        ).alias("filename"),
    )


def download_stats_join(untrained: DataFrame, downloads: DataFrame, suggestions: DataFrame) -> DataFrame:
    """New products with their download result and main suggestion, defaults where there is none.

    Codes belong to their deployment where both sides of a join have one.
    """
    of_download, of_suggestion = ([*shared_scope(untrained, other), "reference_code"] for other in (downloads, suggestions))
    downloaded = downloads.select(
        *of_download, F.col("downloaded").alias("imagenes_descargadas"),
        F.col("total_urls").alias("total_urls_encontradas"), "success_rate",
        F.col("output_directory").alias("directorio_imagenes"),
    )
    suggested = suggestions.select(
        *of_suggestion, F.col("confident_suggestion").cast("string").alias("sugerencia_confiable"),
        F.col("main_suggestion_label_id").cast("string").alias("sugerencia_principal"),
        "main_suggestion_percentage", F.col("suggestion_confidence").alias("nivel_confianza"),
    )
    return (
        untrained.join(downloaded, of_download, "left").join(suggested, of_suggestion, "left")
        .withColumns({
            "tasa_exito_descarga": percent_text(F.col("success_rate")),
            "porcentaje_sugerencia": percent_text(F.col("main_suggestion_percentage")),
        })
        .drop("success_rate", "main_suggestion_percentage")
        .fillna({
            "imagenes_descargadas": 0, "total_urls_encontradas": 0, "directorio_imagenes": "N/A",
            "sugerencia_confiable": "N/A", "sugerencia_principal": "N/A", "nivel_confianza": "Sin datos",
        })
    )


def new_references_report(
    analysed: DataFrame, downloads: DataFrame, suggestions: DataFrame
) -> dict[str, DataFrame]:
    """Untrained products with download and suggestion data, and all suggestions in detail."""
    untrained = analysed.filter(~F.coalesce("is_trained_elastic", F.lit(False)))
    return {
        "new_references": download_stats_join(untrained, downloads, suggestions),
        "suggestions": suggestions_long(suggestions),
    }
