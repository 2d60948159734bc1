"""Products, labels, models and deployments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.schemas import MODEL_CLASSES, require


def scan_references(references: DataFrame, deployment_id: int) -> DataFrame:
    require(references, "reference_id", "reference_code", "reference_name", "label_id", "deployment_id")
    return references.filter(F.col("deployment_id") == deployment_id)


def scan_labels(labels: DataFrame) -> DataFrame:
    return require(labels, "label_id", "label_name").select("label_id", "label_name")


def scan_model_classes(models: DataFrame, model_id: int | None = None) -> DataFrame:
    """One row per model, class and trained label.

    ``model_data`` is a JSON list of classes or an object with a ``classes`` list; a class
    without labels keeps one row, unreadable JSON keeps one row with ``json_ok`` false.
    """
    if model_id is not None:
        models = models.filter(F.col("model_id") == model_id)
    text = F.ltrim(F.col("model_data"))
    classes = (
        F.when(text.startswith("["), F.from_json(text, MODEL_CLASSES))
        .when(text.startswith("{"), F.from_json(text, f"struct<classes:{MODEL_CLASSES}>")["classes"])
    )
    return (
        models.select("model_id", "model_code", classes.alias("_classes"))
        .select(
            "model_id", "model_code", F.col("_classes").isNotNull().alias("json_ok"),
            F.posexplode_outer("_classes").alias("class_pos", "_class"),
        )
        .select(
            "model_id", "model_code", "json_ok", "class_pos",
            F.col("_class.index").alias("class_index"),
            F.col("_class.index_name").alias("class_name"),
            F.posexplode_outer("_class.trained_labels").alias("label_pos", "label_id"),
        )
    )


def resolve_model(deployments: DataFrame, requests: DataFrame) -> DataFrame:
    """The model of each request and, as one sorted list, the other deployments that use it.

    ``requests`` holds (deployment_id, model_id); an explicit model wins, NULL means the
    deployment's own.  ``status`` is 'ok', 'unknown_deployment' or 'no_model'.
    """
    known = deployments.select("deployment_id", F.col("model_id").alias("_own"), F.lit(True).alias("_known"))
    explicit = F.col("model_id").isNotNull()
    resolved = requests.join(known, "deployment_id", "left").select(
        "deployment_id",
        F.coalesce("model_id", "_own").alias("model_id"),
        F.when(explicit, F.lit("argument")).otherwise(F.lit("deployment")).alias("source"),
        F.when(~explicit & F.col("_known").isNull(), F.lit("unknown_deployment"))
        .when(~explicit & F.col("_own").isNull(), F.lit("no_model"))
        .otherwise(F.lit("ok")).alias("status"),
    )
    users = deployments.groupBy(F.col("model_id").alias("_used")).agg(F.sort_array(F.collect_set("deployment_id")).alias("_users"))
    others = F.filter("_users", lambda d: d != F.col("deployment_id"))
    given = F.col("source") == "argument"
    return (
        resolved.join(users, (F.col("model_id") == F.col("_used")) & given, "left")
        .withColumn("conflict_deployment_ids", F.coalesce(others, F.array().cast("array<int>"))).drop("_used", "_users")
    )
