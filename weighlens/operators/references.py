"""Products joined with labels, model classes and transaction metrics.

Transactions are aggregated by (match key, ...) before they meet the product table, so a
product that holds a large share of all rows is reduced to a few counts on the map side.

Codes and names belong to a deployment: where both sides have ``deployment_id`` it is part of
every match, so a whole fleet can be worked on in one frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weighlens.functions.codes import whole_number_in
from weighlens.functions.quality import is_client, is_manual
from weighlens.operators.models import mark_active
from weighlens.schemas import MIN_APPEARANCES, is_false, is_true, percent, require


def label_id_of(references: DataFrame) -> Column:
    return whole_number_in(references, "label_id")


def references_with_labels(references: DataFrame, labels: DataFrame) -> DataFrame:
    """Products with ``label_name``; ids are compared as numbers and NULL matches nothing."""
    names = labels.select(whole_number_in(labels, "label_id").alias("_label"), "label_name").dropna(subset=["_label"])
    return (
        references.withColumn("label_id", label_id_of(references))
        .join(names, F.col("label_id") == F.col("_label"), "left").drop("_label")
    )


def class_of_label(classes: DataFrame, last: bool = True, per_model: bool = False) -> DataFrame:
    """One class name per trained label (``per_model``: of each model): of several classes the last (or first) one."""
    at = F.struct("class_pos", "label_pos")
    pick = F.max_by if last else F.min_by
    keys = [F.col("model_id").alias("_model")] if per_model else []
    return (
        classes.filter(F.col("label_id").isNotNull())
        .groupBy(*keys, F.col("label_id").alias("_label"))
        .agg(pick("class_name", at).alias("producto_trained"))
    )


def references_with_model(
    references: DataFrame, classes: DataFrame, last: bool = True, deployments: DataFrame | None = None
) -> DataFrame:
    """Products with ``is_in_dataset`` and the class they are trained in.

    With ``deployments`` (deployment_id, model_id) a product meets the classes of its own deployment's
    model only; without it ``classes`` must be those of one model.
    """
    known = class_of_label(classes, last, deployments is not None).withColumn("_known", F.lit(True))
    match = label_id_of(references) == F.col("_label")
    if deployments is not None:
        own = deployments.groupBy(F.col("deployment_id").alias("_deployment")).agg(F.max("model_id").alias("_own"))
        known = known.join(own, F.col("_model") == F.col("_own")).drop("_model", "_own")
        match = match & (F.col("deployment_id") == F.col("_deployment"))
    return (
        references.join(known, match, "left")
        .withColumn("is_in_dataset", F.col("_known").isNotNull())
        .drop("_label", "_known", "_deployment")
    )


def _scope(tx: DataFrame, references: DataFrame) -> list[str]:
    """What a code or name is unique in."""
    return [c for c in ("deployment_id",) if c in tx.columns and c in references.columns]


def add_label_placeholder(references: DataFrame, labels: DataFrame) -> DataFrame:
    """``label_name`` with a readable stand-in for missing and unknown labels."""
    label = F.col("label_id")
    return references_with_labels(references, labels).withColumn(
        "label_name",
        F.when(label.isNull(), F.lit("NO_LABEL_ASSIGNED"))
        .otherwise(F.coalesce("label_name", F.concat(F.lit("LABEL_ID_"), label, F.lit("_NOT_FOUND")))),
    )


def _match_keys(code: Column, name: Column) -> Column:
    """The ways a row and a product can meet: by code and by name."""
    return F.array(
        F.struct(F.lit("code").alias("kind"), code.alias("key")),
        F.struct(F.lit("name").alias("kind"), name.alias("key")),
    )


def _transaction_keys(tx: DataFrame) -> Column:
    name = F.col("selected_reference") if "selected_reference" in tx.columns else F.lit(None).cast("string")
    return _match_keys(F.col("selected_reference_code"), name)


def _reference_keys(references: DataFrame, scope: list[str]) -> DataFrame:
    return (
        references.filter(F.col("reference_code").isNotNull())
        .select("reference_id", *scope, F.inline(_match_keys(F.col("reference_code"), F.col("reference_name"))))
        .filter(F.col("key").isNotNull())
    )


def transactions_by_reference(tx: DataFrame, references: DataFrame) -> DataFrame:
    """Each product's rows by code plus its rows by name; a row that matches both counts twice.

    One equi-join on (kind, key) instead of a condition with OR.
    """
    scope = _scope(tx, references)
    return (
        tx.select("*", F.inline(_transaction_keys(tx)))
        .filter(F.col("key").isNotNull())
        .join(_reference_keys(references, scope), [*scope, "kind", "key"])
        .drop("key").withColumnRenamed("kind", "matched_by")
    )


_GROUP = ["selected_reference_name", "result_index", "result_label_name"]


def _counts_by_reference(tx: DataFrame, references: DataFrame, active: DataFrame | int | None) -> DataFrame:
    """Counts per product and (selected name, predicted class, predicted label).

    The fact rows are summed per match key first; the product join sees only the sums.
    """
    metric = F.col("transaction_metric")
    client = is_client(metric)
    trained = is_true(tx, "selected_reference_is_trained")
    models = [c for c in ("deployment_id", "model_id") if c in tx.columns]
    per_key = (
        tx.select("*", F.inline(_transaction_keys(tx)))
        .filter(F.col("key").isNotNull())
        .groupBy("kind", "key", *models, *_GROUP)
        .agg(
            F.count_if(client).alias("_client"),
            F.count_if(is_manual(metric)).alias("_manual"),
            F.count_if(client & trained).alias("_trained"),
            F.count_if(client & (F.col("Ok") == 1)).alias("_ok"),
            F.count_if(client & trained & (F.col("Ok_modelo") == 1)).alias("_ok_modelo"),
            F.count_if(client & F.col("transaction_id").isNotNull()).alias("_ids"),
        )
    )
    on = F.col("_active")
    scope = _scope(tx, references)
    return (
        mark_active(per_key, active)
        .join(_reference_keys(references, scope), [*scope, "kind", "key"])
        .groupBy("reference_id", *_GROUP)
        .agg(
            *[F.sum(c).alias(c) for c in ("_client", "_manual", "_trained", "_ok", "_ids")],
            F.sum(F.when(on, F.col("_client"))).alias("_client_active"),
            F.sum(F.when(on, F.col("_ok"))).alias("_ok_active"),
            F.sum(F.when(on, F.col("_trained"))).alias("_trained_active"),
            F.sum(F.when(on, F.col("_ok_modelo"))).alias("_ok_modelo_active"),
        )
    )


def _rank_groups(counts: DataFrame) -> DataFrame:
    """Rank complete groups with client rows: most frequent first, ties by the group's own key."""
    complete = F.lit(True)
    for c in _GROUP:
        complete = complete & F.col(c).isNotNull()
    eligible = complete & (F.col("_client") > 0)
    order = W.partitionBy("reference_id").orderBy(
        eligible.desc(), F.col("_ids").desc(), *[F.col(c) for c in _GROUP]
    )
    return counts.withColumns({"_rank": F.row_number().over(order), "_eligible": eligible})


def _top3_columns(total: Column) -> list[Column]:
    columns = []
    for i in (1, 2, 3):
        here = F.col("_eligible") & (F.col("_rank") == i)
        ids, ok, n = (F.max(F.when(here, F.col(c))) for c in ("_ids", "_ok", "_client"))
        columns += [
            F.max(F.when(here, F.col("result_index"))).alias(f"top{i}_result_index"),
            F.max(F.when(here, F.col("result_label_name"))).alias(f"top{i}_result_label_name"),
            percent(ids, total, 2).alias(f"top{i}_pct_pesadas"),
            percent(ok, n, 2).alias(f"top{i}_pct_ok"),
        ]
    return columns


def top3_results(tx: DataFrame, references: DataFrame) -> DataFrame:
    """Per product its three most frequent (name, class, label) results over client rows."""
    counts = _counts_by_reference(tx, references, None).filter(F.col("_client") > 0)
    return _rank_groups(counts).groupBy("reference_id").agg(*_top3_columns(F.sum("_client")))


def reference_metrics(tx: DataFrame, references: DataFrame, active: DataFrame | int | None = None) -> DataFrame:
    """All products with counts, training state, accuracies and top-3 results.

    Accuracies use the active model's rows (per deployment when ``active`` is a table);
    the other figures use all rows.  Products without rows keep zeros.
    """
    require(tx, "selected_reference_code", "transaction_metric", "Ok", "Ok_modelo", *_GROUP)
    clients = F.sum("_client")
    metrics = (
        _rank_groups(_counts_by_reference(tx, references, active))
        .groupBy("reference_id")
        .agg(
            clients.alias("num_cliente"),
            F.sum("_manual").alias("num_manuales"),
            F.coalesce(F.try_divide(F.sum("_trained"), clients) >= 0.5, F.lit(False)).alias("is_trained_elastic"),
            F.sum("_trained").alias("trained_count"),
            percent(F.sum("_ok_active"), F.sum("_client_active"), 2).alias("pct_ok_sistema"),
            percent(F.sum("_ok_modelo_active"), F.sum("_trained_active"), 2).alias("pct_ok_modelo"),
            *_top3_columns(clients),
        )
    )
    zeros = {"num_cliente": 0, "num_manuales": 0, "trained_count": 0, "pct_ok_sistema": 0.0, "pct_ok_modelo": 0.0,
             "is_trained_elastic": False}
    zeros |= {f"top{i}_{c}": 0.0 for i in (1, 2, 3) for c in ("pct_pesadas", "pct_ok")}
    return (
        references.join(metrics, "reference_id", "left")
        .fillna(zeros)
        .withColumn("revisar_imagenes", F.lit("no"))
    )


def frequent_references(tx: DataFrame, references: DataFrame, min_client: int = MIN_APPEARANCES) -> DataFrame:
    """Products with at least ``min_client`` client rows, and both counts."""
    metric, scope = F.col("transaction_metric"), _scope(tx, references)
    counts = (
        tx.filter(F.col("selected_reference_code").isNotNull())
        .groupBy(*scope, F.col("selected_reference_code").alias("reference_code"))
        .agg(
            F.count_if(is_client(metric)).alias("cliente_appearances"),
            F.count_if(is_manual(metric)).alias("num_manuales"),
        )
        .filter(F.col("cliente_appearances") >= min_client)
    )
    return references.join(counts, [*scope, "reference_code"])


def reference_stats(tx: DataFrame, code: str | None = None) -> DataFrame:
    """Row counts and training share of one code - one row even without data - or of every code of every deployment."""
    rows = tx.filter(F.col("selected_reference_code") == code) if code is not None else tx.filter(
        F.col("selected_reference_code").isNotNull())
    metric = F.col("transaction_metric")
    trained = F.count_if(is_true(tx, "selected_reference_is_trained"))
    measures = [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(is_client(metric)).alias("client_transactions"),
        F.count_if(is_manual(metric)).alias("manual_transactions"),
        trained.alias("trained_transactions"),
        F.count_if(is_false(tx, "selected_reference_is_trained")).alias("not_trained_transactions"),
        percent(trained, F.count(F.lit(1)), 2).alias("training_percentage"),
    ]
    if code is not None:
        return rows.agg(*measures).select(F.lit(code).alias("reference_code"), "*")
    scope = _scope(tx, tx)
    return rows.groupBy(*scope, F.col("selected_reference_code").alias("reference_code")).agg(*measures)


def training_status(
    tx: DataFrame, references: DataFrame, classes: DataFrame, labels: DataFrame,
    min_client: int = MIN_APPEARANCES, deployments: DataFrame | None = None,
) -> DataFrame:
    """Frequent products with training counts, label name or stand-in, and first matching class."""
    metric, scope = F.col("transaction_metric"), _scope(tx, references)
    client = is_client(metric)
    counts = (
        tx.filter(F.col("selected_reference_code").isNotNull())
        .groupBy(*scope, F.col("selected_reference_code").alias("reference_code"))
        .agg(
            F.count_if(client).alias("num_cliente"),
            F.count_if(is_manual(metric)).alias("num_manuales"),
            F.count_if(client & is_true(tx, "selected_reference_is_trained")).alias("trained_count"),
            F.count_if(client & is_false(tx, "selected_reference_is_trained")).alias("not_trained_count"),
        )
        .filter(F.col("num_cliente") >= min_client)
    )
    frequent = references.join(counts, [*scope, "reference_code"]).withColumns({
        "is_trained_elastic": F.col("trained_count") / F.col("num_cliente") >= 0.5,
        "cliente_appearances": F.col("num_cliente"),
    })
    return references_with_model(add_label_placeholder(frequent, labels), classes, False, deployments).select(
        "reference_id", "reference_code", "reference_name", "label_id", "label_name", "num_cliente",
        "num_manuales", "is_trained_elastic", "is_in_dataset", "producto_trained", "trained_count",
        "not_trained_count", "cliente_appearances",
    )
