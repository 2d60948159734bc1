"""Images for a person to review: marked products, their look-alikes and marked devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighlens.functions.codes import normalize_device_id
from weighlens.functions.ranking import sample_per_group
from weighlens.operators.labelling import filter_by_transaction_type
from weighlens.schemas import IMAGES_PER_REVIEW, SEED, require, shared_scope
from weighlens.sources.decisions import marked_for_review


def _correct(tx: DataFrame) -> DataFrame:
    return tx.filter((F.col("Ok") == 1) & (F.col("Ok_modelo") == 1))


def similar_sub_products(tx: DataFrame, references: DataFrame) -> DataFrame:
    """Per predicted label (lower case): products chosen in rows that were right on all counts.

    Where both sides have ``deployment_id``, labels and products of one deployment only meet each other.
    """
    scope = shared_scope(tx, references)
    seen = (
        _correct(tx)
        .select(*scope, F.lower("result_label_name").alias("similar_name"), "selected_reference_code")
        .dropna().distinct()
    )
    products = references.select(
        *scope, F.col("reference_code").alias("selected_reference_code"), "reference_code", "reference_name", "label_id", "label_name"
    )
    return seen.join(products, [*scope, "selected_reference_code"]).select(
        *scope, "similar_name", "selected_reference_code", "reference_code", "reference_name", "label_id", "label_name"
    )


def products_to_review(
    decisions: DataFrame, sub_products: DataFrame | None, classes_too: bool = True
) -> DataFrame:
    """One row per thing to look at: each product's own class, then its top-3 look-alikes.

    A look-alike without sub-products stays as the class itself.  ``entry_id`` names the row.  The rows keep the decisions'
    ``deployment_id``, if there is one, and look-alikes are then of the same deployment.
    """
    require(decisions, "reference_id", "reference_code", "reference_name", "label_name", "label_id")
    scope = shared_scope(decisions)
    no_text = F.lit(None).cast("string")
    label = F.col("label_id").cast("string")
    main = decisions.select(
        F.coalesce("label_name", F.lower("reference_name")).alias("name"),
        F.lit("clase_principal").alias("type"),
        F.lit(None).cast("int").alias("result_index"),
        "reference_id", "reference_name",
        no_text.alias("parent_similar_name"), label.alias("label_id"), "reference_code",
        no_text.alias("selected_reference_code"), *scope,
    )
    if not classes_too or sub_products is None:
        return _with_entry_id(main)
    tops = F.array(*[
        F.struct(
            F.lit(f"similar_top{i}").alias("type"),
            F.col(f"top{i}_result_index").cast("int").alias("result_index"),
            F.col(f"top{i}_result_label_name").alias("parent_similar_name"),
        ) for i in (1, 2, 3)
    ])
    similar = (
        decisions.select(*scope, "reference_id", "reference_name", F.inline(tops))
        .filter(F.col("result_index").isNotNull() & F.col("parent_similar_name").isNotNull())
        .withColumn("_similar", F.lower("parent_similar_name"))
    )
    shared = shared_scope(decisions, sub_products)
    subs = sub_products.select(
        *shared, F.col("similar_name").alias("_similar"), "label_name", F.col("label_id").cast("string").alias("label_id"),
        "reference_code", "selected_reference_code",
    )
    found = F.col("selected_reference_code").isNotNull()
    similar = similar.join(subs, [*shared, "_similar"], "left").select(
        F.when(found, F.col("label_name")).otherwise(F.col("parent_similar_name")).alias("name"),
        "type", "result_index", "reference_id", "reference_name", "parent_similar_name",
        "label_id", "reference_code", "selected_reference_code", *scope,
    )
    return _with_entry_id(main.unionByName(similar))


def _with_entry_id(entries: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (
        *shared_scope(entries), "reference_id", "type", "parent_similar_name", "selected_reference_code")]
    return entries.withColumn("entry_id", F.concat_ws("|", *parts))


# The three ways an entry finds its rows.
_BY_NAME, _BY_CODE, _BY_LABEL = "name", "code", "label"


def _ways(values: dict[str, Column]) -> Column:
    """The (way, value) pairs under which a row can be found."""
    return F.array(*[F.struct(F.lit(how).alias("_how"), what.alias("_what")) for how, what in values.items()])


def sample_for_review(
    entries: DataFrame, tx: DataFrame, images: int = IMAGES_PER_REVIEW, mode: str = "ambas", seed: int = SEED
) -> DataFrame:
    """Seeded sample of rows with an image for every entry.

    The product's own class goes by selected name, sub-products by code among correct rows,
    plain look-alikes by predicted label among correct rows.  Many entries share one search
    (a look-alike of several products), so each distinct search is sampled once and its rows
    are then given to the entries: the fact rows are never multiplied by the entries.  A search
    stays in the entry's deployment, where entries and rows both name one.
    """
    keys = [*shared_scope(entries, tx), "_how", "_what"]
    main = F.col("type") == "clase_principal"
    by_code = F.coalesce(F.col("selected_reference_code") != "", F.lit(False))
    search = entries.withColumns({
        "_how": F.when(main, F.lit(_BY_NAME)).when(by_code, F.lit(_BY_CODE)).otherwise(F.lit(_BY_LABEL)),
        "_what": F.when(main, F.upper("reference_name"))
        .when(by_code, F.col("selected_reference_code")).otherwise(F.lower("name")),
    })
    wanted = search.select(*keys).dropna().distinct()

    right = (F.col("Ok") == 1) & (F.col("Ok_modelo") == 1)
    ways = _ways({
        _BY_NAME: F.upper("selected_reference_name"),
        _BY_CODE: F.when(right, F.col("selected_reference_code")),
        _BY_LABEL: F.when(right, F.lower("result_label_name")),
    })
    columns = ["transaction_id", "transaction_start_time", "device_id", "device_name",
               "selected_reference_name", "result_label_name", "confidence", "Ok", "Ok_modelo", "image_link"]
    rows = (
        filter_by_transaction_type(tx, mode)
        .filter(F.col("has_image") == 1)
        .select(*columns, *keys[:-2], F.inline(ways))
        .filter(F.col("_what").isNotNull())
        .join(wanted, keys)
    )
    picked = sample_per_group(rows, keys, "transaction_id", images, seed)
    return picked.join(search.select(
        "entry_id", F.col("reference_name"), F.col("name").alias("product_name"),
        F.col("type").alias("product_type"), "parent_similar_name", "label_id", *keys,
    ), keys).drop("_how", "_what")


def sample_devices_for_review(
    devices: DataFrame, tx: DataFrame, images: int = IMAGES_PER_REVIEW, mode: str = "ambas", seed: int = SEED
) -> DataFrame:
    """Seeded sample of rows with an image for every marked device.

    Numeric ids are compared as numbers; a device without one goes by its lower-cased name.
    """
    def keys(df: DataFrame):
        number = F.when(
            F.col("device_id").cast("string").try_cast("double").isNotNull(),
            normalize_device_id(F.col("device_id")),
        )
        return number, F.lower(F.col("device_name").cast("string"))

    number, name = keys(devices)
    marked = marked_for_review(devices).select(
        F.when(number.isNotNull(), F.lit("id")).otherwise(F.lit("name")).alias("_how"),
        F.coalesce(number, name).alias("_what"),
        F.coalesce("device_name", F.col("device_id").cast("string")).alias("product_name"),
    ).dropna(subset=["_what"]).dropDuplicates(["_how", "_what"])
    number, name = keys(tx)
    rows = (
        filter_by_transaction_type(tx, mode)
        .filter(F.col("has_image") == 1)
        .select("*", F.inline(_ways({"id": number, "name": name})))
        .filter(F.col("_what").isNotNull())
        .join(marked, ["_how", "_what"])
    )
    return (
        sample_per_group(rows, ["_how", "_what"], "transaction_id", images, seed)
        .withColumn("product_type", F.lit("device")).drop("_how", "_what")
    )
