"""Fixed values and column declarations shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values of the data source: metric codes, extensions, accepted answers.
CLIENT_METRICS = ("WSPROCESSCOMPLETED03", "GFRSUSERPROCESSCOM03")
USER_METRIC = "GFRSUSERPROCESSCOM03"
MANUAL_METRIC = "WSREFERENCEIMAGEAC01"
ALL_METRICS = ("WSPROCESSCOMPLETED03", "GFRSUSERPROCESSCOM03", "WSREFERENCEIMAGEAC01")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp")
URL_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif")
FOLDER_EXTENSIONS = (".jpg", ".jpeg", ".png")
YES_REVIEW = ("si", "sí", "yes", "y")
YES_DATASET = ("si", "sí")
YES_VALID_PAIR = ("true", "1", "yes", "sí", "si")
EMPTY_TEXT = ("", "nan", "None")

# Fixed defaults of the reports.
DAYS_BACK = 3
LONG_LIST = 6
MIN_APPEARANCES = 5
MIN_ACCURACY_ROWS = 10
MIN_CLIENT_ROWS = 150
IMAGES_PER_PRODUCT = 150
IMAGES_FALLBACK = 50
IMAGES_PER_REVIEW = 10
SEED = 42

TRANSACTION_DATA = T.StructType([
    T.StructField("model_id", T.IntegerType()),
    T.StructField("result_index", T.IntegerType()),
    T.StructField("result_label_name", T.StringType()),
    T.StructField("selected_reference_code", T.StringType()),
    T.StructField("selected_reference", T.StringType()),
    T.StructField("selected_reference_name", T.StringType()),
    T.StructField("selected_reference_index", T.IntegerType()),
    T.StructField("selected_reference_is_trained", T.BooleanType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("topk", T.LongType()),
    T.StructField("predicted_codes", T.ArrayType(T.StringType())),
    T.StructField("predicted_names", T.ArrayType(T.StringType())),
])

MODEL_CLASSES = "array<struct<index:int,index_name:string,trained_labels:array<bigint>>>"

DATASET_LOG = {
    "reference_name": "string", "clase_name": "string", "label_id": "bigint",
    "transaction_id": "string", "transaction_start_time": "string", "device_id": "bigint",
    "s3_key": "string", "local_path": "string", "download_status": "string",
    "error_reason": "string", "dataset_folder": "string", "motivo_descarga": "string",
    "valor_motivo": "string", "origen": "string", "dataset_original": "string",
    "relative_folder": "string",
}

REVIEW_LOG = (
    "reference_name", "product_name", "product_type", "download_status", "transaction_id",
    "device_id", "device_name", "result_label_name", "s3_key", "local_path",
)

REGISTRY = ("dataset_name", "created_at", "deployment_id", "trained_model", "description", "s3_path")


class MissingColumns(ValueError):
    """A required input column is absent."""


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df


def shared_scope(*frames: DataFrame) -> list[str]:
    """What a code, name or label is unique in: the deployment, where all frames name one."""
    return ["deployment_id"] if all("deployment_id" in f.columns for f in frames) else []


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add absent optional columns as typed NULLs."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def is_true(df: DataFrame, name: str) -> Column:
    """TRUE for true or 1, whatever the column's type; NULL counts as false."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.coalesce(F.col(name), F.lit(False))
    return F.coalesce(F.lower(F.col(name).cast("string")).isin("true", "1", "1.0"), F.lit(False))


def is_false(df: DataFrame, name: str) -> Column:
    """TRUE for false or 0; NULL is neither."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.coalesce(~F.col(name), F.lit(False))
    return F.coalesce(F.lower(F.col(name).cast("string")).isin("false", "0", "0.0"), F.lit(False))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole rounded, 0.0 for an empty whole."""
    return F.coalesce(F.round(F.try_divide(F.lit(100.0) * part, whole), digits), F.lit(0.0))
