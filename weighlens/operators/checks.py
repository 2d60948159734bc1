"""Input checks, export cleaning and JSON flattening."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weighlens.functions.codes import whole_number_in
from weighlens.schemas import require
from weighlens.sources.decisions import marked_for_dataset

# Fixed limit of a spreadsheet cell, for callers whose target is one.
CELL_LIMIT = 32767


def check_required(df: DataFrame, required: list[str]) -> DataFrame:
    """(column, missing_rows) for required columns, counted in one pass; absent columns raise."""
    require(df, *required)
    empty = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in required]
    counts = df.agg(*empty)
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_rows")) for c in required
    ])))


def check_deployment_id(deployment_id: object) -> int:
    if isinstance(deployment_id, bool) or not isinstance(deployment_id, int) or deployment_id <= 0:
        raise ValueError("deployment_id must be a positive whole number")
    return deployment_id


def validate_decisions(decisions: DataFrame) -> DataFrame:
    """Included rows with typed ``class`` and ``label_id`` and an ``error`` text (NULL when good)."""
    require(decisions, "reference_name", "producto_a_entrenar", "label_considerar")

    def blank(name: str) -> Column:
        return F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")

    label = whole_number_in(decisions, "label_considerar")
    return marked_for_dataset(decisions).withColumns({
        "class": F.trim(F.col("producto_a_entrenar").cast("string")),
        "label_id": label,
        "error": F.when(blank("producto_a_entrenar") | blank("label_considerar"), F.lit("missing class or label"))
        .when(label.isNull(), F.lit("label is not a number")),
    })


class InvalidDecisions(ValueError):
    """Some included decision rows cannot be used."""


def valid_decisions(decisions: DataFrame) -> DataFrame:
    """Validated rows; raises with up to 50 examples when any row has an error."""
    checked = validate_decisions(decisions)
    bad = checked.filter(F.col("error").isNotNull()).select("reference_name", "error").limit(50).take(50)
    if bad:
        raise InvalidDecisions("; ".join(f"{r.reference_name}: {r.error}" for r in bad))
    return checked.drop("error")


def clean_for_export(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Nested values to text, control marks removed, infinities and NULLs filled; text cut only to a given ``limit``."""
    def clean(f: T.StructField) -> Column:
        column, kind = F.col(f.name), f.dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            column, kind = F.to_json(column), T.StringType()
        if isinstance(kind, T.StringType):
            text = F.translate(column, "\x00�", "")
            column = F.coalesce(F.substring(text, 1, limit) if limit else text, F.lit(""))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            finite = ~F.isnan(column) & (F.abs(column) != float("inf"))
            column = F.when(F.coalesce(finite, F.lit(False)), column).otherwise(F.lit(0.0))
        elif isinstance(kind, T.NumericType):
            column = F.coalesce(column, F.lit(0).cast(kind))
        return column.alias(f.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def _object_lists(schema: T.StructType) -> bool:
    """Whether some list of objects lies in the schema, at any depth."""
    return any(
        isinstance(k, T.ArrayType) and isinstance(k.elementType, T.StructType) or isinstance(k, T.StructType) and _object_lists(k)
        for k in (f.dataType for f in schema.fields)
    )


def list_lengths(df: DataFrame) -> dict[str, int]:
    """Greatest length of every list of objects, by its flat name without numbers; one job."""
    sizes: list[Column] = []

    def visit(kind: T.DataType, name: str, values: Column) -> None:
        """``values`` is an array of all values that a row has under this name."""
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                visit(f.dataType, f"{name}_{f.name}", F.transform(values, lambda v: v[f.name]))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            sizes.append(F.max(F.array_max(F.transform(values, lambda v: F.size(v)))).alias(name))
            visit(kind.elementType, name, F.flatten(F.filter(values, lambda v: v.isNotNull())))

    for f in df.schema.fields:
        visit(f.dataType, f.name, F.array(F.col(f"`{f.name}`")))
    return {name: max(n or 0, 0) for name, n in df.agg(*sizes).first().asDict().items()} if sizes else {}


def flatten_nested(df: DataFrame, separator: str = "_", lengths: dict[str, int] | None = None) -> DataFrame:
    """Struct fields to flat ``parent_child`` columns, plain lists to ', ' text, object lists numbered at any depth.

    A list of objects becomes as many numbered columns as ``lengths`` says for its name (names joined by '_', without
    numbers): the plan then needs no look at the data.  Without ``lengths`` they are read first (``list_lengths``).
    """
    if lengths is None:
        lengths = list_lengths(df) if _object_lists(df.schema) else {}

    def leaves(kind: T.DataType, name: str, plain: str, here: Column) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [c for f in kind.fields for c in leaves(f.dataType, f"{name}{separator}{f.name}", f"{plain}_{f.name}", here[f.name])]
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return [
                c for i in range(lengths.get(plain, 0))
                for c in leaves(kind.elementType, f"{name}{separator}{i}", plain, F.get(here, F.lit(i)))
            ]
        if isinstance(kind, T.ArrayType):
            return [F.array_join(F.transform(here, lambda v: v.cast("string")), ", ").alias(name)]
        return [here.alias(name)]

    return df.select(*[c for f in df.schema.fields for c in leaves(f.dataType, f.name, f.name, F.col(f"`{f.name}`"))])


def flatten_json(df: DataFrame, column: str, schema: str | T.StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """JSON text to flat ``<column>_<key>`` columns beside the others."""
    return flatten_nested(df.withColumn(column, F.from_json(F.col(column), schema)), lengths=lengths)


def json_kind(df: DataFrame, column: str) -> T.DataType:
    """The type that all JSON texts of a column have in common, found in one aggregation over variants.

    Keys of any text are fields, numbers keep their kind, and what differs from text to text in kind is text.  Texts that are
    no JSON, NULLs and empty lists say nothing.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]

    def plain(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(plain(kind.elementType))
        return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind

    return plain(T.DataType.fromDDL(_OBJECT.sub("STRUCT<", found or "VOID")))


def _ddl(kind: T.DataType) -> str:
    """A type as text, with its field names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


_OBJECT = re.compile(r"(?<![^<\s])OBJECT<")  # at the beginning, in a list or behind a field's name


def flatten_variant(df: DataFrame, column: str, lengths: dict[str, int] | None = None) -> DataFrame:
    """As ``flatten_json`` for texts whose keys nobody has declared: fields and their types come from the data.

    A text that is no JSON, or none of the kind that the others have, gives NULLs.  Keys that differ only in case cannot
    both be columns; such data need a declared schema.
    """
    kind = json_kind(df, column)
    value = F.try_variant_get(F.try_parse_json(F.col(column)), "$", _ddl(kind))
    return flatten_nested(df.withColumn(column, value), lengths=lengths)
