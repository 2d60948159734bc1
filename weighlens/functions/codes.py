"""Codes, ids and yes/no answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weighlens.schemas import EMPTY_TEXT


def normalize_code(code: Column) -> Column:
    """'00014' and ' 14 ' become '14'; anything that is not a whole number stays as trimmed text."""
    text = F.trim(code)
    return F.when(
        text.rlike(r"^[+-]?[0-9]+$"), F.coalesce(text.try_cast("bigint").cast("string"), text)
    ).otherwise(text)


def normalize_device_id(device_id: Column) -> Column:
    """'10039.0' and 10039 become '10039'; names stay as trimmed text."""
    text = F.trim(device_id.cast("string"))
    number = text.try_cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(9e18))
    return F.coalesce(
        text.try_cast("bigint").cast("string"),
        F.when(usable, number.try_cast("bigint").cast("string")),
        text,
    )


def strip_decimal_suffix(device_id: Column) -> Column:
    """Trimmed id without a trailing '.0'; NULL when nothing usable is left."""
    text = F.regexp_replace(F.trim(device_id.cast("string")), r"\.0$", "")
    return F.when(~text.isin(*EMPTY_TEXT), text)


def answer_is(answer: Column, accepted: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(F.trim(answer.cast("string"))).isin(*accepted), F.lit(False))


def normalize_yes_no(answer: Column) -> Column:
    """true/'True'/'sí'/'si'/1 become 'si', everything else 'no'."""
    text = answer.cast("string")
    yes = text.isin("true", "True", "sí", "si", "1", "1.0")
    return F.when(F.coalesce(yes, F.lit(False)), F.lit("si")).otherwise(F.lit("no"))


def whole_number_in(df: DataFrame, name: str) -> Column:
    """The column as bigint, parsed only where it is not a whole number already."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return whole_number(F.col(name))


def whole_number(text: Column) -> Column:
    """Numeric text to bigint ('20.0' is 20); NULL when it is not a number."""
    trimmed = F.trim(text.cast("string"))
    number = trimmed.try_cast("double")
    return F.coalesce(
        trimmed.try_cast("bigint"), F.when(~F.isnan(number), number.try_cast("bigint"))
    )
