"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weighlens.storage import shared_dir

HASH_BITS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """Write a table once into the shared folder and go on from the files: later steps neither repeat
    the work nor depend on the executors that did it."""
    spark = rows.sparkSession
    path = shared_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def hash60(value: Column) -> Column:
    """60 evenly spread bits of a text, the same in every engine that has md5."""
    return F.conv(F.substring(F.md5(value), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
