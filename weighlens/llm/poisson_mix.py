"""Mixing sources to target weights by Poisson replication.

A source with ``size`` bytes that shall give ``share`` of ``epochs`` times all bytes has the mean repetition rate
share * epochs * total / size.  Every document draws its number of copies from a Poisson distribution with its
source's rate, by inverting the distribution at a number hashed from (seed, id): the same copies on any cluster and
after any retry.  Copies are exploded and dealt out by a hash of (seed, id, copy): a global shuffle in one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighlens.llm.common import HASH_BITS, hash60, staged, utf8_size

PART = 32.0  # a rate above this is drawn as a sum of equal smaller ones: exp(-rate) keeps its precision


def unit(*parts: Column) -> Column:
    """Number in [0, 1) hashed from the parts."""
    return F.shiftright(hash60(F.concat_ws("|", *parts)), HASH_BITS - 52) / F.lit(float(1 << 52))


def poisson_count(rate: Column, seed: int, row_id: Column) -> Column:
    """Copies of a row: the smallest k whose distribution function exceeds the row's number.

    Terms stop where they no longer change the sum in double precision (rate + 12 sqrt(rate) + 20 terms).
    """
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    small = rate / parts

    def draw(u: Column) -> Column:
        terms = F.ceil(small + 12 * F.sqrt(small) + 20).cast("int")
        state = F.struct(F.exp(-small).alias("p"), F.exp(-small).alias("below"), F.lit(0).alias("k"))
        last = F.aggregate(
            F.sequence(F.lit(1), terms), state,
            lambda s, i: F.struct(
                (s["p"] * small / i).alias("p"), (s["below"] + s["p"] * small / i).alias("below"),
                (s["k"] + (u >= s["below"]).cast("int")).alias("k"),
            ),
        )
        return last["k"]

    total = F.aggregate(
        F.sequence(F.lit(0), parts - 1), F.lit(0),
        lambda s, i: s + draw(unit(F.lit(str(seed)), row_id, i.cast("string"))),
    )
    return F.when(rate > 0, total).otherwise(0)


def source_rates(docs: DataFrame, weights: DataFrame | None, temperature: float, epochs: float,
                 text: str = "text", source: str = "source") -> DataFrame:
    """(__source, rate) of every source; NULL is a source of its own.

    ``weights`` (columns source and weight) fixes the shares; a source missing there has weight 0 and gives no rows.
    Without it a source's weight is its size to the power ``temperature``: 1 keeps the mix, 0 makes all sources equal.
    """
    sizes = docs.groupBy(F.col(source).alias("__source")).agg(F.sum(utf8_size(F.col(text)) + 1).alias("__size"))
    sizes = staged(sizes, "mix-sizes")
    if weights is None:
        sizes = sizes.withColumn("__weight", F.pow(F.col("__size").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col(source).alias("__given")).agg(F.sum("weight").cast("double").alias("__weight"))
        sizes = sizes.join(given, F.col("__source").eqNullSafe(F.col("__given")), "left").drop("__given").fillna(0.0, ["__weight"])
    total, weights_sum = sizes.agg(F.sum("__size").cast("double"), F.sum("__weight")).first()  # one row
    if not weights_sum:
        return sizes.select("__source", F.lit(0.0).alias("rate"))
    rate = F.col("__weight") / F.lit(weights_sum) * epochs * F.lit(total) / F.col("__size")
    return sizes.select("__source", rate.alias("rate"))


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: int = 42,
    text: str = "text", source: str = "source", row_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with every row repeated copies times, plus rate, copy (from 0) and shuffle_key.

    Rows are dealt to partitions by a hash of shuffle_key and text and sorted by shuffle_key inside.  A row with NULL text
    has size 1 and is drawn like any other; rows with one id are repeated equally often, rows without an id go by their
    text instead.  Very long texts count with all their bytes.  An empty table gives no rows.  Columns of ``docs`` named
    like an output are replaced.
    """
    rates = staged(source_rates(docs, weights, temperature, epochs, text, source), "mix-rates")
    name = F.coalesce(F.col(row_id).cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    copies = (
        docs.drop("rate", "copy", "shuffle_key")
        .join(rates, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
        .withColumn("__copies", poisson_count(F.col("rate"), seed, name))
        .filter(F.col("__copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
        .withColumn("shuffle_key", hash60(F.concat_ws("|", F.lit(f"order{seed}"), name, F.col("copy").cast("string"))))
        .drop("__copies")
    )
    return copies.repartition("shuffle_key", F.xxhash64(text)).sortWithinPartitions("shuffle_key", row_id, "copy")
