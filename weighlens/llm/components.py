"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has a link; component is the smallest id reachable.

    Each round every id takes the smallest label among its neighbours' and its own, then the label of that label, so
    that chains halve.  Labels are written after each round, and the rounds end when none has changed.
    """
    both = links.select(F.col(a).alias("id"), F.col(b).alias("other")).union(links.select(F.col(b), F.col(a)))
    both = staged(both.filter("id is not null and other is not null and id != other").distinct(), "links")
    labels = staged(both.groupBy("id").agg(F.min("other").alias("low")).select("id", F.least("id", "low").alias("component")), "labels")
    while True:
        theirs = labels.select(F.col("id").alias("other"), F.col("component").alias("near"))
        near = both.join(theirs, "other").groupBy("id").agg(F.min("near").alias("near"))
        step = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("next"))
        up = labels.select(F.col("id").alias("next"), F.col("component").alias("top"))
        moved = staged(step.join(up, "next").select("id", F.col("component").alias("was"), F.least("next", "top").alias("component")), "labels")
        labels = moved.select("id", "component")
        if moved.filter("was != component").isEmpty():
            return labels
