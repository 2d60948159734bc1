"""Quality by hierarchical empirical Bayes: a document classifier, corrected by what its host and path are like.

A logistic classifier over surface features gives each document's evidence.  Sums of its probabilities per host and per
path are shrunk level by level: a path towards its host, a host towards all documents, by prior weights estimated from
the variance between groups (method of moments).  A sparse path thus says little, a large one much.  The posterior is
the classifier's evidence with the path's rate as prior, the document itself left out of that rate.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weighlens.llm.common import hash60, staged

TRAIN_ROWS = 20_000  # at most so many labelled rows fit the classifier, those with the lowest hashes of their ids

_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 5
_CLASS[ord("!")] = 6
_CLASS[ord("|")] = 7


def features(texts: list[str | None]) -> np.ndarray:
    """Surface features of whole texts, one row each; NULL counts as empty."""
    out = np.zeros((len(texts), 12))
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        size = max(1, len(raw))
        kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)
        words = (text or "").split()
        lines = [x for x in (text or "").split("\n") if x]
        out[i] = (
            np.log1p(len(raw)), np.log1p(len(words)), kinds[0] / size, kinds[2] / size, kinds[3] / size, kinds[5] / size, kinds[6] / size,
            kinds[7] / size, len(raw) / max(1, len(words)), len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)),
            min(1.5, len(zlib.compress(raw, 1)) / size),
        )
    return out


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float  # share of good rows it was fitted on

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.weights, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Classifier:
    """Ridge logistic regression by Newton steps; without rows of both kinds every text gets the share of good rows."""
    base = float((y.sum() + 1) / (len(y) + 2))
    model = Classifier(x.mean(0) if len(x) else np.zeros(12), x.std(0) + 1e-9 if len(x) else np.ones(12), np.zeros(25), base)
    model.weights[0] = np.log(base / (1 - base))
    if 0 < y.sum() < len(y):
        d = model._design(x)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(d @ model.weights, -30, 30)))
            gradient = d.T @ (y - p) - ridge * model.weights * (np.arange(25) > 0)
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(25), gradient)
            model.weights = model.weights + step
            if np.abs(step).max() < 1e-6:
                break
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Classifier:
    """Classifier from at most ``rows`` labelled documents, one row of each id; only their features reach the driver."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("__good"))
        .withColumn("__order", hash60(F.col("doc_id").cast("string"))).orderBy("__order", "doc_id").limit(rows)
        .select(F.col("doc_id").alias("__known"), "__good")
    )
    sample = docs.join(F.broadcast(staged(known, "quality-labels")), F.col("doc_id") == F.col("__known"))
    text = F.min(F.struct(F.xxhash64("text"), "text"))["text"]  # of rows with one id, that with the least hash
    sample = sample.groupBy("__known", "__good").agg(text.alias("text")).select("__good", "text")

    def extract(batches):
        for batch in batches:
            x = features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.float64()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    found = sample.mapInArrow(extract, "y double, x array<double>").toPandas().sort_values(["y"], kind="stable")
    x = np.array(found["x"].tolist(), float).reshape(-1, 12)
    order = np.lexsort(x.T)
    return fit(x[order], found["y"].to_numpy()[order])


def with_evidence(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with the classifier's probability __p of every whole text."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(features(texts.tolist())))

    return docs.withColumn("__p", score(F.col(text)))


def _prior_weight(groups: DataFrame, mean: Column) -> float:
    """How many documents the prior of a level weighs: rate * (1 - rate) / variance between its groups - 1.

    ``groups`` has __n, __s and __q (documents, sum and sum of squares of their probabilities).
    """
    g = groups.withColumn("m", mean).agg(
        F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("__s").alias("s"), F.sum(F.col("__q") - F.col("__s") ** 2 / F.col("__n")).alias("within"),
        F.sum(F.col("__n") * (F.col("__s") / F.col("__n") - F.col("m")) ** 2).alias("between"), F.sum(F.col("__n") ** 2).alias("nn"),
    ).first()
    if not g["n"] or g["n"] <= g["k"] or g["k"] < 2:
        return 1e6
    rate = min(max(g["s"] / g["n"], 1e-6), 1 - 1e-6)
    noise = g["within"] / (g["n"] - g["k"])
    spread = (g["between"] - (g["k"] - 1) * noise) / max(1.0, g["n"] - g["nn"] / g["n"])
    return float(min(1e6, max(1.0, rate * (1 - rate) / spread - 1))) if spread > 0 else 1e6


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def add_quality(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality", rows: int = TRAIN_ROWS,
    threshold: float = 0.5, carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with evidence (the classifier's probability), host_rate, path_rate, quality (posterior) and keep.

    ``docs`` has doc_id, text and the columns ``host`` and ``path``.  A group's rate leaves the document itself out.
    NULL hosts and paths are groups of their own.  NULL texts are empty texts, very long ones are read whole, repeated rows
    count as often as they occur; of rows that share an id only one is learned from.  Without labels the evidence is 1/2
    for all; an empty table gives no rows.  Columns named like an output are replaced.  ``carry`` names the columns to
    return (default: all): texts are read once, and the evidence is written beside these columns.
    """
    model = train(docs, labels, label, rows)
    docs = docs.drop("evidence", "host_rate", "path_rate", "quality", "keep")
    carry = [c for c in docs.columns if carry is None or c in carry]
    scored = with_evidence(docs, model).select(*carry, F.col(host).alias("__host"), F.col(path).alias("__path"), "__p")
    scored = staged(scored, "quality-evidence")
    site = ["__host", "__path"]
    sums = (F.count(F.lit(1)).alias("__n"), F.sum("__p").alias("__s"), F.sum(F.col("__p") ** 2).alias("__q"))
    paths = staged(scored.groupBy(*site).agg(*sums), "quality-paths")
    merged = (F.sum("__n").alias("__n"), F.sum("__s").alias("__s"), F.sum("__q").alias("__q"))
    hosts = staged(paths.groupBy("__host").agg(*merged), "quality-hosts")
    whole = hosts.agg(F.sum("__n").alias("n"), F.sum("__s").alias("s")).first()
    n, s = whole["n"] or 0, whole["s"] or 0.0
    rate = s / n if n else 0.5
    of_host = _prior_weight(hosts, F.lit(rate))
    host_sums = hosts.select(F.col("__host").alias("__of"), F.col("__n").alias("__hn"), F.col("__s").alias("__hs"))
    both = staged(paths.join(host_sums, F.col("__host").eqNullSafe(F.col("__of"))).drop("__of"), "quality-sites")
    of_path = _prior_weight(both, F.col("__hs") / F.col("__hn"))

    host_rate = (of_host * F.lit(rate) + F.col("__hs") - F.col("__p")) / (of_host + F.col("__hn") - 1)
    path_rate = (of_path * F.col("host_rate") + F.col("__s") - F.col("__p")) / (of_path + F.col("__n") - 1)
    odds = _logit(F.col("__p")) - float(np.log(model.base / (1 - model.base))) + _logit(F.col("path_rate"))
    both = both.withColumnsRenamed({"__host": "__at", "__path": "__in"})
    on_site = F.col("__host").eqNullSafe(F.col("__at")) & F.col("__path").eqNullSafe(F.col("__in"))
    return (
        scored.join(both, on_site).withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
        .withColumns({"evidence": F.col("__p"), "quality": 1 / (1 + F.exp(-odds))}).withColumn("keep", F.col("quality") >= threshold)
        .drop("__host", "__path", "__at", "__in", "__n", "__s", "__q", "__hn", "__hs", "__p")
    )
