"""Operators on inputs of some size: recall against all pairs, and mixes of very uneven sources."""

import numpy as np
from pyspark.sql import functions as F

from weighlens.llm import binary_codes, poisson_mix


def test_recall_of_links_among_ten_thousand_vectors(spark, rows):
    random_ = np.random.default_rng(21)
    base = random_.standard_normal((2_500, 64))
    near = base[random_.integers(0, 2_500, 5_000)]
    near = near + random_.uniform(0.2, 0.5, (5_000, 1)) * random_.standard_normal((5_000, 64))
    x = np.concatenate([base, near, random_.standard_normal((2_500, 64))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    wanted = (cosine >= 0.9).sum(1)
    assert wanted.sum() > 5_000
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = np.zeros(len(x), int)
    for r in binary_codes.link_vectors(data).collect():
        found[r["vec_id"]] = r["n_links"]
    assert (found <= wanted).all()  # no link below the threshold
    assert found.sum() >= 0.999 * wanted.sum()


def test_uneven_sources_reach_their_shares(spark):
    """One source holds nearly all rows; the mix has the target shares of bytes."""
    docs = spark.range(60_000).selectExpr(
        "id as doc_id", "case when id % 100 = 0 then 'rare' when id % 100 < 4 then 'some' else 'hot' end as source", "repeat('x', cast(pmod(hash(id), 50) as int)) as text")
    weights = spark.createDataFrame([("rare", 1.0), ("some", 1.0), ("hot", 2.0)], "source string, weight double")
    out = poisson_mix.mix_sources(docs, weights)
    sums = out.groupBy("source").agg(F.sum(F.length("text") + 1).alias("n")).collect()
    size = {r["source"]: r["n"] for r in sums}
    share = {k: v / sum(size.values()) for k, v in size.items()}
    assert abs(share["rare"] - 0.25) < 0.02 and abs(share["some"] - 0.25) < 0.02 and abs(share["hot"] - 0.5) < 0.02
    again = {(r["doc_id"], r["copy"]) for r in poisson_mix.mix_sources(docs.repartition(7), weights).select("doc_id", "copy").collect()}
    assert again == {(r["doc_id"], r["copy"]) for r in out.select("doc_id", "copy").collect()}
