"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector o is rotated at random; its code is the signs of the rotated components, its correction factor
f = <x, o> with x the code scaled to unit length.  For another rotated vector q, <x, q> / f estimates <o, q> without bias,
with an error below WIDTH * sqrt((1 - f^2) / f^2 / (d - 1)) but for a tiny share of pairs.  The rotated vector is held in
8 bits per component, which adds a bound of its own.  A pair is worked out exactly, in double precision, if its bounds from
both sides reach the threshold; vectors without such a pair are not fetched.

Which pairs are looked at: the signs of further random projections, cut into bands, are bucket keys.  Vectors at the
threshold differ in a sign with probability arccos(threshold) / pi, so the number of bands follows from the wanted recall
at the threshold; above it recall is higher.  Equal vectors are one class.  Large buckets meet in blocks, and a pair counts
in the first band it shares, so nothing is listed pair by pair: a block gives each vector's number of links and a forest.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import staged
from weighlens.llm.components import components
from weighlens.llm.groups import binary_rows, forest, whole_groups

WIDTH = 4.0
BLOCK = 1024


@lru_cache(maxsize=8)
def rotation(d: int, seed: int = 1) -> np.ndarray:
    """Random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=8)
def projections(d: int, n: int, seed: int = 2) -> np.ndarray:
    return np.random.default_rng([seed, d]).standard_normal((d, n))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code bits, factors, components in 8 bits, their scale) of unit vectors."""
    turned = unit @ rotation(unit.shape[1])
    factor = np.abs(turned).sum(1) / math.sqrt(unit.shape[1])
    scale = np.abs(turned).max(1) / 127
    return turned > 0, factor, np.rint(turned / scale[:, None]).astype(np.int8), scale


def upper_bound(code, factor, small, scale, i, j) -> np.ndarray:
    """Upper bound of the cosine of i and j, from i's code and j's components."""
    d = code.shape[1]
    x = (code[i] * 2.0 - 1) / math.sqrt(d)
    estimate = (x * small[j]).sum(1) * scale[j] / factor[i]
    rounding = scale[j] / 2 * math.sqrt(d) / factor[i]
    return estimate + WIDTH * np.sqrt((1 - factor[i] ** 2).clip(0) / factor[i] ** 2 / max(1, d - 1)) + rounding


def likely_pairs(unit: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit vectors have bounds, from both sides, that reach the threshold: ``upper_bound`` of all of them."""
    d = unit.shape[1]
    code, factor, small, scale = encode(unit)
    estimate = (code * 2.0 - 1) @ (small * scale[:, None]).T / math.sqrt(d)
    width = WIDTH * np.sqrt((1 - factor ** 2).clip(0) / max(1, d - 1))
    bound = (estimate + scale / 2 * math.sqrt(d) + width[:, None]) / factor[:, None]
    return np.minimum(bound, bound.T) >= threshold - 1e-9  # rounding of the bound itself excludes nothing


def band_shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits per band, bands): buckets of a few unrelated vectors, and the wanted recall at the threshold."""
    bits = min(24, max(6, math.ceil(math.log2(max(n, 2))) - 2))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _prepare(bits: int, bands: int):
    """Classes to unit vectors' codes and bucket keys."""
    def run(batches):
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            size = np.array([len(x) for x in raw])
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                v = np.frombuffer(b"".join(raw[r] for r in rows), "<f8").reshape(len(rows), -1)
                unit = v / np.abs(v).max(1, keepdims=True)
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                code, factor, small, scale = encode(unit)
                signs = (unit @ projections(unit.shape[1], bits * bands) > 0).reshape(len(rows), bands, bits)
                keys = signs @ (1 << np.arange(bits, dtype=np.int64)) * 4096 + np.arange(bands) + (int(d) // 8 << 40)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[rows]), pa.array(keys.tolist(), pa.list_(pa.int64())),
                    pa.array([f.tobytes() + s.tobytes() + m.tobytes() + c.tobytes() for f, s, m, c in zip(factor, scale, small, np.packbits(code, axis=1))], pa.binary()),
                    pa.array([u.astype("<f8").tobytes() for u in unit], pa.binary()),
                ], names=["id", "keys", "code", "unit"])
    return run


def _likely(threshold: float):
    """Rows of buckets that have a partner whose bound reaches the threshold."""
    def run(batches):
        for table, begins in whole_groups(batches, ["key", "block", "other"]):
            raw = [np.frombuffer(x, np.uint8) for x in table.column("code").to_pylist()]
            ids, key = table.column("id").to_numpy(), table.column("key").to_numpy()
            hit = np.zeros(len(ids), bool)
            ends = np.repeat(np.append(begins[1:], len(ids)), np.diff(np.append(begins, len(ids))))
            width = np.array([len(x) for x in raw])
            for w in np.unique(width):  # a bucket holds one dimension
                rows = np.flatnonzero(width == w)
                m = np.stack([raw[r] for r in rows])
                d = (int(w) - 16) * 8 // 9  # d bytes and d bits
                factor, scale = np.ascontiguousarray(m[:, :16]).view("<f8").T
                small, code = m[:, 16:16 + d].view(np.int8), np.unpackbits(m[:, 16 + d:], axis=1, count=d).astype(bool)
                place = np.full(len(ids), -1)
                place[rows] = np.arange(len(rows))
                step, left = 1, rows
                while True:
                    left = left[left + step < ends[left]]
                    if not len(left):
                        break
                    for at in range(0, len(left), 1 << 16):
                        some = left[at:at + (1 << 16)]
                        i, j = place[some], place[some + step]
                        good = upper_bound(code, factor, small, scale, i, j) >= threshold
                        again = np.flatnonzero(good)
                        good[again] = upper_bound(code, factor, small, scale, j[again], i[again]) >= threshold
                        hit[some[good]] = hit[some[good] + step] = True
                    step += 1
            yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(ids[hit])], names=["key", "id"])
    return run


def _reaches(u: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the exactly rounded sum of products reaches the threshold: numpy's sum decides where its last bits cannot."""
    cosine = np.concatenate([(u[i[a:a + 65536]] * u[j[a:a + 65536]]).sum(1) for a in range(0, len(i), 65536)] or [np.zeros(0)])
    for n in np.flatnonzero(np.abs(cosine - threshold) < 1e-9):
        cosine[n] = math.fsum(u[i[n]] * u[j[n]])
    return cosine >= threshold


def _exact(threshold: float):
    """Per block of a bucket: links of each class and a forest of them.

    The bounds choose the pairs, each is worked out in the first band it shares, and in no other.
    """
    def run(batches):
        for table, begins in whole_groups(batches, ["key", "block", "other"]):
            ids, key, weight, side = (table.column(c).to_numpy() for c in ("id", "key", "weight", "side"))
            one_block = table.column("block").to_numpy() == table.column("other").to_numpy()
            units, keys = table.column("unit"), table.column("keys")
            out_id, out_n, out_to = [], [], []
            for b, e in zip(begins, np.append(begins[1:], len(ids))):
                if e - b < 2:
                    continue
                u = np.stack([np.frombuffer(x, "<f8") for x in units.slice(b, e - b).to_pylist()])
                k = np.array(keys.slice(b, e - b).to_pylist())
                near = np.triu(likely_pairs(u, threshold), 1)
                if not one_block[b]:
                    near &= side[b:e][:, None] != side[b:e][None, :]
                i, j = np.nonzero(near)
                band = int(key[b] % 4096)
                first = np.ones(len(i), bool)
                for at in range(0, len(i), 1 << 14):
                    x, y = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
                    first[at:at + (1 << 14)] = ~(k[x, :band] == k[y, :band]).any(1)
                i, j = i[first], j[first]
                keep = _reaches(u, i, j, threshold)
                i, j = i[keep], j[keep]
                if len(i):
                    w = weight[b:e]
                    links = np.bincount(i, w[j], e - b) + np.bincount(j, w[i], e - b)
                    some = np.flatnonzero(links)
                    out_id.append(ids[b:e][some]), out_n.append(links[some].astype(np.int64)), out_to.append(np.full(len(some), -1))
                    tree = forest(i, j, np.arange(e - b))
                    out_id.append(ids[b:e][i[tree]]), out_n.append(np.zeros(len(tree), np.int64)), out_to.append(ids[b:e][j[tree]])
            cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_id, out_n, out_to)]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["id", "n", "to"])
    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Buckets with several rows, in blocks of about BLOCK that each meet themselves and each other."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    rows = rows.join(sizes, "key").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({
        "block": F.least("own", "met"), "other": F.greatest("own", "met"), "side": (F.col("own") > F.col("met")).cast("int"),
    }).drop("m", "blocks", "own", "met")


def link_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    n_links counts the other rows with a cosine of at least ``threshold`` that were found; none is below it.  Vectors that
    are NULL, empty, zero or hold NULL or non-finite components link with nothing and are their own component, as do
    vectors of another length to each other.  Repeated rows are rows of their own.  A row with a NULL id links like any
    other and never names a component; without any other id there, its component is NULL and it is not kept.  An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    largest = F.array_max(F.transform(v, F.abs))
    sound = F.col(vector).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (largest > 0)
    rows = vectors.select(F.col(row_id).cast("bigint").alias("vec_id"), v.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.withColumn("name", F.when(F.col("sound"), F.sha2(F.array_join(F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("string")), ",").cast("binary"), 256)))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")

    classes = staged(rows.filter("sound").groupBy("name").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("weight")), "vector-classes")
    packed = rows.join(classes.select("id"), F.col("row") == F.col("id"), "left_semi").select(F.col("row").alias("id"), "v").mapInArrow(_pack, "id bigint, raw binary")
    bits, bands = band_shape(classes.count(), threshold, recall)
    coded = staged(packed.mapInArrow(_prepare(bits, bands), "id bigint, keys array<bigint>, code binary, unit binary"), "vector-codes")
    group = ["key", "block", "other"]
    buckets = _in_blocks(coded.select("id", F.explode("keys").alias("key"))).join(coded.select("id", "code"), "id")
    likely = buckets.repartition(*group).sortWithinPartitions(*group, "id").mapInArrow(_likely(threshold), "key bigint, id bigint")
    likely = staged(likely.distinct(), "vector-likely")
    meet = _in_blocks(likely).join(coded.select("id", "keys", "unit"), "id").join(classes.select("id", "weight"), "id")
    found = staged(meet.repartition(*group).sortWithinPartitions(*group, "id").mapInArrow(_exact(threshold), "id bigint, n bigint, to bigint"), "vector-links")

    comp = components(found.filter("to >= 0").select(F.col("id").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    of_class = (
        classes.join(links, "id", "left").join(comp, "id", "left")
        .select(F.col("name").alias("of"), "weight", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("component"))
    )
    placed = staged(rows.select("vec_id", "row", "name").join(of_class, F.col("name") == F.col("of"), "left").select(
        "vec_id", F.coalesce(F.col("n") + F.col("weight") - 1, F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component")), "vector-rows")
    names = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(names, "component").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def _pack(batches):
    """Arrays of doubles to their bytes."""
    for batch in batches:
        raw = [np.array(x, "<f8").tobytes() for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "raw"])
