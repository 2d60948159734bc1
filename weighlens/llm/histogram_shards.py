"""Sharding by histogram sort: shards of near equal bytes from exact counts, rows moved once.

The sort key of a row is (hash of the text, hash of the row id), so copies of a text stand side by side.
The cut after j/n of all bytes is found without sorting: every round counts the exact bytes in 4,096 cells
of the key range around each open cut (partial sums per task, a few thousand sums to the driver) and goes on
inside the one cell that holds the cut, until that cell holds a single text.  A cut at the edge of that text's
copies is taken if it meets the tolerance; otherwise the probes go on among the row ids of this text.
Then the rows are exchanged once, by (shard, cell of the key range), and numbered in their cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weighlens.llm.common import HASH_BITS, hash60, staged, utf8_size

PROBE_BITS = 12  # 4,096 probes per round and open cut


@dataclass
class _Cut:
    goal: int  # (bytes below the cut) * shards
    prefix: int = 0
    below: int = 0  # exact bytes of all keys below the prefix
    inside: int = 0  # exact bytes of the cell
    alone: int | None = None  # the only key of the cell


def _refine(keys: DataFrame, key: str, cuts: list[_Cut], shards: int) -> None:
    """Narrow every cut to a cell with one key; all cuts of a call have the same number of bits."""
    bits = 0
    while still := [c for c in cuts if c.alone is None]:
        step = min(PROBE_BITS, HASH_BITS - bits)
        prefixes = sorted({c.prefix for c in still})
        cells = (
            keys.filter(F.shiftright(key, HASH_BITS - bits).isin(prefixes) if bits else F.lit(True))
            .groupBy(F.shiftright(key, HASH_BITS - bits - step).alias("cell"))
            .agg(F.sum("__size").alias("size"), F.min(key).alias("low"), F.max(key).alias("high"))
            .orderBy("cell")
            .collect()  # at most 4,096 sums per open cut
        )
        for c in still:
            below = c.below
            for cell in (x for x in cells if x["cell"] >> step == c.prefix):
                if (below + cell["size"]) * shards > c.goal:
                    c.prefix, c.below, c.inside = cell["cell"], below, cell["size"]
                    c.alone = cell["low"] if cell["low"] == cell["high"] else None
                    break
                below += cell["size"]
        bits += step


def _edge(c: _Cut, shards: int) -> tuple[int, int]:
    """(first key behind the cut, distance to the goal) of the nearer edge of the cell; ties go before it."""
    before, after = c.goal - c.below * shards, (c.below + c.inside) * shards - c.goal
    return (c.alone, before) if before <= after else (c.alone + 1, after)


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """First (text key, row key) of shards 1, 2, ...; ``keys`` has __key, __row_key and __size."""
    total = keys.agg(F.sum("__size")).first()[0] or 0
    if not total:
        return []
    cuts = [_Cut(total * j) for j in range(1, shards)]
    _refine(keys, "__key", cuts, shards)
    found: list[tuple[int, int] | None] = []
    within: dict[int, list[tuple[int, _Cut]]] = {}
    for j, c in enumerate(cuts):
        key, off = _edge(c, shards)
        if off <= tolerance * total:
            found.append((key, 0))
        else:
            found.append(None)
            within.setdefault(c.alone, []).append((j, _Cut(c.goal, below=c.below)))
    for text_key, inner in within.items():  # at most one loop per cut
        _refine(keys.filter(F.col("__key") == text_key), "__row_key", [c for _, c in inner], shards)
        for j, c in inner:
            found[j] = (text_key, _edge(c, shards)[0])
    return sorted(found)


def _shard(cuts: list[tuple[int, int]]) -> Column:
    at_or_above = [
        ((F.col("__key") > a) | ((F.col("__key") == a) & (F.col("__row_key") >= b))).cast("int") for a, b in cuts
    ]
    return sum(at_or_above, F.lit(0))


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, text: str = "text", row_id: str = "doc_id", tolerance: float = 0.02,
    cell_bytes: int = 32 << 20,
) -> DataFrame:
    """All rows of ``docs`` with size, text_crc32, shard (0 to shards - 1) and slot (gapless from 0 in a shard).

    size is the UTF-8 bytes of the text plus 1.  Shards differ by at most ``tolerance`` of a shard on each side
    where that keeps the copies of a text together, and by one row where it does not.  Slots follow
    (text key, row key, row id).

    NULL and empty texts are one group of size 1 each; NULL row ids are one row key.  Rows that agree in text and id
    keep together.  An empty table gives no rows; fewer rows than shards leave shards empty.  Columns of ``docs``
    named like an output are replaced, all others are kept.
    """
    keyed = docs.withColumns({
        "size": utf8_size(F.col(text)) + 1,
        "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
        "__key": hash60(F.coalesce(F.col(text), F.lit(""))),
        "__row_key": hash60(F.coalesce(F.col(row_id).cast("string"), F.lit("null"))),
    })
    keys = staged(keyed.select("__key", "__row_key", F.col("size").alias("__size")), "shard-keys")
    cuts = splitters(keys, shards, tolerance)

    rows, total = keys.agg(F.count(F.lit(1)), F.sum("__size")).first()
    bits = min(20, max(PROBE_BITS, math.ceil(math.log2(max(1, (total or 0) / cell_bytes)))))
    cell = F.shiftright("__key", HASH_BITS - bits)
    counted = keys.groupBy(cell.alias("cell")).count()
    hot = [r["cell"] for r in counted.filter(F.col("count") > 1000 + 4 * (rows >> bits)).select("cell").collect()]
    # a hot cell holds over 1,000 rows and 4 times its share, so there are under 2**bits / 4 of them
    place = F.struct(
        _shard(cuts).alias("shard"), cell.alias("cell"),
        F.when(cell.isin(hot) if hot else F.lit(False), F.shiftright("__row_key", HASH_BITS - 8)).otherwise(0).alias("part"),
    )
    sizes = keys.groupBy(place.alias("__place")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("__place.shard").orderBy("__place.cell", "__place.part").rowsBetween(W.unboundedPreceding, -1)
    starts = staged(
        sizes.select("__place", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "shard-cells"
    )
    within = W.partitionBy("__place").orderBy("__key", "__row_key", row_id, "size")
    return (
        keyed.withColumn("__place", place).join(starts, "__place")
        .withColumn("slot", (F.row_number().over(within) - 1 + F.col("__start")).cast("bigint"))
        .withColumn("shard", F.col("__place.shard"))
        .drop("__place", "__start", "__key", "__row_key")
    )
