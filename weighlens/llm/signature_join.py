"""N-gram Jaccard join with signature trees.

A document's set is its distinct 5-word shingles.  Documents with the same set are one class, stood for by its smallest
id.  Two sets of similarity s agree in a minimum hash with probability s; a bucket holds the classes that agree in one of
BANDS pairs of minimum hashes, so that a pair at 0.75 is missed with probability (1 - 0.75**2)**48 < 1e-17, less than the
chance that two of the 64-bit hashes collide.  Inside a bucket a signature tree finds the pairs: a leaf has a class's
bitmap of hashed shingles, a node the OR of its children's bitmaps and the range of their set sizes.  Two nodes are
descended into only if the largest overlap that their bitmaps and sizes allow can still reach the similarity, and only
while they are not known to be one component already.  The trees of many buckets are walked side by side.

Pairs are decided on the exact sets.  First each bucket gives a forest, its best pairs that join what is not joined yet,
so a bucket of thousands of near copies gives thousands of pairs, not millions; then, for classes that are still apart,
all pairs that the trees cannot exclude.  Large buckets are met in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import staged
from weighlens.llm.components import components
from weighlens.llm.groups import binary_rows, forest, whole_groups
from weighlens.llm.words import mixed, ngram_hashes, text_ngrams, word_hashes

SHINGLE = 5
PERCENT = 75
BANDS = 48
BITS = 2048
BLOCK = 1024  # classes of a bucket that meet in one tree
LEAF, FAN = 8, 8
PAIRS = 1 << 22  # of classes whose trees are walked side by side
SMALL = 4  # buckets of so many classes give all their possible pairs, larger ones a forest first
_ID_BITS = 52
_MASK = np.uint64((1 << _ID_BITS) - 1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(sorted 52-bit shingle ids of all texts one after the other, set size per text); for at most 4,096 texts."""
    words, counts = word_hashes(texts)
    grams, text, _ = text_ngrams(words, counts, SHINGLE)
    all_grams, all_text = [grams], [text]
    starts = np.cumsum(counts) - counts
    for size in range(1, SHINGLE):  # fewer words: the whole sequence
        short = np.flatnonzero(counts == size)
        if len(short):
            inner = words[(starts[short][:, None] + np.arange(size)).reshape(-1)]
            all_grams.append(ngram_hashes(inner, size)[::size])
            all_text.append(short)
    keys = np.concatenate(all_text).astype(np.uint64) << np.uint64(_ID_BITS) | np.concatenate(all_grams) & _MASK
    keys = np.sort(keys)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return keys & _MASK, np.bincount((keys >> np.uint64(_ID_BITS)).astype(np.int64), minlength=len(counts))


def _odd(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sketches(batches):
    """Per row: set size, two sums that name the set, bucket keys, bitmap."""
    odd, shift = _odd(2 * BANDS), _odd(4 * BANDS)[2 * BANDS:]
    for whole in batches:
        for at in range(0, whole.num_rows, 1500):
            batch = whole.slice(at, 1500)
            ids, sizes = shingle_sets(batch.column(1))
            some = np.flatnonzero(sizes)
            n = len(sizes)
            name = np.zeros((2, n), np.uint64)
            bands = np.zeros((n, BANDS), np.uint64)
            bits = np.zeros((n, BITS), bool)
            if len(some):
                begins = (np.cumsum(sizes) - sizes)[some]
                name[0, some] = np.add.reduceat(mixed(ids), begins)
                name[1, some] = np.add.reduceat(mixed(ids ^ np.uint64(0x5851F42D4C957F2D)), begins)
                for k in range(BANDS):
                    low = [np.minimum.reduceat((ids ^ shift[j]) * odd[j], begins) for j in (2 * k, 2 * k + 1)]
                    bands[some, k] = mixed(low[0] + mixed(low[1] + np.uint64(k)))
                bits[np.repeat(np.arange(n), sizes), (ids % np.uint64(BITS)).astype(np.int64)] = True
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(sizes.astype(np.int64)), pa.array(name[0].view(np.int64)), pa.array(name[1].view(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array(bands[some].reshape(-1).view(np.int64))),
                pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary()),
            ], names=["doc_id", "twin", "n", "name", "more", "bands", "bits"])


class _Classes:
    """Classes of a group: ids, sizes, components and bitmaps."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: np.ndarray):
        self.n, self.comp, self.bits = n, comp, bits
        self.ones = np.bitwise_count(bits).sum(1, dtype=np.int64)

    def reach(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Largest overlap the bitmaps of classes i and j allow: shingles whose bit the other lacks are not shared."""
        common = np.bitwise_count(self.bits[i] & self.bits[j]).sum(1, dtype=np.int64)
        return np.minimum(self.n[i] - self.ones[i], self.n[j] - self.ones[j]) + common

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether i and j lie in two components and may reach the similarity."""
        out = self.comp[i] != self.comp[j]
        total = self.n[i] + self.n[j]
        out &= np.minimum(self.n[i], self.n[j]) * (100 + PERCENT) >= PERCENT * total
        at = np.flatnonzero(out)
        reach = np.minimum(self.reach(i[at], j[at]), np.minimum(self.n[i[at]], self.n[j[at]]))
        out[at] = reach * (100 + PERCENT) >= PERCENT * total[at]
        return out


def tree_pairs(c: _Classes, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes of one group that may be similar, by dual traversal of the groups' signature trees, side by side.

    ``begins`` says where each group begins in ``c`` (default: one group); every group has a tree of its own, a small one a
    single leaf.
    """
    begins = np.zeros(1, np.int64) if begins is None else begins
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(c.n))))
    order = np.lexsort((c.comp, c.n, group))
    # levels[0] are the classes in order; a node of the next level joins LEAF, then FAN neighbours of its group
    levels = [(c.bits[order], c.n[order], c.n[order], (c.n - c.ones)[order], c.comp[order], np.ones(len(order), bool))]
    kids: list[tuple[np.ndarray, np.ndarray]] = []  # per level but the first: where a node's children begin, and how many
    while not kids or len(group) > len(begins):
        bits, low, high, spare, comp, one = levels[-1]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        first = np.flatnonzero(place % (FAN if kids else LEAF) == 0)
        kids.append((first, np.diff(np.append(first, len(group)))))
        same = np.minimum.reduceat(comp, first) == np.maximum.reduceat(comp, first)
        levels.append((
            np.bitwise_or.reduceat(bits, first, axis=0), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first),
            np.maximum.reduceat(spare, first), comp[first], same & np.logical_and.reduceat(one, first),
        ))
        group = group[first]
    i = j = np.arange(len(begins))  # the roots
    for depth in range(len(levels) - 2, -1, -1):
        first, many = kids[depth]
        pairs = many[i] * many[j]
        nth = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        fan = np.repeat(many[j], pairs)
        a, b = np.repeat(first[i], pairs) + nth // fan, np.repeat(first[j], pairs) + nth % fan
        keep = a <= b if depth else a < b
        a, b = a[keep], b[keep]
        bits, low, high, spare, comp, one = levels[depth]
        keep = ~(one[a] & one[b] & (comp[a] == comp[b]))
        keep &= (high[a] * 100 >= PERCENT * low[b]) & (high[b] * 100 >= PERCENT * low[a])
        a, b = a[keep], b[keep]
        if depth and len(a):
            reach = np.concatenate([
                np.bitwise_count(bits[a[x:x + 65536]] & bits[b[x:x + 65536]]).sum(1, dtype=np.int64) for x in range(0, len(a), 65536)
            ]) + np.minimum(spare[a], spare[b])
            keep = reach * (100 + PERCENT) >= PERCENT * (low[a] + low[b])
            a, b = a[keep], b[keep]
        i, j = a, b
    i, j = order[i], order[j]
    parts = [x + np.flatnonzero(c.possible(i[x:x + 65536], j[x:x + 65536])) for x in range(0, len(i), 65536)]
    keep = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return i[keep], j[keep]


def _shares(begins: np.ndarray, total: int) -> list[slice]:
    """Neighbouring groups to be taken together: up to PAIRS pairs of rows, or one group."""
    sizes = np.diff(np.append(begins, total))
    share = (np.cumsum(sizes * sizes) - 1) // PAIRS
    cuts = np.append(np.flatnonzero(np.append(True, share[1:] != share[:-1])), len(begins))
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]


def _candidates(all_pairs: bool):
    """Pairs (a, b) of sorted groups: a forest of each larger group, or all that are possible."""
    def run(batches):
        for table, begins in whole_groups(batches, ["key", "block", "other"]):
            doc, n, comp, side = (table.column(x).to_numpy() for x in ("cls", "n", "component", "side"))
            bits = binary_rows(table.column("bits"), np.uint64)
            one_block = table.column("block").to_numpy() == table.column("other").to_numpy()
            ends = np.append(begins[1:], len(doc))
            found = []
            for share in _shares(begins, len(doc)):
                rows = slice(begins[share][0], ends[share][-1])
                at, c = begins[share] - rows.start, _Classes(n[rows], comp[rows], bits[rows])
                i, j = tree_pairs(c, at)
                keep = one_block[rows][i] | (side[rows][i] != side[rows][j])
                i, j = i[keep], j[keep]
                if not all_pairs and len(i):
                    sizes = ends[share] - begins[share]
                    group = np.repeat(np.arange(len(at)), sizes)
                    large = sizes[group[i]] > SMALL
                    x, y = i[large], j[large]
                    likely = c.reach(x, y) / np.maximum(1, c.n[x] + c.n[y])
                    best = np.lexsort((doc[rows][y], doc[rows][x], -likely, group[x]))
                    x, y = x[best], y[best]
                    known, rank = np.unique(c.comp, return_inverse=True)
                    some = forest(x, y, group * len(known) + rank)  # components of one group, not of the buckets beside it
                    i, j = np.concatenate([i[~large], x[some]]), np.concatenate([j[~large], y[some]])
                found.append((rows.start + i, rows.start + j))
            i, j = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[i], doc[j])), pa.array(np.maximum(doc[i], doc[j]))], names=["a", "b"])
    return run


def _pairs(buckets: DataFrame, bitmaps: DataFrame, known: DataFrame, all_pairs: bool) -> DataFrame:
    """Distinct candidate pairs.  ``buckets`` has key, cls and the bucket's number of classes m; ``known`` components."""
    rows = buckets.join(known, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed_keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("key")
    rows = rows.join(mixed_keys, "key", "left_semi")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cls", "key"), F.col("blocks")).cast("int"))
    if all_pairs:  # a row meets its own block and each other one
        rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumns({"block": F.least("own", "met"), "other": F.greatest("own", "met"), "side": (F.col("own") > F.col("met")).cast("int")})
    else:
        rows = rows.withColumns({"block": F.col("own"), "other": F.col("own"), "side": F.lit(0)})
    rows = rows.select("key", "block", "other", "side", "cls", "component").join(bitmaps, "cls")
    rows = rows.repartition("key", "block", "other").sortWithinPartitions("key", "block", "other", "cls")
    return rows.mapInArrow(_candidates(all_pairs), "a bigint, b bigint").distinct()


def _sets(docs: DataFrame, heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, ids) of the wanted classes: their exact sets, from the text of the row that stands for each."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1500):
                batch = whole.slice(at, 1500)
                ids, sizes = shingle_sets(batch.column(1))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int64)))], names=["cls", "ids"])

    return docs.join(heads.join(wanted, "cls", "left_semi"), ["doc_id", "twin"]).select("cls", "text").mapInArrow(run, "cls bigint, ids array<bigint>")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact sets reach the similarity."""
    left = sets.select(F.col("cls").alias("a"), F.col("ids").alias("a_ids"))
    right = sets.select(F.col("cls").alias("b"), F.col("ids").alias("b_ids"))
    both = F.size(F.array_intersect("a_ids", "b_ids"))
    return (
        pairs.join(left, "a").join(right, "b")
        .filter(100 * both >= PERCENT * (F.size("a_ids") + F.size("b_ids") - both)).select("a", "b")
    )


def near_copy_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, twin, n, group) of every row: rows of one group are linked through similar texts.

    twin is a hash of the text and tells rows of one id apart.  Rows without words and rows with a NULL id have no group.
    Classes, buckets and pairs go by the number of a class, never by a document's id, so that ids that repeat with
    different texts neither join nor hide classes.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("twin"))
    sketches = staged(docs.mapInArrow(_sketches, "doc_id bigint, twin bigint, n bigint, name bigint, more bigint, bands array<bigint>, bits binary"), "sketches")
    linkable = sketches.filter("n > 0 and doc_id is not null")
    named = ["n", "name", "more"]
    classes = linkable.groupBy(*named).agg(F.min(F.struct("doc_id", "twin")).alias("head"))
    classes = staged(classes.select(*named, "head.*", F.monotonically_increasing_id().alias("cls")), "classes")
    heads = linkable.join(classes, [*named, "doc_id", "twin"])
    keys = heads.select("cls", F.explode("bands").alias("key")).distinct()
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    buckets = staged(keys.join(shared, "key"), "buckets")
    bitmaps = heads.select("cls", "n", "bits").join(buckets.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])  # repeated rows
    bitmaps = staged(bitmaps, "bitmaps")

    nothing = docs.sparkSession.createDataFrame([], "cls bigint, component bigint")
    first = staged(_pairs(buckets, bitmaps, nothing, all_pairs=False), "first-pairs")
    ends = lambda p: p.select(F.col("a").alias("cls")).union(p.select("b")).distinct()
    texts_of = classes.select("cls", "doc_id", "twin")
    sets = staged(_sets(docs, texts_of, ends(first)), "sets")
    links = staged(_similar(first, sets), "first-links")
    known = components(links).select(F.col("id").alias("cls"), "component")
    apart = _pairs(buckets, bitmaps, known, all_pairs=True).join(first, ["a", "b"], "left_anti")
    apart = staged(apart, "apart-pairs")
    new = staged(ends(apart).join(sets.select("cls"), "cls", "left_anti"), "apart-classes")
    if not apart.isEmpty():
        if not new.isEmpty():
            sets = sets.union(staged(_sets(docs, texts_of, new), "more-sets"))
        links = links.union(staged(_similar(apart, sets), "apart-links"))
        known = components(links).select(F.col("id").alias("cls"), "component")

    groups = classes.join(known, "cls", "left").select(*named, F.coalesce("component", "cls").alias("group"))
    rows = sketches.select("doc_id", "twin", *named).join(groups, named, "left")
    return rows.select("doc_id", "twin", "n", F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("group"))


def join_near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id and text; other columns are not read).

    A text without words (NULL, empty or white space) has an empty set and links with nothing.  Rows with a NULL id link
    with nothing and have no component.  Repeated rows are rows of one class; rows that share an id but not the text
    link through that id.  An empty table gives no rows.
    """
    rows = staged(near_copy_groups(docs), "near-copies")
    in_group = rows.filter("group is not null")
    lows = staged(in_group.groupBy("group").agg(F.min("doc_id").alias("low")), "group-lows")
    # ids in several groups, which only ids that repeat can be, join these
    several = in_group.groupBy("doc_id").agg(F.min("group").alias("x"), F.max("group").alias("y")).filter("x != y").select("doc_id")
    links = staged(in_group.join(several, "doc_id", "left_semi").join(lows, "group").select("low", "doc_id"), "id-links")
    if not links.isEmpty():
        joined = components(links, "low", "doc_id").select(F.col("id").alias("low"), "component")
        lows = lows.join(joined, "low", "left").select("group", F.coalesce("component", "low").alias("low"))
    return rows.join(lows, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the smallest id (then text hash); all its columns.

    Only texts make groups: unrelated texts that share an id both stay.  Of repeated rows one stays; rows without words and
    rows with a NULL id all stay.
    """
    groups = near_copy_groups(docs).filter("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "twin")).alias("head"))
    heads = staged(groups.select(F.col("head.doc_id").alias("__id"), F.col("head.twin").alias("__of")), "heads")
    worded = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(worded).withColumn("__twin", F.xxhash64("text"))
    kept = keyed.join(heads, (F.col("doc_id") == F.col("__id")) & (F.col("__twin") == F.col("__of")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__twin"]).select(docs.columns).union(docs.filter(~worded))
