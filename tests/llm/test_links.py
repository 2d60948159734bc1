"""Near-duplicate operators against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from weighlens.llm import binary_codes, signature_join
from weighlens.llm.common import table
from weighlens.llm.components import components


def _components(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def _expected(texts):
    sets = [_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, _components(len(sets), links)))}


def _family(seed, size, words, edits):
    r = random.Random(seed)
    base = [f"w{r.randrange(10 ** 9)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"x{r.randrange(10 ** 9)}"
        out.append(" ".join(w))
    return out


def _found(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in signature_join.join_near_copies(docs).collect()}


def test_join_finds_every_link(rows):
    passage = " ".join(f"p{i}" for i in range(60))
    r = random.Random(5)
    texts = [None, "", " \t\n", "one", "ONE", "one two three four", "One Two\x0bThree four", "one two three fourth", "a b c d e", "a b c d e f", "É b c d e", "é b c d e"]
    texts += _family(1, 40, 120, 4) + _family(2, 30, 60, 8) + _family(3, 3, 20_000, 3)
    texts += [passage + " " + " ".join(f"q{r.randrange(10 ** 9)}" for _ in range(60)) for _ in range(40)]  # share a passage, no link
    texts += ["the " * 300, "the the " * 700, "x y z v w " * 50, "y z v w x " * 50]
    texts += texts[20:24]
    docs = rows([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, n int").repartition(5)
    assert _found(docs) == _expected(texts)


def test_large_buckets_meet_in_blocks(rows, monkeypatch):
    monkeypatch.setattr(signature_join, "BLOCK", 8)
    texts = _family(7, 60, 80, 3) + _family(8, 60, 80, 12)
    assert _found(rows(list(enumerate(texts)), "doc_id bigint, text string")) == _expected(texts)


def test_join_of_the_given_documents(spark):
    docs = table(spark, SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(texts) == list(range(len(texts)))
    assert _found(docs) == _expected([texts[i] for i in range(len(texts))])


def test_repeated_rows_null_ids_and_no_rows(rows):
    long = " ".join(map(str, range(30)))
    data = [(4, long), (4, long), (2, long + " end"), (None, long), (None, None), (9, None)]
    found = signature_join.join_near_copies(rows(data, "doc_id bigint, text string")).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, signature_join.join_near_copies(rows(data[::-1], "doc_id bigint, text string")).collect()))
    assert sorted((r["doc_id"], r["component_id"]) for r in found if r["doc_id"] is not None) == [(2, 2), (4, 2), (4, 2), (9, 9)]
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None, None]
    assert signature_join.join_near_copies(rows([], "doc_id bigint, text string")).count() == 0


def test_tree_keeps_every_possible_pair():
    random_ = np.random.default_rng(3)
    bits = (random_.random((90, 32 * 64)) < random_.random((90, 1)) * 0.3)
    packed = np.packbits(bits, axis=1).view(np.uint64)
    n = bits.sum(1) + random_.integers(0, 30, 90)
    c = signature_join._Classes(n, random_.integers(0, 60, 90), packed)
    i, j = np.triu_indices(90, 1)
    expected = {(a, b) for a, b, ok in zip(i.tolist(), j.tolist(), c.possible(i, j)) if ok}
    assert {(min(a, b), max(a, b)) for a, b in zip(*map(list, signature_join.tree_pairs(c)))} == expected


def test_components_of_chains_and_stars(rows):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(20, 90)] + [(7, 7), (None, 3)]
    found = dict(components(rows(links, "a bigint, b bigint")).collect())
    assert found == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(20, 90)]}
    assert components(rows([], "a bigint, b bigint")).count() == 0


def _vectors():
    random_ = np.random.default_rng(11)
    base = random_.standard_normal((30, 24))
    near = np.concatenate([base[:6][random_.integers(0, 6, 60)] + 0.05 * k * random_.standard_normal((60, 24)) for k in range(1, 10)])
    return np.concatenate([base, near, base[:3] * 4.0, base[:2]])


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_link_as_all_pairs_say(rows, monkeypatch, block):
    monkeypatch.setattr(binary_codes, "BLOCK", block)
    x = _vectors()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    comp = _components(len(x), zip(*np.nonzero(linked)))
    odd = [(None, 24), ([], 24), ([0.0] * 24, 24), ([1.0] * 23 + [None], 24), ([1.0] * 23 + [float("nan")], 24), ([float("inf")] + [1.0] * 23, 24), ([2.0] * 7, 7), ([4.0] * 7, 7)]
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000 + k, v, 2) for k, (v, _) in enumerate(odd)]
    found = {r["vec_id"]: tuple(r)[1:] for r in binary_codes.link_vectors(rows(data, "vec_id bigint, embedding array<double>, n int")).collect()}
    expected = {i: (int(linked[i].sum()), comp[i], comp[i] == i) for i in range(len(x))}
    expected |= {1000 + k: (0, 1000 + k, True) for k in range(6)} | {1006: (1, 1006, True), 1007: (1, 1006, False)}
    assert found == expected


def test_estimates_are_unbiased_and_bounded():
    random_ = np.random.default_rng(2)
    x = random_.standard_normal((400, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    code, factor, small, scale = binary_codes.encode(unit)
    i, j = np.triu_indices(400, 1)
    true = (unit[i] * unit[j]).sum(1)
    bound = binary_codes.upper_bound(code, factor, small, scale, i, j)
    assert (bound >= true).mean() > 0.9999
    width = binary_codes.WIDTH * np.sqrt((1 - factor[i] ** 2) / factor[i] ** 2 / 63) + scale[j] / 2 * 8 / factor[i]
    assert abs((bound - width - true).mean()) < 0.002


def test_no_vectors_and_null_ids(rows):
    assert binary_codes.link_vectors(rows([], "vec_id bigint, embedding array<float>")).count() == 0
    data = [(None, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [0.0, 1.0]), (3, [1.0, 0.01])]
    found = binary_codes.link_vectors(rows(data, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 0, None, False)]))


def test_trees_side_by_side_find_what_all_pairs_find():
    r = np.random.default_rng(4)
    sizes = [1, 2, 2, 3, 4, 5, 8, 9, 64, 65, 70, 1, 600, 2]
    begins = np.cumsum(sizes) - sizes
    base = r.random((40, signature_join.BITS)) < 0.05
    bits = base[r.integers(0, 40, sum(sizes))] ^ (r.random((sum(sizes), signature_join.BITS)) < 0.002)
    ones = bits.sum(1)
    c = signature_join._Classes(ones + r.integers(0, 4, len(ones)), r.integers(0, 400, len(ones)), np.packbits(bits, axis=1).view(np.uint64))
    found = set(map(tuple, np.sort(np.stack(signature_join.tree_pairs(c, begins)), axis=0).T.tolist()))
    expected = set()
    for b, size in zip(begins, sizes):
        i, j = (b + x for x in np.triu_indices(size, 1))
        good = c.possible(i, j)
        expected |= set(zip(i[good].tolist(), j[good].tolist()))
    assert found == expected and len(found) > 1000


def test_small_buckets_have_trees_too(rows, monkeypatch):
    monkeypatch.setattr(signature_join, "PAIRS", 50)
    texts = _family(21, 2, 100, 2) + _family(22, 3, 100, 2) + _family(23, 4, 100, 2) + _family(24, 20, 60, 8)
    assert _found(rows(list(enumerate(texts)), "doc_id bigint, text string")) == _expected(texts)


def test_bounds_choose_the_pairs_that_are_worked_out(monkeypatch):
    r = np.random.default_rng(9)
    base = r.standard_normal((6, 64))
    unit = np.repeat(base, 20, axis=0) + 0.35 * r.standard_normal((120, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    i, j = np.triu_indices(120, 1)
    parts = binary_codes.encode(unit)
    both = np.minimum(binary_codes.upper_bound(*parts, i, j), binary_codes.upper_bound(*parts, j, i)) >= 0.9
    likely = binary_codes.likely_pairs(unit, 0.9)
    assert (likely[i, j] == both).all() and both.sum() < len(i) / 2
    worked, exact = [], binary_codes._reaches
    monkeypatch.setattr(binary_codes, "_reaches", lambda u, a, b, t: worked.append(len(a)) or exact(u, a, b, t))
    bands = 3
    keys = np.repeat(np.arange(bands)[None, :], 120, axis=0)  # all vectors share all buckets
    batches = [pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.arange(bands), 120)), pa.array(np.zeros(360, np.int32)), pa.array(np.zeros(360, np.int32)), pa.array(np.zeros(360, np.int32)),
        pa.array(np.tile(np.arange(120), bands)), pa.array(np.tile(keys, (bands, 1)).tolist(), pa.list_(pa.int64())),
        pa.array([u.tobytes() for u in unit] * bands, pa.binary()), pa.array(np.ones(360, np.int64)),
    ], names=["key", "block", "other", "side", "id", "keys", "unit", "weight"])]
    out = pa.Table.from_batches(list(binary_codes._exact(0.9)(iter(batches)))).to_pandas()
    assert sum(worked) == both.sum()  # once for a pair, not once for a band
    links = np.bincount(np.concatenate([x[(unit[i] * unit[j]).sum(1) >= 0.9] for x in (i, j)]), minlength=120)
    assert out[out.to < 0].set_index("id").n.to_dict() == {n: int(x) for n, x in enumerate(links) if x}
