"""Shards and mixing against the same rules in plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL

from weighlens.llm import histogram_shards, poisson_mix
from weighlens.llm.common import table


def _h(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _place(rows, shards, tolerance):
    """(doc_id, shard) by sorting everything."""
    keyed = sorted((_h(t or ""), _h("null" if i is None else str(i)), len((t or "").encode()) + 1, i) for i, t in rows)
    total = sum(k[2] for k in keyed)

    def edges(items, level):
        upto, last, out = 0, None, []
        for k in items:
            if last != k[: level]:
                out.append((upto, k[: level]))
                last = k[: level]
            upto += k[2]
        return out + [(upto, (last[0], last[1] + 1) if level == 2 else (last[0] + 1,))]

    cuts = []
    for j in range(1, shards):
        goal = total * j
        groups = edges(keyed, 1)
        n = max(x for x in range(len(groups) - 1) if groups[x][0] * shards <= goal)
        before, after = goal - groups[n][0] * shards, groups[n + 1][0] * shards - goal
        if min(before, after) <= tolerance * total:
            cuts.append((groups[n][1][0], 0) if before <= after else (groups[n][1][0] + 1, 0))
            continue
        inner = edges([k for k in keyed if k[0] == groups[n][1][0]], 2)
        inner = [(groups[n][0] + b, k) for b, k in inner]
        m = max(x for x in range(len(inner) - 1) if inner[x][0] * shards <= goal)
        before, after = goal - inner[m][0] * shards, inner[m + 1][0] * shards - goal
        cuts.append(inner[m][1] if before <= after else (inner[m][1][0], inner[m][1][1] + 1))
    cuts = sorted(cuts)
    return sorted((-1 if i is None else i, sum(c <= (h, k) for c in cuts)) for h, k, _, i in keyed)


CASES = {
    "hot text": [(i, "copy of a text" if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(600)],
    "one text": [(i, "all the same") for i in range(64)],
    "edges": [(None, None), (1, ""), (2, None), (2, None), (3, "é" * 1000), (4, "z" * 100_000)],
    "two rows": [(1, "a"), (2, "b")],
}


@pytest.mark.parametrize("case", CASES)
def test_shards_are_where_a_full_sort_puts_them(rows, case):
    data = CASES[case]
    docs = rows([(*r, "kept", 9) for r in data], "doc_id bigint, text string, shard string, more int").repartition(4)
    found = histogram_shards.shard_by_bytes(docs, shards=8, tolerance=0.02).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["shard"]) for r in found) == _place(data, 8, 0.02)
    slots = defaultdict(list)
    for r in found:
        assert r["size"] == len((r["text"] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) and r["more"] == 9
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_the_given_documents_are_nearly_equal(spark):
    docs = table(spark, SMALL, "documents")
    found = histogram_shards.shard_by_bytes(docs, shards=4).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in found]
    largest = max(len((r[0] or "").encode()) for r in docs.select("text").collect())
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 2 * largest


def test_no_rows_no_shards(rows):
    assert histogram_shards.shard_by_bytes(rows([], "doc_id bigint, text string")).count() == 0


def _poisson(rate, seed, i):
    parts = max(1, math.ceil(rate / 32.0))
    small, total = rate / parts, 0
    for n in range(parts):
        u = (_h(f"{seed}|{i}|{n}") >> 8) / 2.0 ** 52
        p = below = math.exp(-small)
        k = 0
        for x in range(1, math.ceil(small + 12 * math.sqrt(small) + 20) + 1):
            k += u >= below
            p = p * small / x
            below += p
        total += k
    return total


def test_copies_follow_the_poisson_distribution(rows):
    data = [(i, "t" * (i % 7), ["hot", "hot", "b", None][i % 4]) for i in range(800)]
    docs = rows([(*r, 1) for r in data], "doc_id bigint, text string, source string, copy int")
    found = poisson_mix.mix_sources(docs, temperature=0.5, epochs=2.0, seed=7).collect()
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(t) + 1
    weights = {s: math.sqrt(n) for s, n in sizes.items()}
    total, all_weights = sum(sizes.values()), sum(weights.values())
    rate = {s: weights[s] / all_weights * 2.0 * total / sizes[s] for s in sizes}
    expected = Counter({i: _poisson(rate[s], 7, i) for i, _, s in data})
    got = Counter(r["doc_id"] for r in found)
    assert got == +expected
    assert all(sorted(r["copy"] for r in found if r["doc_id"] == i) == list(range(n)) for i, n in list(got.items())[:50])
    bytes_of = Counter()
    for r in found:
        bytes_of[r["source"]] += len(r["text"]) + 1
    for s in sizes:  # near the target shares
        assert bytes_of[s] / sum(bytes_of.values()) == pytest.approx(weights[s] / all_weights, abs=0.05)


def test_large_rates_given_weights_and_missing_sources(rows):
    docs = rows([(i, "x", "rare") for i in range(20)] + [(100 + i, "y" * 99, "big") for i in range(100)] + [(300, None, "gone")], "doc_id bigint, text string, source string")
    weights = rows([("rare", 1.0), ("big", 1.0), ("absent", 0.0)], "source string, weight double")
    found = poisson_mix.mix_sources(docs, weights, epochs=1.0).collect()
    n = Counter(r["source"] for r in found)
    assert n["gone"] == 0 and abs(n["rare"] - 2510) < 300 and abs(n["big"] - 50) < 30
    rate = next(r["rate"] for r in found if r["source"] == "rare")
    assert Counter(r["doc_id"] for r in found if r["source"] == "rare")[3] == _poisson(rate, 42, 3)


def test_mix_of_repeated_rows_and_of_nothing(rows):
    docs = rows([(1, "a", "s"), (1, "a", "s"), (None, None, None)], "doc_id bigint, text string, source string")
    n = Counter(r["doc_id"] for r in poisson_mix.mix_sources(docs, epochs=5.0).collect())
    assert n[1] % 2 == 0
    assert poisson_mix.mix_sources(docs.limit(0)).count() == 0
