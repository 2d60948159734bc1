"""Repeated windows against a plain version over all pairs of windows."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import SMALL

from weighlens.llm import super_kmers
from weighlens.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _expected(data):
    words = [WORD.findall(t or "") for _, t in data]
    low = defaultdict(lambda: float("inf"))
    for (i, _), w in zip(data, words):
        for a in range(len(w) - 12):
            if i is not None:
                low[tuple(w[a:a + 13])] = min(low[tuple(w[a:a + 13])], i)
    out = []
    for (i, _), w in zip(data, words):
        gone = {k for a in range(len(w) - 12) if i is not None and low[tuple(w[a:a + 13])] < i for k in range(a, a + 13)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def _check(data, found):
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, _expected(data)))


def _texts(rng, n):
    """Texts with shared passages, copies, a line that most have, and few words in all."""
    some = [f"w{i}" for i in range(40)]
    common = " ".join(rng.choices(some, k=5))
    passages = [" ".join(rng.choices(some, k=rng.randrange(12, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(some, k=rng.randrange(0, 30))) for _ in range(rng.randrange(1, 5))]
        for extra in rng.sample(passages, 2) + [common] * 3:
            parts.insert(rng.randrange(len(parts) + 1), extra)
        texts.append(rng.choice(["  ", "\n", "\t", " "]).join(parts))
    return texts + rng.sample(texts, n // 4)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(rows, seed):
    rng = random.Random(seed)
    data = list(enumerate(_texts(rng, 60)))
    rng.shuffle(data)
    docs = rows(data, "doc_id bigint, text string").repartition(5)
    _check(data, super_kmers.drop_repeats(docs).collect())


def test_hot_minimisers_travel_window_by_window(spark, rows, monkeypatch):
    """Every slot hot, few bytes sent at once: the same rows."""
    data = list(enumerate(_texts(random.Random(9), 40)))
    docs = rows(data, "doc_id bigint, text string").repartition(3).select("doc_id", "text", super_kmers._twin().alias("twin"))
    slots = 1 << 6
    sent = docs.mapInArrow(super_kmers._send(7, slots, np.arange(slots)), "bucket bigint, strings binary, places binary")
    ranges = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(super_kmers._count, "doc_id bigint, twin bigint, begin bigint, end bigint")
    found = {(r["doc_id"], k) for r in ranges.collect() for k in range(r["begin"], r["end"])}
    assert [sum(1 for d, _ in found if d == i) for i, _ in data] == [r[2] for r in _expected(data)]


def test_shared_hashes_do_not_matter(monkeypatch):
    """Windows are told apart by their words where hashes are the same."""
    rng = random.Random(3)
    strings = [" ".join(rng.choices("abc", k=rng.randrange(13, 30))) for _ in range(40)]
    octets = np.frombuffer(("\n".join(strings) + "\n").encode(), np.uint8)
    owner = np.array([rng.randrange(100) for _ in strings])
    good = super_kmers.window_lows(octets, owner)
    monkeypatch.setattr(super_kmers._Bytes, "hashes", lambda self, a, b: np.ones(len(a), np.uint64))
    same = super_kmers.window_lows(octets, owner)
    assert all(np.array_equal(x, y) for x, y in zip(good, same))
    low = defaultdict(lambda: 1000)
    cut = [s.split() for s in strings]
    for w, o in zip(cut, owner):
        for a in range(len(w) - 12):
            low[tuple(w[a:a + 13])] = min(low[tuple(w[a:a + 13])], o)
    assert good[1].tolist() == [low[tuple(w[a:a + 13])] for w in cut for a in range(len(w) - 12)]


def test_nulls_ties_long_repeated_and_clashing(rows):
    text = " ".join(f"x{i}" for i in range(30))
    other = " ".join(f"y{i}" for i in range(13))
    long = " ".join(f"z{i}" for i in range(200_000))
    data = [(2, text), (1, None), (3, ""), (None, text), (None, other), (5, "pre " + text + " post"), (5, other), (5, other), (9, other + " tail"),
            (-1, long), (7, "a " + long), (8, " ".join(["same"] * 40)), (10, " ".join(["same"] * 13)), (11, "é x " * 20), (12, "é x\n" * 14)]
    docs = rows([(i, t, 1, "r") for i, t in data], "doc_id bigint, text string, twin int, ranges string")
    _check(data, super_kmers.drop_repeats(docs).collect())
    assert super_kmers.drop_repeats(rows([], "doc_id bigint, text string")).count() == 0
    assert super_kmers.drop_repeats(rows([(1, None), (2, "few words")], "doc_id bigint, text string")).count() == 2


def test_table(spark):
    docs = table(spark, SMALL, "documents")
    _check([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], super_kmers.drop_repeats(docs).collect())
