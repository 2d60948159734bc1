"""Decontamination, toxicity and quality: brute force where there is one, held-out accuracy where there is not."""

import math
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest
from conftest import SMALL

from weighlens.llm import decontaminate, quality_eb, toxic_crf
from weighlens.llm.common import table

TEN_TIMES = "/root/testdata/sf0.01"


def _align(item, stretch):
    """Best local alignment score by the textbook table."""
    score = [[0] * (len(stretch) + 1) for _ in range(len(item) + 1)]
    for i, j in product(range(1, len(item) + 1), range(1, len(stretch) + 1)):
        score[i][j] = max(0, score[i - 1][j - 1] + (2 if item[i - 1] == stretch[j - 1] else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
    return max(map(max, score))


def test_alignment_is_that_of_the_table():
    r = random.Random(1)
    for _ in range(60):
        item = [r.randrange(6) for _ in range(r.randrange(1, 15))]
        stretch = [r.randrange(6) for _ in range(r.randrange(0, 30))]
        points, first, end = decontaminate.align(np.array(item, np.uint64), np.array(stretch, np.uint64))
        assert points == _align(item, stretch)
        if points:  # the place it names scores as much by itself
            assert _align(item, stretch[first:end]) == points


def _words(text):
    return [w for w in (re.sub(r"[\W_]+", "", x) for x in (text or "").lower().split()) if w]


ITEM = " ".join(f"item{i}" for i in range(40))


def _leaky(r):
    filler = lambda n: " ".join(f"f{r.randrange(10 ** 9)}" for _ in range(n))
    words = ITEM.split()
    edited = [w if k % 8 else f"new{k}" for k, w in enumerate(words)]
    dropped = [w for k, w in enumerate(words) if k % 9]
    added = [x for k, w in enumerate(words) for x in ([w, "extra"] if k % 7 == 3 else [w])]
    return {
        1: filler(50) + " " + ITEM.upper() + ". " + filler(50), 2: filler(5) + " " + " ".join(edited), 3: " ".join(dropped) + " " + filler(500), 4: " ".join(added),
        5: filler(200), 6: " ".join(words[:8]) + " " + filler(100), 7: None, 8: "", 9: filler(20_000) + " " + ITEM + " " + filler(20_000) + " " + ITEM,
        10: " ".join(w for w in words for _ in (0, 1)), 11: "one two three", 12: " ".join(reversed(words)),
    }


@pytest.mark.parametrize("room", [1 << 24, 0])
def test_leaks_are_found_and_clean_texts_left(rows, room):
    texts = _leaky(random.Random(2))
    docs = rows([(i, t, 0.5) for i, t in texts.items()] + [(1, texts[1], 0.5), (None, ITEM, 0.5)], "doc_id bigint, text string, score double")
    items = rows([(1, ITEM, "x"), (2, "one two three", "x"), (3, None, "x"), (4, "", "x"), (5, "never seen words at all", "x")], "item_id bigint, text string, seeds string")
    found = decontaminate.find_leaks(docs, items, broadcast_bytes=room).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, 1) for i in (1, 2, 3, 4, 9, 10, None)} | {(11, 2)}
    assert sum(r["doc_id"] == 9 for r in found) == 2 and sum(r["doc_id"] == 1 for r in found) == 2
    for r in found:
        words = _words(ITEM if r["doc_id"] is None else texts[r["doc_id"]])
        item = _words(ITEM) if r["item_id"] == 1 else ["one", "two", "three"]
        assert r["score"] == pytest.approx(_align(item, words[max(0, r["first_word"] - 5):r["end_word"] + 5]) / (2 * len(item)))
    kept = decontaminate.drop_leaks(docs, items, broadcast_bytes=room).collect()
    assert {r["doc_id"] for r in kept} == {5, 6, 7, 8, 12}  # a row without an id goes by its text


@pytest.mark.parametrize("cells", [1, 200, 1 << 15])
def test_alignments_side_by_side_are_those_of_each_alone(monkeypatch, cells):
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    r = random.Random(3)
    draw = lambda most, least=0: np.array([r.randrange(6) for _ in range(r.randint(least, most))], np.uint64)
    items, stretches = [draw(20, 1) for _ in range(300)], [draw(40) for _ in range(300)]
    got = decontaminate.align_many(items, stretches)
    assert got == [decontaminate.align(a, b) for a, b in zip(items, stretches)]
    assert [points for points, _, _ in got] == [_align(list(a), list(b)) for a, b in zip(items, stretches)]
    assert decontaminate.align_many([], []) == []


def test_frequent_seeds_do_not_hide_a_leak(rows):
    docs = rows([(i, f"w{i} " + ITEM) for i in range(60)] + [(100, "item0 item1 item2 item3 item4 other")], "doc_id bigint, text string")
    items = rows([(1, ITEM)], "item_id bigint, text string")
    assert {r["doc_id"] for r in decontaminate.find_leaks(docs, items, rare_docs=5).collect()} == set(range(60))


@pytest.mark.parametrize("room", [1 << 24, 0])
def test_leaks_in_many_documents_are_all_found(rows, room):
    words = ITEM.split()[:16]
    edited = [w if k % 6 else f"new{k}" for k, w in enumerate(words, 1)]  # two intact runs of five words
    texts = {i: f"w{i} " + " ".join(edited) for i in range(20)} | {i: f"w{i} four words of it" for i in range(20, 40)}
    items = rows([(1, " ".join(words)), (2, "four words of it")], "item_id bigint, text string")
    found = decontaminate.find_leaks(rows(list(texts.items()), "doc_id bigint, text string"), items, rare_docs=5, broadcast_bytes=room)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, 1) for i in range(20)} | {(i, 2) for i in range(20, 40)}


def _edits(r):
    """Copies of items with every 2nd to 9th word replaced, dropped, added or doubled, items of 1 to 40 words, loose words."""
    items, texts = [], []
    for m in (1, 2, 3, 4, 5, 6, 9, 16, 25, 40):
        item = [f"i{m}x{r.randrange(10 ** 6) if m > 9 else k}" for k in range(m)]
        if m == 25:
            item = [w if k % 3 else "the" for k, w in enumerate(item)]
        items.append(item)
        for every in range(2, 10):
            for kind in ("replace", "drop", "add", "both"):
                out = []
                for k, w in enumerate(item, r.randrange(every)):
                    edit = k % every == 0
                    out += [f"n{r.randrange(10 ** 6)}"] if edit and kind == "replace" else [w]
                    out = out[:-1] if edit and kind == "drop" else out + ["more"] if edit and kind in ("add", "both") else out
                    out = out[:-2] + ["more"] if edit and kind == "both" and every > 4 else out
                fill = lambda: [r.choice(["the", "more", f"f{r.randrange(10 ** 6)}"]) for _ in range(r.randrange(12))]
                texts.append(fill() + out + fill())
    for item in items:
        texts.append([x for w in item for x in (w, w)])
        texts.append([x for w in item for x in (w, "more")])
    return items, texts


@pytest.mark.parametrize("share", [0.5, 0.4, 0.8])
def test_edited_copies_are_those_of_brute_force(share):
    for seed in range(3):
        items, texts = _edits(random.Random(seed))
        hashed = lambda w: decontaminate.word_hashes(decontaminate.pa.array([" ".join(w)]), plain=True)[0]
        found = decontaminate._leaks([hashed(w) for w in items], 5, share)(decontaminate.pa.array([" ".join(t) for t in texts]))
        best = {(t, i): _align(item, text) / (2 * len(item)) for t, text in enumerate(texts) for i, item in enumerate(items) if set(item) & set(text)}
        assert {(t, i): s for t, i, s, *_ in sorted(found, key=lambda f: f[2])} == pytest.approx({k: s for k, s in best.items() if s >= share})


@pytest.mark.parametrize("hits", [1, 7, 100])
def test_chunks_of_seeds_change_nothing(monkeypatch, hits):
    items, texts = _edits(random.Random(5))
    hashed = [decontaminate.word_hashes(decontaminate.pa.array([" ".join(w)]), plain=True)[0] for w in items]
    texts = decontaminate.pa.array([" ".join(t) for t in texts[::7]] + ["", None] + [" ".join(sum(texts, []))])
    whole = sorted(decontaminate._leaks(hashed, 5, 0.5)(texts))
    monkeypatch.setattr(decontaminate, "HITS", hits * 64)
    assert sorted(decontaminate._leaks(hashed, 5, 0.5)(texts)) == whole


@pytest.mark.parametrize("room", [1 << 24, 0])
def test_copies_without_five_words_in_a_row_are_found(rows, room):
    words = ITEM.split()
    texts = {every: " ".join(w if k % every else f"new{k}" for k, w in enumerate(words)) for every in (3, 4, 5)}
    texts[10] = " ".join(w for w in words for _ in (0, 1))  # scores 0.525
    docs = rows(list(texts.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in decontaminate.find_leaks(docs, rows([(1, ITEM), (2, "other words")], "item_id bigint, text string"), broadcast_bytes=room).collect()}
    expected = {i: _align(words, t.split()) / (2 * len(words)) for i, t in texts.items()}
    assert found == pytest.approx({i: s for i, s in expected.items() if s >= 0.5}) and {4, 5, 10} <= set(found)


@pytest.mark.parametrize("room", [1 << 24, 0])
def test_rows_without_ids_leak_like_others(rows, room):
    docs = rows([(None, ITEM, 1.0), (None, "clean text", 2.0), (1, "see " + ITEM, 3.0), (1, "clean", 4.0), (2, None, 5.0)], "doc_id bigint, text string, score double")
    items = rows([(None, ITEM), (7, "never seen words")], "item_id bigint, text string")
    found = decontaminate.find_leaks(docs, items, broadcast_bytes=room).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in found) == [("1", None), ("None", None)]
    kept = decontaminate.drop_leaks(docs, items, broadcast_bytes=room)
    assert kept.columns == docs.columns and sorted(r["score"] for r in kept.collect()) == [2.0, 4.0, 5.0]


def test_given_leaks_are_those_of_a_plain_search(spark):
    docs, items = table(spark, TEN_TIMES, "documents"), table(spark, TEN_TIMES, "benchmark")
    flat = {r["doc_id"]: " ".join(_words(r["text"])) for r in docs.collect()}
    whole = {(i, r["item_id"]) for r in items.collect() for i, t in flat.items() if " ".join(_words(r["text"])) in t}
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert whole and whole <= found


def test_no_documents_or_items(rows):
    docs, items = rows([(1, ITEM)], "doc_id bigint, text string"), rows([(1, ITEM)], "item_id bigint, text string")
    for room in (1 << 24, 0):
        assert decontaminate.find_leaks(docs.limit(0), items, broadcast_bytes=room).count() == 0
        assert decontaminate.find_leaks(docs, items.limit(0), broadcast_bytes=room).count() == 0


def test_marginals_are_sums_over_all_labellings():
    r = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 9, 5, 2])
    emission, steps = r.normal(0, 2, counts.sum()), r.normal(0, 1, (2, 2))
    expected, at = [], 0
    for n in counts:
        e = emission[at:at + n]
        total, toxic = 0.0, np.zeros(n)
        for y in product((0, 1), repeat=int(n)):
            weight = math.exp(sum(v / 2 * (1 if s else -1) for v, s in zip(e, y)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total, toxic = total + weight, toxic + weight * np.array(y)
        expected += list(toxic / total) if n else []
        at += n
    for block in (1, 2, 4, 64):
        assert toxic_crf.marginals(emission, counts, steps, block) == pytest.approx(expected, abs=1e-9)


def test_toxic_documents_are_told_apart_on_rows_not_learned_from(spark):
    docs, labels = table(spark, TEN_TIMES, "documents"), table(spark, TEN_TIMES, "labels").collect()
    held = {r["doc_id"]: r["toxic"] for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    train = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in labels if r["doc_id"] not in held], "doc_id bigint, toxic int")
    model = toxic_crf.train(docs, train)
    found = {r["doc_id"]: r for r in toxic_crf.score(docs, model).collect()}
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found.values())
    bad, good = [[found[i]["score"] for i, t in held.items() if t == x] for x in (1, 0)]
    assert np.mean([a > b for a in bad for b in good]) > 0.75  # 41 toxic rows to learn from; with 1,740 none is missed
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = [texts[i][s["start"]:s["end"]] for i, r in found.items() for s in r["spans"]]
    assert words and all(w == w.strip() and " " not in w for w in words)


def test_toxicity_of_odd_rows(rows):
    docs = rows([(1, None), (2, ""), (3, "vile " * 20_000), (3, "vile words"), (None, "x"), (4, "calm words here")], "doc_id bigint, text string")
    labels = rows([(3, 1), (4, 0), (None, 1), (5, None), (3, 1)], "doc_id bigint, toxic int")
    assert toxic_crf.score(docs, toxic_crf.train(docs, labels)).count() == 6
    assert toxic_crf.score(docs.limit(0), toxic_crf.train(docs.limit(0), labels.limit(0))).count() == 0


def _posteriors(rows_, base, host_of, path_of):
    """Quality by the same formulas, one document at a time; rows_ are (p, host, path)."""
    def prior(groups, mean):
        n = sum(len(g) for g in groups.values())
        k = len(groups)
        if k < 2 or n <= k:
            return 1e6
        rate = sum(map(sum, groups.values())) / n
        noise = sum(sum((x - np.mean(g)) ** 2 for x in g) for g in groups.values()) / (n - k)
        between = sum(len(g) * (np.mean(g) - mean(key)) ** 2 for key, g in groups.items())
        spread = (between - (k - 1) * noise) / max(1.0, n - sum(len(g) ** 2 for g in groups.values()) / n)
        return min(1e6, max(1.0, rate * (1 - rate) / spread - 1)) if spread > 0 else 1e6

    hosts, paths = {}, {}
    for p, h, d in rows_:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, d), []).append(p)
    rate = np.mean([r[0] for r in rows_])
    of_host, of_path = prior(hosts, lambda _: rate), prior(paths, lambda key: np.mean(hosts[key[0]]))
    out = []
    for p, h, d in rows_:
        host = (of_host * rate + sum(hosts[h]) - p) / (of_host + len(hosts[h]) - 1)
        path = (of_path * host + sum(paths[h, d]) - p) / (of_path + len(paths[h, d]) - 1)
        odds = math.log(p / (1 - p)) - math.log(base / (1 - base)) + math.log(path / (1 - path))
        out.append(1 / (1 + math.exp(-odds)))
    return out


def test_posteriors_are_those_of_the_formulas(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    found = quality_eb.add_quality(docs, labels).collect()
    base = quality_eb.train(docs, labels).base
    clip = lambda p: min(max(p, 1e-9), 1 - 1e-9)
    expected = _posteriors([(clip(r["evidence"]), r["source"], r["lang"]) for r in found], base, "source", "lang")
    assert [r["quality"] for r in found] == pytest.approx(expected, abs=1e-6)


def test_quality_of_rows_not_learned_from(spark):
    docs, labels = table(spark, TEN_TIMES, "documents"), table(spark, TEN_TIMES, "labels")
    held = labels.filter("doc_id % 3 = 0")
    kept = dict(quality_eb.add_quality(docs, labels.filter("doc_id % 3 != 0")).select("doc_id", "keep").collect())
    truth = {r["doc_id"]: r["quality"] for r in held.collect()}
    assert np.mean([kept[i] == (q == 1) for i, q in truth.items()]) > 0.95
    assert np.mean([kept[i] for i, q in truth.items() if q == 1]) > 0.97


def test_sparse_sites_are_shrunk(rows):
    r = random.Random(3)
    good = lambda: " ".join(r.choice(["the", "reading", "is", "of", "value", "there"]) + str(r.randrange(9)) for _ in range(60))
    junk = lambda: "#### $$$$ " * 30
    data = [(i, junk() if i % 2 else good(), "bad" if i % 2 else "fine", "p") for i in range(400)] + [(900, junk(), "lone", "p"), (901, good(), None, None), (902, None, "fine", None)]
    docs = rows([(*x, True) for x in data], "doc_id bigint, text string, source string, lang string, keep boolean")
    labels = rows([(i, 1 - i % 2) for i in range(0, 400, 3)], "doc_id bigint, quality int")
    found = {x["doc_id"]: x for x in quality_eb.add_quality(docs, labels).collect()}
    assert found[1]["path_rate"] < 0.2 < 0.3 < found[900]["path_rate"] < 0.7 < 0.8 < found[0]["path_rate"]
    assert not found[1]["keep"] and found[0]["keep"] and not found[900]["keep"] and found[901]["keep"]


def test_quality_without_labels_or_documents(rows):
    docs = rows([(1, "a b c", "s", "l"), (1, "a b c", "s", "l"), (None, None, None, None)], "doc_id bigint, text string, source string, lang string")
    labels = rows([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert [r["evidence"] for r in quality_eb.add_quality(docs, labels).collect()] == pytest.approx([0.5] * 3)
    assert quality_eb.add_quality(docs.limit(0), labels).count() == 0
