"""Benchmark decontamination: word-pair seeds find passages, Smith-Waterman alignment scores them.

Local alignment of words (match 2, other word -1, gap -1) follows inserted, dropped and replaced words; its score is given
as a share of the item's perfect score.  What is aligned follows from the least share s, so that nothing above it is missed.
An alignment of k matched words and e other steps with an item of m words scores 2k - e >= 2sm.  Between two matched words
that follow each other lie no other step (weight 2), one (weight 1) or more (weight 0), so the weights sum up to
2(k - 1) - e >= 2sm - 2 at least.  Steps of weight 2 and 1 are seeds: two words of the item at most two places apart, met in
the text at most two places apart.  The alignment spans at most m + 2m(1 - s) words of the text, as 2k - e >= 2sm and k <= m.
So only runs of that many words whose seeds weigh enough are aligned, and all of these, however often a seed occurs.  Where
2sm - 2 is not above 0 (short items), each word of the item is a seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import staged
from weighlens.llm.words import mixed, text_ngrams, word_hashes

BROADCAST_BYTES = 16 << 20  # test items go to every task, up to this size at once; a larger set takes several scans
HITS = 1 << 21  # seeds met that are held at once
WAITING = 1 << 20  # words of stretches that wait for their alignment
CELLS = 1 << 15  # cells of the score tables' rows that are worked out side by side; a longer stretch is worked out alone

_ITEM = "item_id bigint, words binary, n_words int"
_LEAK = "doc_id bigint, item_id bigint, score double, first_word int, end_word int, seeds int"


def _item_words(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, words, n_words) of the items that have words."""
    def cut(batches):
        for batch in batches:
            words, counts = word_hashes(batch.column(1), plain=True)
            parts = np.split(words, np.cumsum(counts)[:-1])
            keep = [i for i, p in enumerate(parts) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array([parts[i].tobytes() for i in keep], pa.binary()),
                 pa.array([len(parts[i]) for i in keep], pa.int32())], names=["item_id", "words", "n_words"])

    return benchmark.select(F.col(item_id).cast("bigint"), text).mapInArrow(cut, _ITEM)


def _pairs(words: np.ndarray, apart: int) -> np.ndarray:
    """Hash of the word at each place and the one ``apart`` places on."""
    return mixed(mixed(words[:-apart]) + words[apart:])


class _Seeds:
    """Seeds of some items, sorted: word pairs, and single words of short items."""

    def __init__(self, words: list[np.ndarray], least_score: float):
        size = np.array([len(w) for w in words], np.int64)
        self.least = 2 * least_score * size - 2 - 1e-6
        short = self.least <= 0
        self.least[short] = 1
        self.span = size + np.ceil(2 * size * (1 - least_score)).astype(np.int64)
        self.far = np.maximum(2 * size, self.span)
        self.of_pairs = self._sorted([(_pairs(w, k), i, 3 - k) for i, w in enumerate(words) if not short[i] for k in (1, 2)])
        self.of_words = self._sorted([(w, i, 1) for i, w in enumerate(words) if short[i]])

    @staticmethod
    def _sorted(parts):
        """(hashes, items, weights), each hash of an item once with its largest weight."""
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = np.concatenate([h for h, _, _ in parts])
        item = np.concatenate([np.full(len(h), i, np.int64) for h, i, _ in parts])
        weight = np.concatenate([np.full(len(h), w, np.int64) for h, _, w in parts])
        order = np.lexsort((-weight, item, key))
        key, item, weight = key[order], item[order], weight[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        return key[first], item[first], weight[first]

    def marks(self):
        """Per table: which leading 20 bits its hashes have."""
        out = []
        for key, _, _ in (self.of_pairs, self.of_words):
            mark = np.zeros(1 << 20, bool)
            mark[key >> np.uint64(44)] = True
            out.append(mark)
        return out


def _met(words, counts, seeds: _Seeds, marks):
    """Places where the texts meet seeds: (places, first row of the table, rows, table, weight at most) per kind of seed."""
    text = np.repeat(np.arange(len(counts)), counts)
    out = []
    for table, mark, apart in ((seeds.of_pairs, marks[0], 1), (seeds.of_pairs, marks[0], 2), (seeds.of_words, marks[1], 0)):
        if not len(table[0]) or len(words) <= apart:
            continue
        key = _pairs(words, apart) if apart else words
        at = np.flatnonzero(mark[key >> np.uint64(44)])
        at = at[text[at] == text[at + apart]]
        left = np.searchsorted(table[0], key[at], side="left")
        rows = np.searchsorted(table[0], key[at], side="right") - left
        some = rows > 0
        out.append((at[some], left[some], rows[some], table, 1 if apart == 2 else 2))
    return text, out


def _stretches(counts, text, met, seeds: _Seeds):
    """(text, item, first word, end word) of all stretches that may align well enough."""
    starts = np.cumsum(counts) - counts
    room = int(seeds.far.max()) + 1  # keeps texts apart
    width = int(counts.sum()) + room * (len(counts) + 1)
    # texts in chunks of about HITS hits; a text with more of them meets its items one share after the other
    load = np.zeros(len(counts) + 1, np.int64)
    for at, _, rows, _, _ in met:
        load[1:] += np.bincount(text[at], rows, minlength=len(counts)).astype(np.int64)
    load = np.cumsum(load)
    begin = 0
    while begin < len(counts):
        end = max(begin + 1, int(np.searchsorted(load, load[begin] + HITS, side="right")) - 1)
        shares = max(1, -(-int(load[end] - load[begin]) // HITS))
        for share in range(shares):
            keys = []
            for at, left, rows, (_, items, weights), most in met:
                a, b = np.searchsorted(text[at], [begin, end])
                for x in range(a, b, HITS // 64) if shares > 1 else [a]:
                    part = slice(x, min(b, x + HITS // 64) if shares > 1 else b)
                    many = rows[part]
                    row = np.repeat(left[part] - np.cumsum(many) + many, many) + np.arange(many.sum())
                    where = np.repeat(at[part], many)
                    if shares > 1:
                        mine = items[row] % shares == share
                        row, where = row[mine], where[mine]
                    keys.append((items[row] * width + where + text[where] * room) * 4 + np.minimum(weights[row], most))
            keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            last = np.ones(len(keys), bool)  # of a place and item, the largest weight
            last[:-1] = keys[1:] >> 2 != keys[:-1] >> 2
            place, weight = keys[last] >> 2, keys[last] & 3
            if not len(place):
                continue
            item = place // width
            reach = np.searchsorted(place, place + seeds.span[item], side="left")
            total = np.concatenate([[0], np.cumsum(weight)])
            dense = np.flatnonzero(total[reach] - total[:-1] >= seeds.least[item])
            cover = np.bincount(dense, minlength=len(place) + 1) - np.bincount(reach[dense], minlength=len(place) + 1)
            keep = np.cumsum(cover)[:-1] > 0
            place, item = place[keep], item[keep]
            new = np.ones(len(place), bool)
            new[1:] = (item[1:] != item[:-1]) | (place[1:] - place[:-1] > seeds.far[item[1:]])
            firsts = np.flatnonzero(new)
            shift = starts + np.arange(len(counts)) * room
            for b, e in zip(firsts, np.append(firsts[1:], len(place))):
                i, low = int(item[b]), int(place[b] - item[b] * width)
                t = int(np.searchsorted(shift, low, side="right")) - 1
                while not counts[t]:
                    t -= 1
                low, high = low - int(shift[t]), int(place[e - 1] - item[b] * width - shift[t])
                yield t, i, max(0, low - int(seeds.span[i])), min(int(counts[t]), high + int(seeds.span[i]) + 1)
        begin = end


def _leaks(words: list[np.ndarray], n: int, least_score: float):
    """Function from a batch's texts to its leaks: (text, item, score, first word, end word, n-grams that are whole)."""
    seeds = _Seeds(words, least_score)
    marks = seeds.marks()

    def grams(w, size):
        return np.unique(text_ngrams(w, np.array([len(w)]), size)[0])

    def run(texts: pa.Array) -> list[tuple]:
        heard, counts = word_hashes(texts, plain=True)
        starts = np.cumsum(counts) - counts
        text, met = _met(heard, counts, seeds, marks)
        known, out = {}, []  # copies of a stretch are aligned once
        waiting, fresh, held = [], {}, 0

        def settle():
            keys = list(fresh)
            aligned = align_many([words[i] for i, _ in keys], [fresh[k] for k in keys])
            for (i, body), (points, first, end) in zip(keys, aligned):
                share = points / (2 * len(words[i]))
                size = min(n, len(words[i]))
                whole = len(np.intersect1d(grams(words[i], size), grams(fresh[i, body], size))) if share >= least_score else 0
                known[i, body] = share, first, end, whole
            for t, low, pair in waiting:
                share, first, end, whole = known[pair]
                if share >= least_score:
                    out.append((t, pair[0], share, low + first, low + end, whole))
            waiting.clear()
            fresh.clear()

        for t, i, low, high in _stretches(counts, text, met, seeds):
            stretch = heard[starts[t] + low:starts[t] + high]
            pair = i, stretch.tobytes()
            waiting.append((t, low, pair))
            if pair in known or pair in fresh:
                continue
            if np.isin(words[i], stretch).sum() < least_score * len(words[i]) - 1e-6:  # each word matched counts 2 at most
                known[pair] = 0.0, 0, 0, 0
                continue
            fresh[pair] = stretch
            held += len(stretch)
            if held > WAITING:
                settle()
                held = 0
        settle()
        return out

    return run


def _slices(benchmark: DataFrame, most_bytes: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, words) of the items that have words, about ``most_bytes`` of words at once."""
    items = staged(_item_words(benchmark, "item_id", "text"), "leak-items")
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    ids, words, held = [], [], 0
    for r in items.collect() if size <= most_bytes else items.toLocalIterator():
        if ids and held + len(r["words"]) > most_bytes:
            yield ids, words
            ids, words, held = [], [], 0
        ids.append(r["item_id"])
        words.append(np.frombuffer(r["words"], np.uint64))
        held += len(r["words"])
    if ids:
        yield ids, words


def align(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of an item's words in a stretch: (score, first word, word behind the last)."""
    return align_many([item], [stretch])[0]


def align_many(items: list[np.ndarray], stretches: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """``align`` of each item with its stretch; pairs of like lengths are worked out side by side.

    What a pair gets does not depend on the others: places behind the end of a shorter item or stretch match nothing, so
    that scores only fall there, and the best is the first one met.
    """
    out = [(0, 0, 0)] * len(items)
    order = sorted(range(len(items)), key=lambda k: (len(items[k]) // 8, len(stretches[k])))
    begin = 0
    while begin < len(order):
        end, width = begin + 1, len(stretches[order[begin]])
        while end < len(order) and len(items[order[end]]) // 8 == len(items[order[begin]]) // 8:
            width = len(stretches[order[end]])
            if (end + 1 - begin) * (width + 1) > CELLS:
                break
            end += 1
        some = order[begin:end]
        for k, best in zip(some, _align_block([items[k] for k in some], [stretches[k] for k in some])):
            out[k] = best
        begin = end
    return out


def _align_block(items: list[np.ndarray], stretches: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """A row of all score tables at once: gaps within a row are a running maximum of score plus position."""
    def padded(parts):
        table = np.zeros((len(parts), max(map(len, parts))), np.uint64)
        there = np.zeros(table.shape, bool)
        for row, part in enumerate(parts):
            table[row, :len(part)] = part
            there[row, :len(part)] = True
        return table, there

    (words, live), (text, inside) = padded(items), padded(stretches)
    rows, width = text.shape
    score = np.zeros((rows, width + 1), np.int32)
    steps = np.arange(width + 1, dtype=np.int32)
    begin = np.broadcast_to(steps, score.shape)
    value, origin = np.zeros_like(score), np.zeros_like(score)
    best = np.zeros((rows, 3), np.int64)
    each = np.arange(rows)
    for i in range(words.shape[1]):
        same = (text == words[:, i:i + 1]) & inside & live[:, i:i + 1]
        diagonal = score[:, :-1] + np.where(same, np.int32(2), np.int32(-1))
        above = score[:, 1:] - 1
        value[:, 1:] = np.maximum(np.maximum(diagonal, above), 0)
        origin[:, 1:] = np.where(diagonal >= above, begin[:, :-1], begin[:, 1:])
        start = np.where(value > 0, origin, steps)
        along = value + steps  # a gap of k words costs k
        peak = np.maximum.accumulate(along, axis=1)
        source = np.maximum.accumulate(np.where(along == peak, steps, 0), axis=1)
        score = peak - steps
        begin = np.where(score > 0, np.take_along_axis(start, source, axis=1), steps)
        top = score.argmax(axis=1)
        points = score[each, top]
        better = points > best[:, 0]
        if better.any():
            best[better] = np.stack([points, begin[each, top], top], axis=1)[better]
    return [(int(p), int(first), int(last)) for p, first, last in best]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, n: int = 5, least_score: float = 0.5, rare_docs: int = 1000,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word, seeds) of every stretch that aligns with at least ``least_score``.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read.  score is the alignment's
    share of the item's perfect score; words are counted from 0 in the text's words of letters and digits; seeds are the
    item's distinct runs of n words (of all words, if it has fewer) that the stretch holds unchanged, which may be none.
    Stretches of an item less than twice its length apart are one.  ``rare_docs`` is taken for older calls and leaves
    nothing out.  NULL and empty texts, items without words and empty tables give no rows.  Repeated rows and NULL ids
    give their rows as often as they occur.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def found(ids, words):
        def scan(batches):
            leaks = _leaks(words, n, least_score)
            for whole in batches:
                for at in range(0, whole.num_rows, 2000):
                    batch = whole.slice(at, 2000)
                    text, item, *rest = list(zip(*leaks(batch.column(1)))) or [()] * 6
                    names = ["doc_id", "item_id", "score", "first_word", "end_word", "seeds"]
                    columns = [batch.column(0).take(pa.array(text, pa.int64())), pa.array([ids[i] for i in item], pa.int64())]
                    types = (pa.float64(), pa.int32(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(c, t) for c, t in zip(rest, types)], names=names)

        return docs.mapInArrow(scan, _LEAK)

    parts, held = [], None
    for x in _slices(benchmark, broadcast_bytes):
        if held is not None:  # more than one: written one after the other, so that one list of items is held at a time
            parts.append(staged(held, "leaks"))
        held = found(*x)
    if held is None:
        return docs.sparkSession.createDataFrame([], _LEAK)
    return reduce(DataFrame.union, [*parts, held])


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, n: int = 5, least_score: float = 0.5, rare_docs: int = 1000,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; all columns and repeated rows are kept.

    Each row is judged by its own text, so rows with NULL ids go like others and rows that share an id do not take each other along.
    """
    at_text = docs.columns.index("text")

    def without(rows, words):
        def scan(batches):
            leaks = _leaks(words, n, least_score)
            for whole in batches:
                for at in range(0, whole.num_rows, 2000):
                    batch = whole.slice(at, 2000)
                    keep = np.ones(batch.num_rows, bool)
                    keep[[t for t, *_ in leaks(batch.column(at_text))]] = False
                    yield batch.filter(pa.array(keep))

        return rows.mapInArrow(scan, docs.schema)

    left = None
    for _, words in _slices(benchmark, broadcast_bytes):  # written in between, as in find_leaks
        left = without(docs if left is None else staged(left, "without-leaks"), words)
    return docs if left is None else left
