"""Toxicity by a linear-chain conditional random field over the words of a text.

Only documents are labelled.  Words get their labels from them: a word form (the word or its first 4 to 6 letters) that
stands in toxic documents far more often than in clean ones marks the words of toxic documents.  On windows of such
labelled words the field is trained by maximum likelihood: weights of word forms, of the two states and of the steps
between them.  Scoring runs forward-backward over every whole text.  The words' marginals give the spans; their largest
value and their sum, through a logistic curve fitted on the same documents, give the document's score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import hash60, staged

TRAIN_ROWS = 12_000  # at most so many labelled documents are learned from, those with the lowest hashes of their ids
WINDOWS = 1  # windows of REACH words to each side that a labelled document gives to train the field
REACH = 10
KNOWN_WORDS = 1_000_000  # a worker forgets its words beyond this many


def word_forms(word: str) -> list[str]:
    """The word in lower case without outer punctuation, and its first 4, 5 and 6 letters if it is longer."""
    w = word.lower().strip(".,;:!?\"'()[]{}<>|*#$%&_-+=/\\")
    return ([w] + [f"{w[:k]}~" for k in (4, 5, 6) if len(w) > k]) if w else []


@dataclass
class Field:
    forms: dict[str, int]
    weights: np.ndarray  # of the forms, for the toxic state
    bias: float = 0.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def emission(self, words: list[str]) -> np.ndarray:
        """Score of the toxic state over the clean one, per word."""
        get = self.forms.get
        return np.array([self.bias + sum(self.weights[i] for i in map(get, word_forms(w)) if i is not None) for w in words])

    def score(self, top: np.ndarray, mass: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * top + c * np.log1p(mass), -30, 30)))


def marginals(emission: np.ndarray, counts: np.ndarray, steps: np.ndarray, block: int = 64) -> np.ndarray:
    """Probability of the toxic state of every word; texts lie one after the other, ``counts`` words each.

    Exact, in blocks: the messages through a block of words are 2 x 2 products, worked out for all blocks of all texts at
    once; then blocks are chained per text, and messages are filled in inside all blocks at once.
    """
    n = len(emission)
    if not n:
        return np.zeros(0)
    blocks = -(-counts // block)
    first = np.cumsum(blocks) - blocks  # of each text, among all blocks
    total = int(blocks.sum())
    text_of = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    row, column = first[text_of] + inside // block, inside % block
    grid = np.zeros((block, total))
    grid[column, row] = np.clip(emission, -30, 30)
    real = np.zeros((block, total), bool)
    real[column, row] = True
    half = np.exp(grid / 2)
    e = np.stack([1 / half, half])  # e[state, place, block]
    t = np.exp(steps)
    starts = np.zeros(total, bool)
    starts[first[counts > 0]] = True

    def times(p, place):  # rows of p: state before the block; columns: state of the word at this place
        new = np.stack([np.stack([(p[a, 0] * t[0, s] + p[a, 1] * t[1, s]) * e[s, place] for s in (0, 1)]) for a in (0, 1)])
        new /= new.max(axis=(0, 1))
        return np.where(real[place], new, p)

    product = np.zeros((2, 2, total))
    product[0, 0] = product[1, 1] = 1.0
    # the first word of a text has no step before it
    product[:, :] = np.where(starts, np.stack([np.stack([e[0, 0], e[1, 0]])] * 2), np.stack([np.stack([t[a, s] * e[s, 0] for s in (0, 1)]) for a in (0, 1)]))
    for place in range(1, block):
        product = times(product, place)
    entry, leave = np.ones((2, total)), np.ones((2, total))  # messages into a block from the left and from the right
    depth = int(blocks.max(initial=0))
    for k in range(1, depth):
        b = first[blocks > k] + k
        m = np.stack([entry[0, b - 1] * product[0, s][b - 1] + entry[1, b - 1] * product[1, s][b - 1] for s in (0, 1)])
        entry[:, b] = m / m.max(axis=0)
    for k in range(depth - 2, -1, -1):
        b = first[blocks > k + 1] + k
        m = np.stack([product[a, 0][b + 1] * leave[0, b + 1] + product[a, 1][b + 1] * leave[1, b + 1] for a in (0, 1)])
        leave[:, b] = m / m.max(axis=0)
    ahead = np.zeros((2, block, total))
    state = np.where(starts, e[:, 0], np.stack([(entry[0] * t[0, s] + entry[1] * t[1, s]) * e[s, 0] for s in (0, 1)]))
    ahead[:, 0] = state / state.max(axis=0)
    for place in range(1, block):
        p = ahead[:, place - 1]
        m = np.stack([(p[0] * t[0, s] + p[1] * t[1, s]) * e[s, place] for s in (0, 1)])
        ahead[:, place] = np.where(real[place], m / m.max(axis=0), p)
    behind = leave
    out = np.zeros((block, total))
    for place in range(block - 1, -1, -1):
        a = ahead[:, place] * behind
        out[place] = a[1] / (a[0] + a[1])
        m = np.stack([t[s, 0] * e[0, place] * behind[0] + t[s, 1] * e[1, place] * behind[1] for s in (0, 1)])
        behind = np.where(real[place], m / m.max(axis=0), behind)
    return out[column, row]


def _train_field(forms: dict[str, int], windows: list[tuple[list[list[int]], list[int]]], rounds: int = 120) -> Field:
    """Maximum likelihood with a small ridge, by Adam; windows are of one length."""
    f = Field(forms, np.zeros(len(forms)))
    if not windows:
        f.bias = -6.0
        return f
    size = len(windows[0][1])
    y = np.array([w[1] for w in windows])
    ids = np.full((len(windows), size, 4), len(forms))
    for i, (rows, _) in enumerate(windows):
        for j, r in enumerate(rows):
            ids[i, j, :len(r)] = r
    theta = np.zeros(len(forms) + 1 + 1 + 4)  # forms, none, bias, steps
    theta[-5] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    flat = ids.reshape(-1)
    for step in range(1, rounds + 1):
        theta[len(forms)] = 0.0
        em = theta[ids].sum(2) + theta[-5]
        a = np.stack([-em / 2, em / 2], 2)
        t = theta[-4:].reshape(2, 2)
        la, lb = np.zeros_like(a), np.zeros_like(a)
        la[:, 0] = a[:, 0]
        for k in range(1, size):
            la[:, k] = np.logaddexp(la[:, k - 1, :1] + t[0], la[:, k - 1, 1:] + t[1]) + a[:, k]
        for k in range(size - 2, -1, -1):
            nxt = a[:, k + 1] + lb[:, k + 1]
            lb[:, k] = np.logaddexp(t[:, 0] + nxt[:, :1], t[:, 1] + nxt[:, 1:])
        z = np.logaddexp(la[:, -1, 0], la[:, -1, 1])
        p1 = np.exp(la[:, :, 1] + lb[:, :, 1] - z[:, None])
        off = y - p1
        g = np.zeros_like(theta)
        np.add.at(g, flat, np.repeat(off.reshape(-1), 4))
        g[-5] = off.sum()
        for s in (0, 1):
            for u in (0, 1):
                pair = np.exp(la[:, :-1, s] + t[s, u] + a[:, 1:, u] + lb[:, 1:, u] - z[:, None])
                g[-4 + 2 * s + u] = ((y[:, :-1] == s) & (y[:, 1:] == u)).sum() - pair.sum()
        g = g / len(windows) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    f.weights, f.bias, f.steps = theta[:len(forms)], float(theta[-5]), theta[-4:].reshape(2, 2)
    return f


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve over (1, largest marginal, log of the sum), ridge 0.1, by Newton steps."""
    base = (y.sum() + 1) / (len(y) + 2)
    w = np.array([np.log(base / (1 - base)), 0.0, 0.0])
    if 0 < y.sum() < len(y):
        d = np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x[:, 1])])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            change = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + 0.1 * np.eye(3), d.T @ (y - p) - 0.1 * w)
            w = w + np.clip(change, -5, 5)
            if np.abs(change).max() < 1e-6:
                break
    return tuple(map(float, w))


def train(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, least_docs: int = 5, odds: float = 8.0, windows: int = WINDOWS,
) -> Field:
    """Field and curve from at most ``rows`` labelled documents (labels: doc_id and toxic; NULLs are left out).

    Of rows with one id the one with the least text hash is learned from.  Every document gives ``windows`` windows, drawn by
    its hash around any of its marked words (any word, if it has none).  What reaches the driver is bounded by ``rows``:
    their windows, two numbers each, and word forms that stand in ``least_docs`` of their toxic texts.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
        .withColumn("__order", hash60(F.col("doc_id").cast("string"))).orderBy("__order", "doc_id").limit(rows)
        .select(F.col("doc_id").alias("__known"), "__toxic", "__order")
    )
    sample = docs.join(F.broadcast(staged(known, "toxic-labels")), F.col("doc_id") == F.col("__known"))
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"]
    sample = sample.groupBy("__order", "doc_id", F.col("__toxic").cast("int").alias("__toxic")).agg(one.alias("text"))
    sample = staged(sample, "toxic-sample")

    def count(batches):
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(toxic > 0)].update({f for w in set((text or "").split()) for f in word_forms(w)})
            forms = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array([seen[1][f] for f in forms], pa.int64()), pa.array([seen[0][f] for f in forms], pa.int64())], names=["form", "toxic", "clean"])

    both = sample.agg(F.sum("__toxic").alias("toxic"), F.sum(1 - F.col("__toxic")).alias("clean")).first()
    n_toxic, n_clean = both["toxic"] or 0, both["clean"] or 0
    ratio = ((F.col("toxic") + 0.1) / (n_toxic + 0.2)) / ((F.col("clean") + 0.1) / (n_clean + 0.2))
    marks = (
        sample.select("__toxic", "text").mapInArrow(count, "form string, toxic bigint, clean bigint")
        .groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= least_docs).withColumn("ratio", ratio).filter(F.col("ratio") >= odds)
        .orderBy(F.desc(F.col("toxic") * F.log("ratio")), "form").collect()
    )
    forms = {r["form"]: i for i, r in enumerate(sorted(marks, key=lambda r: r["form"]))}

    def cut(batches):
        for batch in batches:
            out = []
            for order, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").split()
                ids = [[forms[f] for f in word_forms(w) if f in forms][:4] for w in words]
                marked = [i for i, x in enumerate(ids) if x]
                places = marked or list(range(len(words)))
                draws = np.random.default_rng(order).permutation(len(places))[:windows]
                for c in sorted(places[d] for d in draws):
                    span = range(c - REACH, c + REACH + 1)
                    inner = [ids[i] if 0 <= i < len(ids) else [] for i in span]
                    out.append((order, c, inner, [int(bool(x) and toxic > 0) for x in inner]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, (pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32())))],
                names=["order", "centre", "ids", "y"])

    rows_in = sample.select("__order", "__toxic", "text")
    got = rows_in.mapInArrow(cut, "order bigint, centre int, ids array<array<int>>, y array<int>").orderBy("order", "centre").collect()
    f = _train_field(forms, [(r["ids"], r["y"]) for r in got])
    sums = sample.mapInArrow(_summer(f), "order bigint, toxic int, top double, mass double").orderBy("order").collect()
    x, y = np.array([[r["top"], r["mass"]] for r in sums]).reshape(-1, 2), np.array([r["toxic"] for r in sums])
    f.curve = _fit_curve(x, y)
    return f


class _Words:
    """Emissions of the words a worker has met."""

    def __init__(self, f: Field):
        self.field, self.words, self.values = f, pa.array([], pa.large_string()), np.zeros(0)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends = np.asarray(pieces.offsets).astype(np.int64)
        counts = np.diff(ends - ends[0]) if len(ends) else np.zeros(0, np.int64)
        flat = pieces.flatten()
        coded = flat.dictionary_encode()
        if len(self.words) > KNOWN_WORDS:
            self.words, self.values = self.words.slice(0, 0), np.zeros(0)
        where = pc.index_in(coded.dictionary, value_set=self.words)
        if where.null_count:
            new = coded.dictionary.filter(pc.is_null(where))
            self.words = pa.concat_arrays([self.words, new])
            self.values = np.concatenate([self.values, self.field.emission(new.to_numpy(zero_copy_only=False).tolist())])
            where = pc.index_in(coded.dictionary, value_set=self.words)
        if not len(flat):
            return np.zeros(0), counts, flat
        return self.values[np.asarray(where).astype(np.int64)][np.asarray(coded.indices)], counts, flat


def _sums(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value and sum per text; 0 for texts without words."""
    top, mass = np.zeros(len(counts)), np.zeros(len(counts))
    some = counts > 0
    if some.any():
        at = (np.cumsum(counts) - counts)[some]
        top[some], mass[some] = np.maximum.reduceat(p, at), np.add.reduceat(p, at)
    return top, mass


def _summer(f: Field):
    def run(batches):
        words = _Words(f)
        for batch in batches:
            emission, counts, _ = words(batch.column(3))
            top, mass = _sums(marginals(emission, counts, f.steps), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(top), pa.array(mass)], names=["order", "toxic", "top", "mass"])
    return run


def score(docs: DataFrame, f: Field, least: float = 0.5) -> DataFrame:
    """(doc_id, score, spans) of every row; spans are (start, end, marginal) in code points, of words with a marginal of
    at least ``least``.  NULL and empty texts and repeated rows are scored like any other; extra columns are not read."""
    def run(batches):
        words = _Words(f)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                emission, counts, flat = words(batch.column(1))
                p = marginals(emission, counts, f.steps)
                top, mass = _sums(p, counts)
                spans: list[list] = [[] for _ in counts]
                starts = np.cumsum(counts) - counts
                for i in np.flatnonzero(top >= least):
                    text, place = batch.column(1)[int(i)].as_py(), 0
                    for k, word in enumerate(flat.slice(int(starts[i]), int(counts[i])).to_pylist()):
                        place = text.index(word, place)
                        if p[starts[i] + k] >= least:
                            spans[i].append({"start": place, "end": place + len(word), "marginal": float(p[starts[i] + k])})
                        place += len(word)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f.score(top, mass)), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double, spans array<struct<start:int,end:int,marginal:double>>"
    )
