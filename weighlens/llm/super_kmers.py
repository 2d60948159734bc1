"""Substring dedup by super-k-mers: which windows of WINDOW words also start in a document with a smaller id.

A window's minimiser is the least hash of its runs of GRAM words.  Consecutive windows with the same minimiser are one
super-k-mer: they travel together as the string of their words to the bucket of the minimiser, to which every other copy of
these windows comes too.  There the windows are sorted by hash, equal hashes are compared byte by byte, and each distinct
window gets the smallest id it starts in; words of windows that start in a smaller id than their own are reported as ranges.

What a task sends is combined first: a string that many of its documents hold is sent once with all its places, and the
strings of a bucket are packed and compressed as one row.  Minimisers met far more often than others (a frequent line or
phrase) are found from counts over all windows by slots of the hash; their windows are dealt one by one by the hash of the
whole window, so that no bucket grows with the frequency of a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from weighlens.llm.common import staged
from weighlens.llm.fill_in_middle import slices
from weighlens.llm.groups import whole_groups
from weighlens.llm.words import mixed, ngram_hashes

WINDOW, GRAM = 13, 3
SLICE_BYTES = 4 << 20  # of text worked on at once; needs about 40 times as much memory
SEND_BYTES = 32 << 20  # of strings that a task combines before it sends them
BUCKET_WINDOWS = 250_000  # windows of a bucket on average
SLOTS = 1 << 16

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers = {_BASE: np.ones(1, np.uint64), _BACK: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n (mod 2 ** 64)."""
    if len(_powers[base]) <= n:
        steps = np.full(max(n + 1, SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base]


class _Bytes:
    """Hashes of any stretch of some bytes: equal stretches have equal hashes wherever they lie."""

    def __init__(self, octets: np.ndarray):
        self.octets = octets
        self.upto = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum(_BYTES[octets] * _power(_BASE, len(octets))[: len(octets)], out=self.upto[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.upto[end] - self.upto[start]) * _power(_BACK, len(self.octets))[start] + (end - start).astype(np.uint64))

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
        """Whether the stretches of these sizes from a and from b on are equal, each with each."""
        ends, at = np.cumsum(size), 0
        while at < len(size):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            many = size[at:stop]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            if not np.array_equal(self.octets[np.repeat(a[at:stop], many) + inside], self.octets[np.repeat(b[at:stop], many) + inside]):
                return False
            at = stop
        return True


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, words per text): the words of all texts, unchanged, with one space behind each."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    octets = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    offsets = offsets - offsets[0]
    solid = (octets != 0x20) & ((octets < 0x09) | (octets > 0x0D))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[edges] = solid[edges]
    at = np.flatnonzero(begins)
    words = np.diff(np.searchsorted(at, offsets))
    word = np.cumsum(begins[solid])  # of every byte kept, from 1 on
    out = np.full(len(word) + len(at), 0x20, np.uint8)
    place = np.arange(len(word)) + word - 1
    out[place] = octets[solid]
    sizes = np.bincount(word, minlength=len(at) + 1)[1:]
    ends = np.cumsum(sizes + 1) - 1
    return out, ends - sizes, ends, words


def minimisers(words: np.ndarray) -> np.ndarray:
    """The least gram hash of the window from each word on."""
    low, span = ngram_hashes(words, GRAM), 1
    wanted = WINDOW - GRAM + 1
    if len(words) < WINDOW:
        return np.zeros(0, np.uint64)
    while span * 2 <= wanted:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    rest = wanted - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


class _Strings:
    """The super-k-mers of some texts: byte range, text, first word, windows and minimiser of each."""

    def __init__(self, texts: pa.Array, slots: int, hot: np.ndarray):
        octets, starts, ends, counts = spaced(texts)
        self.bytes = _Bytes(octets)
        low = minimisers(self.bytes.hashes(starts, ends))
        text = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(text[: len(low)] == text[WINDOW - 1:]) if len(low) else np.zeros(0, np.int64)
        low = low[at]
        self.single = np.isin(slot_of(low, slots), hot)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | self.single[1:]
        first = np.flatnonzero(new)
        self.windows = np.diff(np.append(first, len(at)))
        self.low, self.single, at = low[first], self.single[first], at[first]
        self.text, self.word = text[at], at - (np.cumsum(counts) - counts)[text[at]]
        self.start, self.end = starts[at], ends[at + self.windows + WINDOW - 2]
        self.hash = self.bytes.hashes(self.start, self.end)

    def buckets(self, n: int) -> np.ndarray:
        return (mixed(np.where(self.single, self.hash, self.low) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n)).astype(np.int64)


def slot_of(low: np.ndarray, slots: int) -> np.ndarray:
    return (mixed(low) % np.uint64(slots)).astype(np.int64)


def _slot_counts(slots: int):
    """Windows per slot, a string that a slice of texts holds several times once."""
    def run(batches):
        for whole in batches:
            counts = np.zeros(slots, np.int64)
            for begin, end in slices(whole.column(1), SLICE_BYTES):
                s = _Strings(whole.column(1).slice(begin, end - begin), slots, np.zeros(0, np.int64))
                _, one = np.unique(s.hash, return_index=True)
                np.add.at(counts, slot_of(s.low[one], slots), s.windows[one])
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["slot", "windows"])
    return run


_ZSTD = pa.Codec("zstd", 3)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, byte plane after byte plane: high planes are mostly zero."""
    raw = b"".join(a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> bytes:
    return _ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _planes(raw: bytes, at: int, n: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(dtype).reshape(n)


def _blobs(held: list[tuple], n_buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, strings, places) of strings held: equal strings once, with all their places."""
    texts = [t for part in held for t in part[0]]
    bucket, name, doc, twin, word = (np.concatenate([part[i] for part in held]) for i in range(1, 6))
    order = np.lexsort((doc, name, bucket))
    bucket, name, doc, twin, word = (x[order] for x in (bucket, name, doc, twin, word))
    new = np.ones(len(order), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (name[1:] != name[:-1])
    for i in np.flatnonzero(~new):  # equal hashes: one string, unless the bytes differ
        new[i] = texts[order[i]] != texts[order[i - 1]]
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(order))).astype(np.uint32)
    begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for a, b in zip(begins, np.append(begins[1:], len(order))):
        x, y = np.searchsorted(first, [a, b])
        strings = b"".join(texts[i] for i in order[first[x:y]].tolist())
        sizes = np.array([y - x, b - a], np.uint32)
        yield int(bucket[a]), _packed(np.frombuffer(strings, np.uint8)), _packed(sizes, many[x:y], doc[a:b], twin[a:b], word[a:b])


def _send(n_buckets: int, slots: int, hot: np.ndarray):
    """Rows (bucket, strings, places) of a task's documents."""
    def rows(held):
        out, size = [], 0
        for row in _blobs(held, n_buckets):
            out.append(row)
            size += len(row[1]) + len(row[2])
            if size > SLICE_BYTES:
                yield out
                out, size = [], 0
        yield out

    def batch(some):
        columns = list(zip(*some)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "strings", "places"])

    def run(batches):
        held, size = [], 0
        for whole in batches:
            ids, twins = (np.asarray(whole.column(i)) for i in (0, 2))
            for begin, end in slices(whole.column(1), SLICE_BYTES):
                s = _Strings(whole.column(1).slice(begin, end - begin), slots, hot)
                if not len(s.text):
                    continue
                octets = s.bytes.octets.copy()
                octets[s.end] = 0x20
                octets = octets.tobytes()
                texts = [octets[a:b] + b"\n" for a, b in zip(s.start.tolist(), s.end.tolist())]
                row = s.text + begin
                held.append((texts, s.buckets(n_buckets), s.hash, ids[row].astype(np.int64), twins[row].astype(np.uint32), s.word.astype(np.uint32)))
                size += int((s.end - s.start).sum())
                if size > SEND_BYTES:
                    yield from map(batch, rows(held))
                    held, size = [], 0
        if held:
            yield from map(batch, rows(held))
    return run


def window_lows(octets: np.ndarray, owner_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string of each window, smallest id it starts in) of a bucket's strings, which end in a line feed each.

    ``owner_low`` has the smallest id of every string."""
    ends = np.flatnonzero((octets == 0x20) | (octets == 0x0A))
    starts = np.concatenate([[0], ends[:-1] + 1])
    string = np.cumsum(octets[ends] == 0x0A) - (octets[ends] == 0x0A)
    at = np.flatnonzero(string[: len(string) - WINDOW + 1] == string[WINDOW - 1:])
    start, end, string = starts[at], ends[at + WINDOW - 1], string[at]
    data = _Bytes(octets)
    name = data.hashes(start, end)
    order = np.argsort(name, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = name[order[1:]] != name[order[:-1]]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    rest = ~new
    a, b = order[rest], head[rest]
    if not (np.array_equal(end[a] - start[a], end[b] - start[b]) and data.same(start[a], start[b], end[a] - start[a])):
        raw, names = octets.tobytes(), {}  # two windows share a hash: go by the words themselves
        name = np.array([names.setdefault(raw[x:y], len(names)) for x, y in zip(start.tolist(), end.tolist())])
        order = np.argsort(name, kind="stable")
        new[1:] = name[order[1:]] != name[order[:-1]]
    begins = np.flatnonzero(new)
    least = np.minimum.reduceat(owner_low[string[order]], begins) if len(begins) else np.zeros(0, np.int64)
    low = np.empty(len(order), np.int64)
    low[order] = least[np.cumsum(new) - 1]
    return string, low


def _ranges_of(strings: list[bytes], places: list[bytes]) -> tuple[np.ndarray, ...]:
    """(id, twin, first word, word behind the last) of repeated stretches of one bucket."""
    octets = np.frombuffer(b"".join(_unpacked(x) for x in strings), np.uint8)
    parts = []
    for raw in map(_unpacked, places):
        n, m = (int(x) for x in _planes(raw, 0, 2, np.uint32))
        at, part = 8, []
        for size, dtype in ((n, np.uint32), (m, np.int64), (m, np.uint32), (m, np.uint32)):
            part.append(_planes(raw, at, size, dtype).astype(np.int64))
            at += size * np.dtype(dtype).itemsize
        parts.append(part)
    many, doc, twin, word = (np.concatenate(x) for x in zip(*parts))
    begins = np.cumsum(many) - many
    owner_low = np.minimum.reduceat(doc, begins)
    string, low = window_lows(octets, owner_low)
    windows = np.bincount(string, minlength=len(many))
    of = np.repeat(np.arange(len(many)), many)
    later = np.flatnonzero(doc > owner_low[of])  # the whole string starts in a smaller id
    out = [(doc[later], twin[later], word[later], word[later] + windows[of[later]] + WINDOW - 1)]
    at = np.flatnonzero(low < owner_low[string])
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (string[at[1:]] != string[at[:-1]])
        first, last = at[new], at[np.append(new[1:], True)]
        inside = first - (np.cumsum(windows) - windows)[string[first]]
        size = last - first + WINDOW
        least = np.flatnonzero(doc == owner_low[of])
        some = np.bincount(of[least], minlength=len(many))
        run = np.repeat(np.arange(len(first)), some[string[first]])
        nth = np.arange(len(run)) - np.repeat(np.cumsum(some[string[first]]) - some[string[first]], some[string[first]])
        who = least[(np.cumsum(some) - some)[string[first[run]]] + nth]
        begin = word[who] + inside[run]
        out.append((doc[who], twin[who], begin, begin + size[run]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _count(batches):
    for table, begins in whole_groups(batches, ["bucket"]):
        strings, places = table.column("strings").combine_chunks(), table.column("places").combine_chunks()
        for a, b in zip(begins.tolist(), np.append(begins[1:], table.num_rows).tolist()):
            doc, twin, begin, end = _ranges_of(strings[a:b].to_pylist(), places[a:b].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, twin, begin, end)], names=["doc_id", "twin", "begin", "end"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, twin, begin, end): stretches of words of windows that also start in a smaller id.  Ranges of a document may
    touch or overlap; twin is the CRC-32 of its text, which tells rows with one id apart."""
    spark = docs.sparkSession
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _twin().alias("twin"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(SLOTS, 1 << (16 * tasks).bit_length())
    counts = staged(docs.mapInArrow(_slot_counts(slots), "slot bigint, windows bigint").groupBy("slot").agg(F.sum("windows").alias("windows")), "slots")
    total = counts.agg(F.sum("windows")).first()[0] or 0
    hot = [r["slot"] for r in counts.filter(F.col("windows") > total / (4 * tasks)).collect()]  # fewer than 4 * tasks
    n = max(4 * tasks, -(-total // BUCKET_WINDOWS))
    sent = docs.mapInArrow(_send(n, slots, np.array(hot, np.int64)), "bucket bigint, strings binary, places binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count, "doc_id bigint, twin bigint, begin bigint, end bigint")


def _twin():
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def _kept(batches):
    for whole in batches:
        for a, b in slices(whole.column("text"), SLICE_BYTES):
            batch = whole.slice(a, b - a)
            octets, starts, ends, counts = spaced(batch.column("text"))
            ranges = batch.column("ranges")
            row, pair = np.asarray(pc.list_parent_indices(ranges)), pc.list_flatten(ranges)
            first = np.cumsum(counts) - counts
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, first[row] + np.asarray(pair.field(0)), 1)
            np.add.at(cover, first[row] + np.asarray(pair.field(1)), -1)
            stay = np.cumsum(cover)[:-1] == 0
            text = np.repeat(np.arange(len(counts)), counts)
            left = np.bincount(text[stay], minlength=len(counts))
            mask = np.repeat(stay, ends - starts + 1)
            at = np.flatnonzero(stay)
            closing = at[np.append(text[at[1:]] != text[at[:-1]], True)] if len(at) else at
            mask[ends[closing]] = False  # no space behind the last word kept
            size = np.bincount(np.repeat(text, ends - starts + 1)[mask], minlength=len(counts))
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            kept = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(octets[mask].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array((counts - left).astype(np.int64)), kept.cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])


def drop_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id and text; other columns are not read).

    Words are parted by ASCII white space and compared as they are.  A word goes if a window of 13 words that covers it also
    starts in a row with a smaller doc_id; windows are judged on the input, so of equal texts the one with the smallest id
    stays whole.  ``kept`` is the words that stay, joined by one space.  NULL and empty texts have no words, texts of fewer
    than 13 words lose none.  Rows with a NULL id lose nothing and take nothing from others.  Rows that share an id take
    nothing from each other, and each is cut by its own text; repeated rows give repeated results.  An empty table gives none.
    """
    ranges = staged(repeated_ranges(docs), "repeated-ranges")
    grouped = ranges.groupBy(F.col("doc_id").alias("__id"), F.col("twin").alias("__twin")).agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _twin().alias("twin"))
    rows = rows.join(grouped, (F.col("doc_id") == F.col("__id")) & (F.col("twin") == F.col("__twin")), "left")
    return rows.select("doc_id", "text", "ranges").mapInArrow(_kept, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
