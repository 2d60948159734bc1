"""Token ids as binary blocks: frequency-ranked ids in byte-aligned variable-length coding.

Documents are range-partitioned and sorted by id, and every partition writes blocks of about ``block_bytes`` of text.
A block ranks its token ids by frequency (its ``ranks`` column lists the ids by rank).  A rank takes 1 to 4 bytes in
``data``; the lengths stand apart in ``control``, two bits each, four to a byte.  Decoding is numpy table lookup: a table
of 256 x 4 lengths turns control bytes into lengths, ``ranks`` turns ranks back into ids.  Blocks are rows of Parquet
files, so they are committed and retried by Spark as any other table, and each can be decoded by itself.

Words repeat far more often than they are new, so a worker encodes each distinct word once with the tokenizer and keeps
its ids; of too many words it keeps those met most often.  Texts are cut into words only where the tokenizer's own splitting cuts too: before a space or line feed between
characters that are not white space.  Texts with longer runs of white space are encoded whole.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain
from operator import attrgetter
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from weighlens.llm.common import staged
from weighlens.storage import shared_dir

END_ID = 2
BLOCK_BYTES = 4 << 20
KNOWN_WORDS = 500_000  # beyond this many a worker keeps the half that it met most often

_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUN = _WHITE + _WHITE

# byte-level models write a byte as the sign of that number where it is printable, else as the next sign from 256 on
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SIGNS = np.array([ord(_BYTE_SIGNS.get(b, chr(b))) for b in range(256)], "<u4")
_LINE_FEED = _BYTE_SIGNS[10]

_token_id = attrgetter("id")
_MERGED_AT_ONCE = 500  # words whose tokens are held as objects


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of lists of ids."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))


def _spans(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of a table, one after the other."""
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    at += np.arange(len(at))
    return table[at]


class WordEncoder:
    """Token ids of whole texts, by way of their distinct words."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.merge = self.tokenizer.model.tokenize
        self.line_feed = self._ids(["\n"])[0][0]
        # an apostrophe may belong to the letters behind it, and signs of added tokens to such a token
        added = "".join(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = "".join(x for x in punctuation if x != "'" and x not in added)
        self._forget()

    def _forget(self) -> None:
        # an Arrow array of words takes a tenth of the room of a dictionary of Python strings
        self.words = pa.array([], pa.large_string())
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.met = np.zeros(0, np.uint32)  # blocks that had the word

    def _forget_rare(self) -> None:
        """Keep the words met most often; what they were met before counts half from now on."""
        kept = np.sort(np.argsort(self.met, kind="stable")[-(KNOWN_WORDS // 2):])
        self.ids = _spans(self.ids, self.starts[kept], self.sizes[kept])
        self.words, self.sizes, self.met = self.words.take(pa.array(kept)), self.sizes[kept], self.met[kept] // 2
        self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letter_ids(self, words: list[str], before: str = " ") -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of runs of letters: each is one word to the tokenizer too, so its model merges it at once."""
        raw = np.frombuffer((before + f"\n{before}".join(words)).encode(), np.uint8)
        signs = _SIGNS[raw].tobytes().decode("utf-32-le").split(_LINE_FEED)
        sizes, ids = np.empty(len(words), np.int64), []
        for i in range(0, len(signs), _MERGED_AT_ONCE):
            found = list(map(self.merge, signs[i:i + _MERGED_AT_ONCE]))
            sizes[i:i + len(found)] = np.fromiter(map(len, found), np.int64, len(found))
            ids.append(np.fromiter(map(_token_id, chain.from_iterable(found)), np.uint32))
        return sizes, np.concatenate(ids)

    def _word_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of pieces: a piece stands for itself behind a space, or for itself if it begins with a line feed."""
        starts, sizes, ids = self._coded(words)
        return [ids[i:i + n].tolist() for i, n in zip(starts, sizes)]

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, sizes, ids) of distinct pieces.

        Marks behind a letter or digit are a word of their own to the tokenizer, and so is a line feed before letters: the
        word without them is encoded, and ids of the marks are put behind its own.
        """
        stems = {w: x for w in words if (x := w.rstrip(self.marks)) is not w and x[-1:].isalnum()}
        plain = dict.fromkeys(w for w in words if w not in stems) | dict.fromkeys(stems.values())
        letters, lines, rest = [], [], []
        for w in plain:
            (letters if w.isalpha() else lines if w[0:1] == "\n" and w[1:].isalpha() else rest).append(w)
        found = []
        if letters:
            found.append(self._letter_ids(letters))
        if lines:
            sizes, ids = self._letter_ids([w[1:] for w in lines], "")
            found.append((sizes + 1, np.insert(ids, np.cumsum(sizes) - sizes, self.line_feed)))
        if rest:
            found.append(_flat(self._ids([w if w[:1] == "\n" else " " + w for w in rest])))
        place = dict(zip(chain(letters, lines, rest, stems), range(len(plain) + len(stems))))
        sizes, ids = (np.concatenate(x) for x in zip(*found))
        starts = np.cumsum(sizes) - sizes
        if stems:
            marks = [w[len(x):] for w, x in stems.items()]
            kinds = dict.fromkeys(marks)
            mark_sizes, mark_ids = _flat(self._ids(list(kinds)))
            kinds = dict(zip(kinds, range(len(kinds))))
            kind = np.fromiter(map(kinds.__getitem__, marks), np.int64, len(marks))
            at = np.fromiter(map(place.__getitem__, stems.values()), np.int64, len(stems))
            # word, marks, word, marks ...
            pair_starts = np.column_stack([starts[at], len(ids) + (np.cumsum(mark_sizes) - mark_sizes)[kind]])
            pair_sizes = np.column_stack([sizes[at], mark_sizes[kind]])
            ids = np.append(ids, mark_ids)
            stem_ids, stem_sizes = _spans(ids, pair_starts.reshape(-1), pair_sizes.reshape(-1)), pair_sizes.sum(axis=1)
            starts = np.append(starts, len(ids) + np.cumsum(stem_sizes) - stem_sizes)
            sizes, ids = np.append(sizes, stem_sizes), np.append(ids, stem_ids)
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        return starts[at], sizes[at], ids

    def _learn(self, new: pa.Array) -> None:
        """Add the ids of new pieces."""
        starts, sizes, ids = self._coded(new.to_numpy(zero_copy_only=False).tolist())  # much faster than to_pylist()
        self.words = pa.concat_arrays([self.words, new])
        self.starts, self.sizes = np.append(self.starts, len(self.ids) + starts), np.append(self.sizes, sizes.astype(np.int32))
        self.ids, self.met = np.append(self.ids, ids), np.append(self.met, np.ones(len(new), np.uint32))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with the end id; ids per text)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.asarray(pc.match_substring_regex(texts, _RUN))
        plain = pc.if_else(pa.array(~whole), texts, "")
        pieces = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        firsts = np.asarray(pieces.offsets)[:-1].astype(np.int64)
        firsts -= firsts[0] if len(firsts) else 0
        flat = pieces.flatten()
        if len(self.words) > KNOWN_WORDS:
            self._forget_rare()
        coded = flat.dictionary_encode()
        # the known words are looked up in the block's, which are fewer: a table of all known ones would take longer to build
        found = pc.index_in(self.words, value_set=coded.dictionary)
        here = np.asarray(pc.is_valid(found))
        self.met += here
        index = np.full(len(coded.dictionary), -1)
        index[np.asarray(found.drop_null())] = np.flatnonzero(here)
        unknown = index < 0
        if unknown.any():
            index[unknown] = len(self.words) + np.arange(unknown.sum())
            self._learn(coded.dictionary.filter(pa.array(unknown)))
        index = index[np.asarray(coded.indices)]
        # first pieces have no space before them
        first_ids = self._ids(pc.if_else(pa.array(whole), texts, flat.take(pa.array(firsts))).to_pylist())
        own, own_ids = _flat(first_ids)
        table = np.concatenate([self.ids, own_ids, np.array([END_ID], np.uint32)])
        starts, sizes = self.starts[index], self.sizes[index]
        starts[firsts], sizes[firsts] = len(self.ids) + np.cumsum(own) - own, own
        # the end id follows each text's last piece
        ends = np.append(firsts[1:], len(flat))
        starts, sizes = np.insert(starts, ends, len(table) - 1), np.insert(sizes, ends, 1)
        ids = _spans(table, starts, sizes)
        counts = np.add.reduceat(sizes, firsts + np.arange(len(firsts)), dtype=np.int64) if len(firsts) else np.zeros(0, np.int64)
        return ids, counts


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranks, control, data) of token ids."""
    found, place, counts = np.unique(ids, return_inverse=True, return_counts=True) if len(ids) < 1 << 16 else _unique_small(ids)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(found), np.uint32)
    rank[order] = np.arange(len(found), dtype=np.uint32)
    values = rank[place]
    extra = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    control = np.append(extra, np.zeros(-len(extra) % 4, np.uint8)).reshape(-1, 4)
    control = (control << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    at = np.cumsum(extra, dtype=np.int64)
    at += np.arange(len(at))
    at -= extra
    data = np.empty(int(at[-1]) + int(extra[-1]) + 1 if len(ids) else 0, np.uint8)
    data[at] = values & 255
    for more in range(1, 1 + int(extra.max(initial=0))):
        longer = extra >= more
        data[at[longer] + more] = values[longer] >> 8 * more & 255
    return found[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def _unique_small(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As np.unique, by counting: token ids are below the vocabulary size."""
    counts = np.bincount(ids)
    found = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.uint32)
    place[found] = np.arange(len(found))
    return found, place[ids], counts[found]


def decode_block(n: int, ranks: bytes, control: bytes, data: bytes) -> np.ndarray:
    """The n token ids of a block."""
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    raw = np.frombuffer(data, np.uint8)
    values = raw[at].astype(np.uint32)
    for more in range(1, int(sizes.max(initial=1))):
        longer = sizes > more
        values[longer] |= raw[at[longer] + more].astype(np.uint32) << np.uint32(8 * more)
    return np.frombuffer(ranks, "<u4")[values]


_ENCODERS: dict[str, WordEncoder] = {}  # of this worker


def _encoder(tokenizer_file: str) -> WordEncoder:
    """The worker's own, kept from task to task: tasks get this function by name, but a copy of any table they name themselves."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


_BLOCK = "part int, block int, doc_ids array<bigint>, n_tokens array<bigint>, n bigint, ranks binary, control binary, data binary"


def write_token_files(
    docs: DataFrame, tokenizer_file: str, path: str, text: str = "text", row_id: str = "doc_id", block_bytes: int = BLOCK_BYTES,
) -> None:
    """Encode every whole text, append the end id, write blocks in ascending id order.

    NULL texts are empty (only the end id); NULL ids come first; rows with equal ids follow each other, by text.  A text
    larger than ``block_bytes`` is a block of its own.  An empty table writes no block.  Other columns are not read.
    """
    def encode(batches):
        coder = _encoder(tokenizer_file)
        part, number = TaskContext.get().partitionId(), 0

        def block(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            tokens, counts = coder.encode(texts)
            ranks, control, data = encode_block(tokens)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([len(tokens)], pa.int64()),
                *(pa.array([x], pa.binary()) for x in (ranks, control, data)),
            ], names=["part", "block", "doc_ids", "n_tokens", "n", "ranks", "control", "data"])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
            cut = 0
            while cut < len(sizes):
                held = np.cumsum(sizes[cut:])
                to = cut + max(1, int(np.searchsorted(held, block_bytes, side="right")))
                yield block(ids.slice(cut, to - cut), texts.slice(cut, to - cut))
                number, cut = number + 1, to
            # a worker outlives its tasks: what the batch took goes back to the system
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    ordered = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(encode, _BLOCK).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), and the ids themselves as such bytes if ``tokens``."""
    blocks = spark.read.schema(_BLOCK).parquet(path)

    def decode(batches):
        for batch in batches:
            for part, block, doc_ids, sizes, n, ranks, control, data in zip(*(c.to_pylist() for c in batch.columns)):
                raw = decode_block(n, ranks, control, data).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                slices = [raw[4 * (e - s):4 * e] for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(sizes), pa.int32()), pa.array([block] * len(sizes), pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(ends - np.array(sizes), pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x) for x in slices], pa.int64()), pa.array(slices if tokens else [None] * len(sizes), pa.binary()),
                ], names=["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"])

    rows = blocks.mapInArrow(decode, "part int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    before = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))  # one row per partition of the writer
    parts_before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        blocks.select("part", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("in_part"))
        .join(parts.select("part", F.coalesce(F.sum("n").over(parts_before), F.lit(0)).alias("of_part")), "part")
        .select("part", "block", (F.col("in_part") + F.col("of_part")).alias("of_block"))
    )
    return rows.join(staged(starts, "token-starts"), ["part", "block"]).select(
        "doc_id", (F.col("of_block") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if tokens else [])
    )


def token_round_trip(docs: DataFrame, tokenizer_file: str, tokens: bool = True) -> DataFrame:
    """Write token files into the shared folder and read them back."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer_file, path)
    return read_token_files(docs.sparkSession, path, tokens)
