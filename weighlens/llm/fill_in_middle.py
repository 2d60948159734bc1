"""Fill-in-the-middle examples: cut texts into units and move the middle to the end, a batch at a time.

A unit is a word with the white space before it, or the white space a text ends with.  A batch's texts become a list array
of units over the same bytes; the units are flattened with the number of their text, their ordinals compared with the two
cuts of the text give their role, and the units of each role are gathered into lists again and joined to one piece per text.
No step has a loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 16 << 20  # texts that are worked on at once; a longer text is a slice of its own

_EXAMPLE = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(first row, row behind the last) of runs of texts of about ``most_bytes`` at most."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield begin, end
        begin = end


def units(texts: pa.LargeStringArray) -> pa.LargeListArray:
    """The units of every text (none of them NULL), as slices of the texts' own bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    held = texts.buffers()[2] or pa.py_buffer(b"")
    octets = np.frombuffer(held, np.uint8)[: offsets[-1]]
    blank = (octets == 0x20) | ((octets >= 0x09) & (octets <= 0x0D))
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    begins[: offsets[0]] = False
    starts = np.flatnonzero(begins)
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, offsets[-1]).astype(np.int64)), held)
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, offsets)), flat)


def pieces(texts: pa.LargeStringArray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(units per text, [prefixes, middles, suffixes]); ``first`` and ``second`` are any whole numbers, whose remainders
    by units + 1 are the two cuts."""
    lists = units(texts)
    count = np.asarray(pc.list_value_length(lists))
    cuts = first % (count + 1), second % (count + 1)
    flat, parent = pc.list_flatten(lists), np.asarray(pc.list_parent_indices(lists))
    ordinal = np.arange(len(flat)) - (np.cumsum(count) - count)[parent]
    role = (ordinal >= np.minimum(*cuts)[parent]).astype(np.int8) + (ordinal >= np.maximum(*cuts)[parent])
    out = []
    for r in range(3):
        mine = role == r
        offsets = np.concatenate([[0], np.cumsum(np.bincount(parent[mine], minlength=len(count)))])
        out.append(pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(mine))), pa.scalar("", pa.large_string())))
    return count, out


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _joined(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*(_text(p) if isinstance(p, str) else p for p in parts), _text(""))


def _examples(rate: int, spm_rate: int):
    def run(batches):
        for whole in batches:
            for begin, end in slices(whole.column(1), SLICE_BYTES):
                batch = whole.slice(begin, end - begin)
                texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
                h1, h2, h3, h4 = (np.asarray(batch.column(i)) for i in range(2, 6))
                marked = pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
                plain = np.asarray(marked) | (h3 % 100 >= rate) | np.asarray(pc.equal(pc.binary_length(texts), 0))
                spm = h4 % 100 < spm_rate
                count, (prefix, middle, suffix) = pieces(texts, h1, h2)
                moved = pc.if_else(
                    pa.array(spm), _joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), _joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
                )
                chars = [pc.if_else(pa.array(plain), pa.scalar(None, pa.int64()), pc.utf8_length(p).cast(pa.int64())) for p in (prefix, middle)]
                form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(count.astype(np.int64)), form, *chars, pc.if_else(pa.array(plain), texts, moved).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )
    return run


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id and text; others are not read).

    Of 100 texts about ``rate`` are rearranged, and of these about ``spm_rate`` in 100 as suffix, prefix, middle (spm), the
    others as prefix, suffix, middle (psm), with a marker before each piece.  Draws are the first four 8-digit groups of the
    SHA-256 of ``seed:doc_id`` (a NULL id: nothing behind the colon): rows with one id have the same draws and are cut by
    their own text, repeated rows give repeated examples.  The first two, modulo units + 1, are the cuts; equal cuts leave an
    empty middle.  NULL and empty texts and texts that hold a marker stay plain, with NULL piece lengths (code points).
    Very long texts are worked on alone.  An empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i}") for i in range(4)]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws).mapInArrow(
        _examples(rate, spm_rate), _EXAMPLE
    )


def _restored(batches):
    for whole in batches:
        for begin, end in slices(whole.column("output"), SLICE_BYTES):
            batch = whole.slice(begin, end - begin)
            output, form = batch.column("output").cast(pa.large_string()), batch.column("form")
            plain = pc.equal(form, "plain")
            # pieces hold no marker, and none can arise where pieces meet markers: the parts are '', two outer pieces, middle
            parts = pc.split_pattern_regex(pc.if_else(plain, _text(PREFIX + SUFFIX + MIDDLE), output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
            one, two, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
            spm = pc.equal(form, "spm")
            text = _joined(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pc.if_else(plain, output, text).cast(pa.string())], names=[*batch.schema.names, "restored"]
            )


def restore(examples: DataFrame) -> DataFrame:
    """``examples`` (columns of fill_in_middle) with ``restored``: the text, rebuilt from output and form alone."""
    rows = examples.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return rows.mapInArrow(_restored, _EXAMPLE + ", restored string")
