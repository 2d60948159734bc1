"""Words of whole texts as 64-bit hashes, a batch at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of a common 64-bit hash)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hashed(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def word_hashes(texts: pa.Array, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts one after the other, words per text); NULL has no words.

    Words are parted by ASCII white space and A-Z counts as a-z.  With ``plain`` all letters are lower-cased and only
    letters and digits are kept; words without any are left out.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    pieces = pc.ascii_split_whitespace(texts)
    ends = np.asarray(pieces.offsets).astype(np.int64)
    ends = ends - ends[0] if len(ends) else np.zeros(1, np.int64)
    coded = pieces.flatten().dictionary_encode()
    words = coded.dictionary
    if plain:
        words = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\pL\pN]+", "")
    else:
        words = pc.ascii_lower(words)
    there = np.asarray(pc.greater(pc.binary_length(words), 0))
    index = np.asarray(coded.indices)
    if not len(index):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    hashes = _hashed(words)[index]
    keep = there[index]
    counted = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], np.diff(counted[ends])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total = total * _ODD + words[k: len(words) - n + 1 + k]
        total ^= total >> np.uint64(29)
    return mixed(total)


def text_ngrams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram hashes, number of the text, word position) of all n-grams that lie within one text."""
    grams = ngram_hashes(words, n)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)[: len(grams)]
    at = np.arange(len(grams))
    inside = at + n <= ends[text] if len(grams) else np.zeros(0, bool)
    text, at = text[inside], at[inside]
    return grams[inside], text, at - (ends - counts)[text]
