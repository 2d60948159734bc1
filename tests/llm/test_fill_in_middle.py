"""Fill-in-the-middle examples against a plain version, text by text."""

import hashlib
import random
import re

from conftest import SMALL

from weighlens.llm import fill_in_middle as fim
from weighlens.llm.common import table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _expected(doc_id, text):
    text = text or ""
    cut = UNIT.findall(text)
    assert "".join(cut) == text
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i: 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (len(cut) + 1), h2 % (len(cut) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (cut[:low], cut[low:high], cut[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(cut), "plain", None, None, text, text
    if h4 % 100 < 80:
        return doc_id, len(cut), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, len(cut), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def _check(data, found):
    key = lambda r: (str(r[0]), r[5])
    assert sorted(map(tuple, found), key=key) == sorted((_expected(*r) for r in data), key=key)


def test_random_texts(rows):
    rng = random.Random(5)
    odd = ["a", "é", "漢", "<", "<S", "P>", ">", " ", "\n", "\t", "\x0b", "\x0c", "\r", " ", " ", "\x1c", "\x85", "<P", "\x00"]
    data = [(i, "".join(rng.choices(odd, k=rng.randrange(12)))) for i in range(800)]
    _check(data, fim.restore(fim.fill_in_middle(rows(data, "doc_id bigint, text string"))).collect())


def test_nulls_empty_long_repeated_and_clashing(rows, monkeypatch):
    long = "wörd  " * 400_000
    data = [(1, None), (2, ""), (3, " \t "), (None, "a b c"), (None, None), (4, "x <M> y"), (5, long), (5, long), (5, "other text here"), (-7, "minus seven is fine")]
    docs = rows([(i, t, "x", 3, "y") for i, t in data], "doc_id bigint, text string, output string, n int, h0 string")
    _check(data, fim.restore(fim.fill_in_middle(docs)).collect())
    assert fim.fill_in_middle(rows([], "doc_id bigint, text string")).count() == 0


def test_slices_do_not_matter():
    import pyarrow as pa

    texts = pa.array(["abc", None, "", "d" * 50, "e", "f"])
    assert list(fim.slices(texts, 5)) == [(0, 3), (3, 4), (4, 6)]
    assert list(fim.slices(texts, 1 << 20)) == [(0, 6)] and list(fim.slices(texts[:0], 5)) == []
    part = pa.array(["skip me", " a  b ", "", "c", "d\n"], pa.large_string())[1:4]
    assert fim.units(part).to_pylist() == [[" a", "  b", " "], [], ["c"]]


def test_table(spark):
    docs = table(spark, SMALL, "documents")
    found = fim.restore(fim.fill_in_middle(docs)).collect()
    _check([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], found)
    assert {r["form"] for r in found} == {"plain", "spm", "psm"}
