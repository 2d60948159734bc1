"""Token files and WARC archives: exact round trips."""

import base64
import gc
import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from weighlens.llm import token_files, warc_index
from weighlens.llm.queries import tokenizer_file
from weighlens.storage import shared_dir

TEXTS = [
    (7, "Hello, world! It's 2024.\nNew line"), (3, None), (None, "no id"), (5, ""), (5, "same id, other text"), (9, "a  b\t\tc   d \n\n e "),
    (1, "ünïcödé 漢字   x   y\x1c\x1c z"), (2, " lead and trail "), (4, "\n\n\nx\ny"), (6, "word " * 30_000), (8, "don't we'll <|endoftext|> stop"),
    (7, "Hello, world! It's 2024.\nNew line"), (10, "\n"), (11, " "), (12, "tab\tinside\rand more"),
]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file())


def _expected(whole, rows):
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


def test_token_files_hold_what_the_tokenizer_gives(spark, rows, whole):
    docs = rows([(i, t, "x") for i, t in TEXTS], "doc_id bigint, text string, n_tokens string").repartition(3)
    found = token_files.token_round_trip(docs, tokenizer_file()).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in found] == _expected(whole, TEXTS)


def test_small_blocks_and_empty_table(spark, rows, whole):
    docs = rows(TEXTS, "doc_id bigint, text string")
    path = shared_dir(spark, "tokens")
    token_files.write_token_files(docs, tokenizer_file(), path, block_bytes=40)
    found = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in found] == _expected(whole, TEXTS)
    assert token_files.token_round_trip(docs.limit(0), tokenizer_file()).count() == 0


@pytest.mark.parametrize("top", [1, 200, 70_000, 20_000_000])
def test_block_coding_is_exact(top):
    random = np.random.default_rng(top)
    ids = np.minimum(random.geometric(0.002, 90_000) * random.integers(1, 300, 90_000), top).astype(np.uint32)
    ranks, control, data = token_files.encode_block(ids)
    assert len(control) == -(-len(ids) // 4)
    assert (token_files.decode_block(len(ids), ranks, control, data) == ids).all()
    assert len(data) < 3 * len(ids)


def test_frequent_ids_take_one_byte():
    ids = np.array([40_000] * 1000 + list(range(300)), np.uint32)
    ranks, _, data = token_files.encode_block(ids)
    assert np.frombuffer(ranks, "<u4")[0] == 40_000
    assert len(data) == 1000 + 255 + 45 * 2


PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, None, None), (4, "http://a/4\r\nX: y", ""),
    (6, "http://a/6", "é漢\r\n\r\nWARC/1.0\r\n" * 3), (7, "http://a/7", "x" * 3_000_000), (5, "http://a/5", "<p>same</p>"), (None, "http://a/n", "only me"),
    (None, "http://a/m", "<p>same</p>"),
]


def _digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_archives_round_trip(spark, rows):
    pages = rows([(*r, 0) for r in PAGES], "page_id bigint, url string, html string, digest int").repartition(3)
    found = warc_index.archive_round_trip(pages).collect()
    best = {}
    for i, _, t in PAGES:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    expected = []
    for i, _, t in PAGES:
        keep = best[t or ""]
        first = i == keep or keep == -1
        expected.append((i, len((t or "").encode()), _digest(t), "response" if first else "revisit", None if first else keep, (t or "") if first else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["html"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_selected_records_and_small_payloads(spark, rows):
    pages = rows(PAGES, "page_id bigint, url string, html string").coalesce(1)
    path = shared_dir(spark, "warc")
    warc_index.write_archives(pages, path, least_bytes=12)  # 'same' pages are 11 bytes
    index = warc_index.index_archives(spark, path)
    assert index.count() == len(PAGES)
    one = warc_index.read_records(index.filter("page_id in (1, 6)"), range_bytes=64).collect()
    assert {(r["page_id"], r["record_type"], r["html"]) for r in one} == {(1, "response", "<p>same</p>"), (6, "response", PAGES[5][2])}


def test_no_pages(spark, rows):
    assert warc_index.archive_round_trip(rows([], "page_id bigint, url string, html string")).count() == 0


def test_words_of_ascii_letters_are_their_own_signs(monkeypatch):
    """They are not looked up in the table of signs; the ids are the whole tokenizer's, as are those of other letters."""
    coder, plain, other = token_files.WordEncoder(tokenizer_file()), ["stone", "Zyxwvq"], ["größe", "日本"]

    def whole(words):
        return [coder.tokenizer.encode(" " + w, add_special_tokens=False).ids for w in words]

    assert coder._word_ids(other) == whole(other)
    monkeypatch.setattr(token_files, "_BYTE_SIGNS", None)
    assert coder._word_ids(plain) == whole(plain)


def test_marks_and_line_feeds_do_not_send_a_word_through_the_whole_tokenizer(monkeypatch):
    """The word is merged once, its marks are encoded once; ids are those of the whole text."""
    coder = token_files.WordEncoder(tokenizer_file())
    whole = coder.tokenizer.encode_batch_fast
    sent, ids_of = [], coder._ids
    monkeypatch.setattr(coder, "_ids", lambda texts: sent.extend(texts) or ids_of(texts))
    texts = ["x stone!! birch%%%\nElm größe*** ash.\nOak,\nElm"]
    odd = [
        "x don't we'll!! rock'n'roll' 'tis' o'", "a b<|endoftext|>!! c<|endoftext|> <|endoftext|>, d|> e<| f<|endoftext|g", "x 5%% 555-1175.. ½!! 日本。.. é!!",
        "x\n!!\n\nfoo \n", "x\nfoo\t!! bar ?? baz\x85..", "", " ", "\n", "x \n!", "x !! \"y\" (z) z) A_b_ -- c--d--", "x stone!!? stone stone!! stone.\nstone.",
    ]
    for batch in (texts, odd, texts + odd):
        ids, counts = coder.encode(pa.array(batch, pa.string()))
        want = [x.ids + [token_files.END_ID] for x in whole(batch, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
        if batch is texts:
            assert set(sent) <= {"x", "!!", "%%%", "***", ".", ","}


def _made_up(n, seed):
    random = np.random.default_rng(seed)
    letters = random.choice(np.array(list("etaoinshr")), (n, 10))
    return ["".join(r) for r in letters]


def test_known_words_take_little_memory():
    coder = token_files.WordEncoder(tokenizer_file())
    coder.encode(pa.array(["x a b"]))
    gc.collect()
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for seed in range(4):
            coder.encode(pa.array(["x " + " ".join(_made_up(10_000, seed))]))
        gc.collect()
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert held < 40_000 * 100


def test_frequent_words_are_known_when_rare_ones_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 60)
    coder = token_files.WordEncoder(tokenizer_file())
    merge, merged = coder.merge, []
    monkeypatch.setattr(coder, "merge", lambda sign: merged.append(sign[1:]) or merge(sign))
    for i in range(12):
        texts = ["x stone, birch elm\nash elm. " + " ".join(_made_up(20, 100 + i)), None, "", "oak  elm"]
        ids, counts = coder.encode(pa.array(texts, pa.string()))
        want = [x.ids + [token_files.END_ID] for x in coder.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [n for x in want for n in x]
    assert merged.count("birch") == merged.count("stone") == 1
    assert len(coder.words) <= 60 + 30


def test_tasks_of_a_worker_share_its_encoder(monkeypatch):
    """What a task gets is unpickled for it; the encoder with its words must not be made anew each time."""
    from pyspark import cloudpickle

    made = []
    monkeypatch.setattr(token_files, "_ENCODERS", {})
    monkeypatch.setattr(token_files, "WordEncoder", lambda file: made.append(file) or object())
    monkeypatch.setattr(token_files.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())

    class Rows:
        def __getattr__(self, name):
            return lambda *_: self

        def mapInArrow(self, encode, schema):
            self.__dict__["sent"] = cloudpickle.dumps(encode)
            return self

        write = property(lambda self: self)

    docs = Rows()
    monkeypatch.setattr(token_files.F, "col", lambda name: docs)
    token_files.write_token_files(docs, "some file", "some path")
    for _ in range(3):
        assert list(cloudpickle.loads(docs.sent)(iter([]))) == []
    assert made == ["some file"]
