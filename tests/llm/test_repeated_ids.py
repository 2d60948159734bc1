"""Ids that repeat with different texts, and user columns named like an operator's."""

import random

import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL

from weighlens.llm import binary_codes, poisson_mix, quality_eb, signature_join, toxic_crf
from weighlens.llm.common import table

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _text(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(10 ** 9)}" for _ in range(n))


A, B = _text(1), _text(2)


@pytest.mark.parametrize("turned", [1, -1])
def test_links_of_both_texts_of_an_id(rows, turned):
    data = [(1, A), (1, B), (5, A + " more"), (6, B + " more"), (9, _text(3)), (8, _text(4)), (8, A + " and more")][::turned]
    found = signature_join.join_near_copies(rows(data, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 5: 1, 6: 1, 8: 1, 9: 9}


@pytest.mark.parametrize("turned", [1, -1])
def test_texts_that_share_an_id_all_stay(spark, rows, turned):
    data = [(1, A), (1, B), (1, B), (5, A + " more"), (6, B + " more"), (7, ""), (7, None), (None, A), (None, A)][::turned]
    docs = rows([(i, t, "en", "s", 1) for i, t in data], COLUMNS)
    kept = corpus_pipeline.one_of_each_group(spark, docs, SMALL).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted([("1", A), ("1", B), ("7", ""), ("7", ""), ("None", A), ("None", A)])


def test_user_columns_come_back_untouched(spark, rows):
    clash = ["rate", "keep", "quality", "evidence", "host_rate", "path_rate", "copy", "shuffle_key"]
    data = [(i, _text(i, 80).replace("w", " wo"), "en", "s", i, *[7.5 + i] * len(clash)) for i in range(30)]
    docs = rows(data, COLUMNS + "".join(f", {c} double" for c in clash))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert {tuple(r) for r in out.collect()} <= set(data), name


def test_one_row_of_an_id_is_learned_from(spark, rows, monkeypatch):
    docs = rows([(1, f"text {i}") for i in range(300)] + [(2, "other")], "doc_id bigint, text string")
    labels = rows([(1, 1, 1), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality_eb, "fit", lambda x, y: seen.append(len(y)))
    quality_eb.train(docs, labels, rows=2)
    monkeypatch.setattr(toxic_crf, "_fit_curve", lambda x, y: seen.append(len(y)) or (0.0, 0.0, 0.0))
    monkeypatch.setattr(toxic_crf, "_train_field", lambda forms, windows: seen.append(len(windows)) or toxic_crf.Field(forms, np.zeros(len(forms))))
    toxic_crf.train(docs, labels, rows=2)
    assert seen == [2, 2, 2]


def test_rows_without_ids_are_drawn_by_their_texts(rows):
    docs = rows([(None, f"text number {i}", "s") for i in range(400)], "doc_id bigint, text string, source string")
    out = poisson_mix.mix_sources(docs)
    copies = {r["text"]: r["count"] for r in out.groupBy("text").count().collect()}
    assert len(set(copies.values())) > 2 and 200 < len(copies) < 320
    assert out.select("shuffle_key").distinct().count() == out.count()


def test_pairs_at_the_threshold_do_not_depend_on_their_block():
    r = np.random.default_rng(4)
    u = r.standard_normal((200, 31))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    i, j = np.triu_indices(200, 1)
    import math

    exact = np.array([math.fsum(u[a] * u[b]) for a, b in zip(i, j)])
    for threshold in exact[::997]:
        alone = np.array([binary_codes._reaches(u, i[k:k + 1], j[k:k + 1], threshold)[0] for k in range(0, len(i), 97)])
        assert np.array_equal(binary_codes._reaches(u, i, j, threshold), exact >= threshold) and np.array_equal(alone, (exact >= threshold)[::97])


def test_quality_of_given_documents_reads_texts_once(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    narrow = quality_eb.add_quality(docs, labels, carry=["doc_id"])
    assert narrow.columns == ["doc_id", "host_rate", "path_rate", "evidence", "quality", "keep"]
    assert "ArrowEvalPython" not in narrow._jdf.queryExecution().executedPlan().toString()
