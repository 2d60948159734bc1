"""Every stage of the pipeline against a plain version of it, on its own input."""

from collections import Counter

import corpus_pipeline
import pytest
from conftest import SMALL
from test_links import _expected
from test_models_and_leaks import _words
from test_shards_and_mix import _place

from weighlens.llm import quality_eb
from weighlens.llm.common import staged, table


@pytest.fixture(scope="module")
def passed(spark):
    """What goes into and out of each stage."""
    docs, out = table(spark, SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, SMALL), "test-stage")
        out.append((before, docs))
    return out


def _ids(docs):
    return Counter(r["doc_id"] for r in docs.select("doc_id").collect())


def test_stages_keep_the_columns(spark, passed):
    assert all(out.columns == table(spark, SMALL, "documents").columns for _, out in passed[:-1])
    assert set(passed[-1][1].columns) > set(passed[0][0].columns)


def test_rejected_documents_go(spark, passed):
    before, after = passed[0]
    keep = {r["doc_id"] for r in quality_eb.add_quality(before, table(spark, SMALL, "labels")).collect() if r["quality"] >= 0.5}
    assert set(_ids(after)) == keep and 0 < len(keep) < before.count()


def test_one_of_each_group_stays(passed):
    before, after = passed[1]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    found = _expected([t for _, t in rows])
    assert _ids(after) == Counter(i for n, (i, _) in enumerate(rows) if found[n][1] == n)


def test_leaks_go(spark, passed):
    before, after = passed[2]
    items = [" ".join(_words(r["text"])) for r in table(spark, SMALL, "benchmark").collect()]
    clean = {r["doc_id"] for r in before.collect() if not any(i in " ".join(_words(r["text"])) for i in items)}
    assert set(_ids(after)) <= clean and len(clean) - len(_ids(after)) <= 2


def test_copies_are_whole_rows(passed):
    before, after = passed[3]
    source = {r["doc_id"]: r for r in before.collect()}
    assert all(r == source[r["doc_id"]] for r in after.collect())
    assert 0.7 < after.count() / before.count() < 1.3


def test_shards(passed):
    before, after = passed[4]
    data = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted((r["doc_id"], r["shard"]) for r in after.collect()) == _place(data, 16, 0.02)


def test_repeated_rows_null_ids_and_empty_tables(spark, rows):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    text = " ".join(map(str, range(40)))
    docs = rows([(4, text, "en", "s", 1), (4, text, "en", "s", 1), (2, text + " x", "en", "s", 1), (None, None, None, None, None), (None, text, "en", "s", 1), (7, "", None, None, 0)], columns)
    kept = corpus_pipeline.one_of_each_group(spark, docs, SMALL)
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["2", "7", "None", "None"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows([], columns), SMALL).count() == 0
        stage(spark, docs, SMALL).collect()
