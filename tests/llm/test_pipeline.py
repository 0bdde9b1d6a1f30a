"""The pipeline's stages against brute force, each on its own input."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tests.llm.test_duplicates import lowered, near_expected, passages_expected
from trendspark.llm import packing, suffixes

KEYS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The documents that each stage reads, and the result of the last one."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_rejected_documents_are_the_bad_ones(spark, inputs):
    before, after = texts(inputs[0]), texts(inputs[1])
    assert inputs[1].columns == KEYS and all(after[d] == before[d] for d in after)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = [r["doc_id"] in after for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in after for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_one_of_equal_texts_stays(inputs):
    before, after = texts(inputs[1]), texts(inputs[2])
    last = {lowered(t): d for d, t in sorted(before.items())}
    assert after == {d: before[d] for d in last.values()} and inputs[2].columns == KEYS


def test_one_of_near_copies_stays(inputs):
    rows = list(texts(inputs[2]).items())
    expected = {doc for doc, _, _, kept in near_expected(rows, corpus_pipeline.SHINGLE) if kept}
    assert set(texts(inputs[3])) == expected and inputs[3].columns == KEYS


def test_later_copies_of_passages_go(inputs):
    before = texts(inputs[3])
    _, later = passages_expected(list(before.items()))
    gone = Counter(doc for doc, _ in later)
    assert gone
    after = {r["doc_id"]: r for r in inputs[4].collect()}
    for doc, text in before.items():
        words = text.split()
        left = [w for i, w in enumerate(words) if (doc, i) not in later]
        if not gone[doc]:
            assert after[doc]["text"] == text
        elif left:
            assert after[doc]["text"].split() == left and after[doc]["n_chars"] == len(after[doc]["text"])
        else:
            assert doc not in after
    assert inputs[4].columns == KEYS


def test_all_that_is_left_is_packed(inputs):
    left = texts(inputs[4])
    pieces = inputs[5].collect()
    assert {r["doc_id"] for r in pieces} == set(left)
    sizes = Counter()
    for r in pieces:
        sizes[r["sequence_id"]] += r["length"]
    assert all(n == 4096 for at, n in sizes.items() if at != max(sizes))


def test_run_gives_the_last_stages_rows(spark, inputs):
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(*key).collect())) == Counter(
        map(tuple, inputs[5].select(*key).collect())
    )


def test_odd_rows_pass(spark, docs, empty):
    for table in (docs, empty):
        for name, stage in corpus_pipeline.STAGES[1:]:
            table = stage(spark, table, SF_DIR)
            assert table.count() >= 0
            if name != "packing":
                assert table.columns == docs.columns
    found = corpus_pipeline.remove_copies(spark, docs, SF_DIR).select("doc_id", "text").collect()
    ids = Counter(r["doc_id"] for r in found)
    assert ids[3] == 1 and ids[None] == 1 and ids[20] == 1 and not ids[1] and not ids[2] and ids[6] == 1
    assert packing.pack(empty, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert suffixes.repeated_passages(empty).count() == 0


def test_texts_are_cut_once(spark, monkeypatch):
    spans = spark.createDataFrame([(1, 0, 2, False)], "node long, start_word int, end_word int, is_first boolean")
    monkeypatch.setattr(corpus_pipeline.suffixes, "spans", lambda docs, firsts: spans)
    docs = spark.createDataFrame([(1, "a b c d", 7), (2, "x y", 3)], "doc_id long, text string, n_chars long")
    out = corpus_pipeline.cut_repeated_passages(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    assert sorted(map(tuple, out.collect())) == [(1, "c d", 3), (2, "x y", 3)]
