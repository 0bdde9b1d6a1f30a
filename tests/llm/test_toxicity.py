"""The toxicity lexicon: folding, exceptions, learning, and scores against a version without the automaton."""

from __future__ import annotations

import math
import random
import zlib

import pytest

from trendspark.llm import toxicity
from trendspark.llm.toxicity import Lexicon, folded, heat, hits, stream

from tests.llm.conftest import prose

LEXICON = Lexicon({" idiot ": 3.0, " trash ": 2.0, " scu": 1.0, " scum ": 2.5}, [" trash can ", " the trash "], 1.0, -1.0)


def found(text):
    return [entry for _, entry in hits(LEXICON.matcher(), stream(*folded(text)))]


@pytest.mark.parametrize(
    "text",
    [
        "you IDIOT!", "an idiot, he", "1d10t", "an !d1ot? no: id1ot.", "іdiоt", "ｉｄｉｏｔ", "id​iot", "idi­ot", "ID10T...",
    ],
)
def test_folding_finds_hidden_words(text):
    assert found(text) == [" idiot "]


@pytest.mark.parametrize("text", ["idiots", "idiotic", "radio t", "an idio", "и д иот", "", "   ", "1 0 5", "id iot", "10 20"])
def test_other_words_are_left_alone(text):
    assert found(text) == []


def test_words_of_other_scripts_stay():
    assert folded("сорока село")[0] == ["сорока", "село"]
    assert folded("pаthetic")[0] == ["pathetic"]
    assert folded("a сору of it")[0] == ["a", "copy", "of", "it"]  # all four letters are Cyrillic


def test_exception_phrases_take_hits_back():
    assert found("put it in the trash can now") == []
    assert found("trash talk") == [" trash "]
    assert found("the trash talk, trash can, trash") == [" trash "]
    assert found("a trash. Idiot") == [" trash ", " idiot "]


def test_of_entries_at_one_place_the_heaviest_counts():
    assert heat(LEXICON, LEXICON.matcher(), "scum") == pytest.approx(math.log1p(100 * 2.5 / 21))
    assert heat(LEXICON, LEXICON.matcher(), "scumble") == pytest.approx(math.log1p(100 * 1.0 / 21))


def test_longer_texts_score_lower():
    heats = [heat(LEXICON, LEXICON.matcher(), "idiot " + "word " * n) for n in (0, 10, 1000, 100_000)]
    assert heats == sorted(heats, reverse=True) and heats[-1] > 0


def tables(spark):
    """Toxic texts have trash or a word that begins with blarg; clean ones have 'trash can' and other words."""
    chance, rows, labels = random.Random(9), [], []
    for doc in range(900):
        words, toxic = prose(doc, 40), doc % 3 == 0
        for at in range(0, 40, 15):
            if toxic:
                words[at] = chance.choice(["trash", "blarg" + "".join(chance.choices("xyz", k=4))])
            elif doc % 3 == 1:
                words[at : at + 1] = ["trash", "can"]
        rows.append((doc, " ".join(words), "x", "y"))
        labels.append((doc, int(toxic), None))
    rows += [(5000, None, "x", "y"), (5001, "", "x", "y"), (None, "you trash", "x", "y"), (None, "you trash", "x", "y")]
    labels += [(5000, None, 1), (5001, 0, 1), (None, 1, 1), (0, 0, 1), (7777, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, toxic string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_learns_words_beginnings_and_phrases(spark):
    docs, labels = tables(spark)
    lexicon = toxicity.train(docs, labels)
    assert set(lexicon.weights) == {" trash ", " blarg"}
    assert " trash can " in lexicon.phrases
    rows = toxicity.toxicity_scores(docs, lexicon).collect()
    assert len(rows) == docs.count()
    by_doc = {r["doc_id"]: r for r in rows}
    assert all(by_doc[d]["predicted"] == (d % 3 == 0) for d in range(900))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    assert by_doc[5000]["score"] == by_doc[5001]["score"] < 0.5
    assert [r["predicted"] for r in rows if r["doc_id"] is None] == [1, 1]


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = tables(spark)
    learnt = [r["doc_id"] for r in labels.collect() if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    first, second = toxicity.train(docs, labels), toxicity.train(docs, labels.filter(labels.doc_id.isin(learnt)))
    assert first == second


def test_without_labels_nothing_is_toxic(spark, docs, empty):
    for given in (labels_of(spark, []), labels_of(spark, [(1, 1), (2, 1)]), labels_of(spark, [(1, None), (2, 0)])):
        rows = toxicity.toxicity_scores(docs, toxicity.train(docs, given)).collect()
        assert len(rows) == docs.count() and {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}
    assert toxicity.toxicity_scores(empty, toxicity.train(empty, labels_of(spark, [(1, 1), (2, 0)]))).count() == 0


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def plain_score(lexicon, text):
    """The score by looking at every word of the text in turn."""
    words, further = folded(text)
    total = 0.0
    for line in (words, further):
        for at, word in enumerate(line):
            weights = [lexicon.weights.get(f" {word} ", 0.0)] + [lexicon.weights.get(f" {word[:n]}", 0.0) for n in range(1, 9)]
            pairs = [f" {line[at - 1]} {word} "] if at else []
            pairs += [f" {word} {line[at + 1]} "] if at + 1 < len(line) else []
            total += 0.0 if any(p in lexicon.phrases for p in pairs) else max(weights)
    value = lexicon.intercept + lexicon.slope * math.log1p(100 * total / (len(words) + 20))
    return 1 / (1 + math.exp(-value))


def test_scores_equal_a_plain_version_and_hold_on_unseen_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, lexicon).collect()}
    for row in docs.filter("doc_id % 7 = 0").collect():
        assert rows[row["doc_id"]]["score"] == pytest.approx(plain_score(lexicon, row["text"] or ""), abs=1e-9)
    unseen = [(rows[r["doc_id"]]["predicted"], r["toxic"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert sum(p == t for p, t in unseen) / len(unseen) > 0.985
    assert sum(p for p, t in unseen if not t) / len(unseen) < 0.005
