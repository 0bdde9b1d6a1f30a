"""Classifiers by held-out results, licenses by hand-made trees."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from trendspark.llm import langid, license_scan, quality, queries

SF_DIR = "/root/testdata/sf0.01"


def held_out(doc, folds, remainder):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % folds == remainder


def test_quality_on_held_out_labels(spark):
    found = {r["doc_id"]: r for r in queries.op5_quality(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    mine = [(r["quality"], found[r["doc_id"]]) for r in labels if held_out(r["doc_id"], 5, 0)]
    assert len(mine) > 50 and all(r["held_out"] for _, r in mine)
    assert np.mean([q == r["predicted"] for q, r in mine]) >= 0.97
    good, bad = ([r["score"] for q, r in mine if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.99
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())


def test_quality_of_odd_rows(spark, docs, empty):
    given = spark.createDataFrame(
        [(1, 1, "x"), (3, 1, "x"), (9, 1, "x"), (12, 0, "x"), (14, 0, "x"), (12, None, "x"), (None, 0, "x"), (99, 1, "x")],
        "doc_id long, quality int, text string",
    )
    ranker = quality.train(docs, given)
    rows = quality.quality_scores(docs, ranker).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.accepted(docs, ranker).columns == docs.columns
    assert quality.quality_scores(empty, ranker).count() == 0
    none = quality.train(docs, given.filter("quality = 1"))
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}


def test_pairs_are_won_by_the_better_one():
    chance = np.random.default_rng(1)
    n = len(quality.FEATURES)
    good, bad = chance.normal(0.5, 1, (300, n)), chance.normal(-0.5, 1, (100, n))
    ranker = quality.fit(good, bad, 0.25)
    below = np.concatenate([ranker.scores(good), ranker.scores(bad)]) < quality.THRESHOLD
    assert abs(below.mean() - 0.25) < 0.01  # the cut is the quantile of the bad share
    assert ranker.scores(good).mean() > 0.9 > 0.1 > ranker.scores(bad).mean()


def test_language_on_held_out_documents(spark):
    found = {r["doc_id"]: r for r in queries.op10_language(spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()
    mine = [(r["lang"], found[r["doc_id"]]) for r in rows if held_out(r["doc_id"], 3, 1)]
    assert all(r["held_out"] for _, r in mine)
    assert np.mean([lang == r["lang_pred"] for lang, r in mine]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_of_odd_rows(docs, empty, spark):
    codes = langid.train(docs)
    found = langid.predict(docs, codes).collect()
    assert len(found) == docs.count()
    blank = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (4, 5, 6)}
    assert set(blank.values()) == {("und", 0.0)}
    assert {r["lang_pred"] for r in found} == {"en", "und"}
    assert langid.predict(empty, codes).count() == 0
    unknown = langid.train(empty)
    assert {r["lang_pred"] for r in langid.predict(docs, unknown).collect()} == {"und"}
    digits = spark.createDataFrame([(1, "12 34 !?", None), (2, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.predict(digits, codes).orderBy("doc_id").collect()] == ["und", "en"]


@pytest.mark.parametrize("classes", [2, 4, 7, 12])
def test_codewords_differ(classes):
    code = langid.codewords(classes)
    assert len(code) == classes and set(code.ravel().tolist()) <= {1.0, -1.0}
    least = min(int((code[i] != code[j]).sum()) for i in range(classes) for j in range(i))
    assert least >= max(1, code.shape[1] // 4)


def test_a_wrong_bit_is_corrected():
    code = langid.codewords(4)
    weights = np.vstack([np.zeros((1, code.shape[1])), code[2] * 3])
    weights[1, 0] *= -0.2
    best, score, ahead = langid.Codes(list("abcd"), code, weights).decode(np.zeros((1, 1)))
    assert best.tolist() == [2] and score[0] > 0.9 and ahead[0] > langid.CLOSE


FILES = [
    (1, "LICENSE", "Some project\nReleased under the MIT License.\n"),
    (2, "a/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
    (3, "a/b/c/code.txt", "no statement at all"),
    (4, "a/b/own.txt", "prose of the kind\nLicensed under CC BY-NC 4.0.\nmore prose"),
    (5, "z/code.txt", "The terms of this are in the library of the public and general version under the rights"),
    (6, None, None),
    (7, "ab/notice", "nothing"),
    (8, "ab/code.txt", ""),
    (8, "ab/code.txt", ""),
    (9, "a/licensed.txt", "Licensed under the Apache License, Version 2.0."),
]


def test_licenses_are_found_and_inherited(spark):
    rows = [(*x, "clash", "clash") for x in FILES]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, dir string, license string")
    found = {r["doc_id"]: (r["own_license"], r["license"], r["license_path"]) for r in license_scan.scan(files).collect()}
    gpl = (None, "GPL-3.0", "a/COPYING.txt")
    mit = (None, "MIT", "LICENSE")
    assert found == {
        1: ("MIT", "MIT", "LICENSE"),
        2: ("GPL-3.0", "GPL-3.0", "a/COPYING.txt"),
        3: gpl,
        4: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "a/b/own.txt"),
        5: mit,
        6: mit,
        7: mit,
        8: mit,
        9: ("Apache-2.0", "Apache-2.0", "a/licensed.txt"),
    }
    assert license_scan.scan(files).count() == len(FILES)
    assert license_scan.scan(files.limit(0)).count() == 0


def test_the_bound_on_a_lines_cosine_drops_no_match():
    match = license_scan.Matcher(license_scan.TEMPLATES, {"the": 50, "this": 20, "under": 3}, 100, 0.3)
    chance = np.random.default_rng(3)
    vocabulary = [*sorted({w for x in license_scan.TEMPLATES.values() for w in license_scan.terms(x)}), "other", "words"]
    free = license_scan.Matcher(license_scan.TEMPLATES, {"the": 50, "this": 20, "under": 3}, 100, 1e-9)
    for _ in range(500):
        line = " ".join(chance.choice(vocabulary, chance.integers(1, 12)))
        all_, found = free.score(line), match.score(line)
        assert found == (all_ if all_ and all_[0] >= 0.3 else None)


def test_license_lines_of_documents(spark):
    found = {r["doc_id"]: r["own_license"] for r in queries.op6_license_scan(spark, SF_DIR).collect()}
    said = {
        "General Public License": "GPL-3.0", "Released under the MIT": "MIT", "CC BY-NC": "CC-BY-NC-4.0",
        "Apache License": "Apache-2.0", "All rights reserved": "proprietary",
    }
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        named = {v for k, v in said.items() if k in r["text"]}
        assert (found[r["doc_id"]] in named) if named else found[r["doc_id"]] is None


@pytest.mark.parametrize("common", [50_000, 3])
def test_a_lines_license_does_not_depend_on_the_number_of_files(spark, monkeypatch, common):
    """Common words beside a statement weigh by their own frequency, whether every task holds it or not."""
    monkeypatch.setattr(license_scan, "COMMON", common)
    line = "all you may rights copy reserved"  # no run of three words is like the statement
    scores = []
    for times in (1, 40):
        kinds = [line, "you may copy", "you may copy this file", "you may", "you copy may rest"]
        rows = [(i, f"f{i}", kinds[i % 5] + f" w{i % 5}x") for i in range(5 * times)]
        rows += [(10_000 + i, "odd", "rights reserved unheard-of-" + str(i)) for i in range(times)]
        found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
        verdicts = {r["doc_id"]: (r["own_license"], r["score"]) for r in found}
        words = [set(license_scan.terms(x)) for _, _, x in rows]
        held = Counter(w for x in words for w in x)
        match = license_scan.Matcher(license_scan.TEMPLATES, held, len(rows), license_scan.THRESHOLD)
        for doc, _, text in rows:
            expected = match.score(text)
            assert verdicts[doc][0] == (expected and expected[1])
            assert expected is None or abs(verdicts[doc][1] - expected[0]) < 1e-9
        scores.append(verdicts[0])
    assert scores[0][0] == scores[1][0] == "proprietary" and abs(scores[0][1] - scores[1][1]) < 0.1


def wrapped(text, mark):
    words = text.split()
    return "\n".join(mark + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))


@pytest.mark.parametrize("common", [50_000, 20])
def test_wrapped_headers_inner_statements_and_license_texts(spark, monkeypatch, common):
    monkeypatch.setattr(license_scan, "COMMON", common)
    bodies = {k: [x for name, x in license_scan.PASSAGES if name == k] for k in ("MIT", "GPL-2.0", "GPL-3.0", "Apache-2.0")}
    prose = " ".join(f"some prose of the kind that goes on number{i}" for i in range(30))
    rows = [
        (1, "m/LICENSE", "The MIT text\n\nCopyright (c) 2024 Acme\n\n" + wrapped(bodies["MIT"][0], "")),
        (2, "m/code.py", "print(1)"),
        (3, "a.py", "# Copyright 2024 Acme\n" + wrapped(bodies["Apache-2.0"][0], "# ") + "\n" + prose),
        (4, "g.c", "/*\n" + wrapped(bodies["GPL-2.0"][0], " * ") + "\n */\n" + prose),
        (5, "h.c", wrapped(bodies["GPL-3.0"][0], "// ")),
        (6, "one-line", f"{prose} Released under the MIT License. {prose}"),
        (7, "two-lines", f"{prose} Licensed under\nCC BY-NC 4.0. {prose}"),
        (8, "prose", prose + " the rights of some and the terms of a version"),
        (9, "g/COPYING", wrapped(bodies["GPL-3.0"][1], "\t\t") + "\nPreamble\n" + prose),
        (10, "g/x/y.c", ""),
    ]
    rows += [(100 + i, f"p/{i}", prose) for i in range(20)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = {r["doc_id"]: r["license"] for r in license_scan.scan(files).collect()}
    assert [found[i] for i in range(1, 11)] == [
        "MIT", "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MIT", "CC-BY-NC-4.0", None, "GPL-3.0", "GPL-3.0",
    ]
    assert not any(found[100 + i] for i in range(20))


@pytest.mark.parametrize("few", [500_000, 0])
def test_the_cut_is_the_quantile_of_all_labelled_rows(spark, monkeypatch, few):
    """The fit sees few rows of a class, the cut all of them."""
    monkeypatch.setattr(quality, "PER_CLASS", 15)
    monkeypatch.setattr(quality, "FEW_LABELS", few)
    monkeypatch.setattr(quality, "LAST_VALUES", 4)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    ranker = quality.train(docs, labels)
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if not held_out(r["doc_id"], 5, 0)}
    bodies = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect() if r["doc_id"] in known}
    assert len(bodies) == len(known)
    strengths = np.sort(ranker.strengths(np.array([quality.features(x) for x in bodies.values()])))
    bad = sum(q == 0 for q in known.values())
    assert abs(ranker.cut - (strengths[bad - 1] + strengths[bad]) / 2) < 1e-9
