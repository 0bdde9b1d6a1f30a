"""The fill-in-the-middle transformation against regular expressions and string parts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from trendspark.llm import fill_middle
from trendspark.llm.queries import all_oracles

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.fixture(params=["docs", "given", "empty", "odd"])
def table(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="module")
def odd(spark):
    chance = random.Random(3)
    pieces = ["a", "word ", "\n\n", "é", "🙂 ", "\x85", " ", "<", "<P", "P>", "S>", " \t", "longer-word" * 30, "<M", "\x1c"]
    texts = ["".join(chance.choices(pieces, k=chance.randint(0, 40))) for _ in range(600)]
    texts += ["has <P> in it", "a <S> b", "x <M>", "<M", "   ", "\n", " a", "a ", "w " * 50_000 + "y" * 90_000 + " z" * 999]
    return spark.createDataFrame([(i - 5, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, form string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc, text):
    tokens = TOKEN.findall(text)
    n, digest = len(tokens), sha(f"42:{'' if doc is None else doc}")
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc, n, "plain", None, None, sha(text), sha(text)
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return doc, n, "spm", len(pre), len(mid), sha(f"<S>{suf}<P>{pre}<M>{mid}"), sha(text)
    return doc, n, "psm", len(pre), len(mid), sha(f"<P>{pre}<S>{suf}<M>{mid}"), sha(text)


def test_rows(table):
    expected = [brute(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]
    found = [tuple(r) for r in fill_middle.round_trip(table).collect()]
    assert Counter(found) == Counter(expected)


def test_every_form_occurs(odd):
    forms = Counter(r["form"] for r in fill_middle.fill_in_middle(odd).collect())
    assert set(forms) == {"plain", "spm", "psm"} and forms["spm"] > forms["psm"]


def test_boundaries_are_those_of_the_pattern(odd):
    for row in odd.collect():
        ends = [m.end() for m in TOKEN.finditer(row["text"])]
        assert fill_middle.boundaries(row["text"]).tolist() == [0, *ends]


def test_index_is_exact_and_its_segments_are_bounded():
    chance = np.random.default_rng(4)
    for steps in (
        chance.integers(1, 12, 40_000),
        chance.integers(1, 4000, 3000),
        np.ones(5000, "i8"),
        np.concatenate([np.full(700, 2), np.full(900, 9), [500_000], np.full(300, 3)]),
        chance.geometric(0.01, 2000),
        np.zeros(0, "i8"),
    ):
        bounds = np.concatenate([[0], np.cumsum(steps)]).astype("i8")
        index = fill_middle.RankIndex.fit(bounds)
        ranks = np.arange(len(bounds))
        assert (index.offset(ranks) == bounds).all()
        assert np.abs(bounds - index.predicted(ranks)).max() <= fill_middle.ERROR + 1
        assert len(index.residuals) == len(bounds)
    words = fill_middle.RankIndex.fit(np.concatenate([[0], np.cumsum(chance.integers(3, 9, 100_000))]).astype("i8"))
    assert len(words.ranks) < 100  # each segment covers a thousand boundaries and more


def test_stored_index_serves_other_draws(odd, tmp_path):
    path = str(tmp_path / "index")
    fill_middle.rank_index(odd).write.parquet(path)
    index = odd.sparkSession.read.parquet(path)
    of = {r["doc_id"]: r["text"] for r in odd.collect()}
    for seed in (42, 7):
        for row in fill_middle.cut_offsets(index, seed).collect():
            tokens = TOKEN.findall(of[row["doc_id"]])
            a, b = fill_middle.cut_ranks(fill_middle.draws(row["doc_id"], seed), len(tokens))
            assert (row["prefix_end"], row["middle_end"]) == (len("".join(tokens[:a])), len("".join(tokens[:b])))


def test_oracle_agrees(odd):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    rows = [[r["doc_id"], r["text"]] for r in odd.collect()] + [[None, "some words here"], [9999, None]]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = con.execute(all_oracles()["op12_fill_middle"]).fetchall()
    assert Counter(found) == Counter(brute(d, t or "") for d, t in rows)
