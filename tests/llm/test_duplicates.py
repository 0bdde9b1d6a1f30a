"""Exact and near duplicates, fingerprints and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from trendspark.llm import exact_dedup, minhash, spotsigs, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["docs", "given", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def lowered(text):
    return (text or "").encode().lower()


def rows_of(table):
    return [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]


def test_exact_groups(table):
    groups = defaultdict(list)
    for doc, text in rows_of(table):
        groups[lowered(text)].append(doc)
    expected = Counter()
    for body, ids in groups.items():
        keep = max((x for x in ids if x is not None), default=None)
        for doc in ids:
            expected[doc, keep, len(ids), hashlib.sha256(body).hexdigest()] += 1
    found = exact_dedup.exact_groups(table).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_texts_with_one_fingerprint_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh3_64_intdigest", lambda x: 1 << 63)
    prints = [x.as_py() for x in next(exact_dedup._digest(iter([batch(["a", "b", "A"])])))["fingerprint"]]
    assert prints == [0, 0, 0]


def batch(texts):
    import pyarrow as pa

    n = list(range(len(texts)))
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(n), "node": pa.array(n), "text": pa.array(texts)})


@pytest.mark.parametrize("bits", [0, 1, 5])
def test_quotient_filters_lose_nothing(bits):
    chance = np.random.default_rng(bits)
    parts = [chance.integers(0, 1 << 64, 300, "u8", endpoint=False) for _ in range(3)]
    parts = [np.concatenate([p, p[:20], parts[0][:50]]) for p in parts]
    merged = {}
    for part in parts:
        for q, one in exact_dedup.CountingQuotientFilter.ranges(part, bits):
            one = exact_dedup.CountingQuotientFilter.load(**one.dump())
            merged[q] = merged[q].merged(one) if q in merged else one
    found = sorted(x for q, f in merged.items() for x in f.repeated(q, bits).tolist())
    assert found == sorted(x for x, n in Counter(np.concatenate(parts).tolist()).items() if n > 1)
    assert sum(int(f.counts.sum()) for f in merged.values()) == sum(map(len, parts))


def shingle_set(text, size=4):
    words = lowered(text).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_expected(rows, size=4):
    sets = {}
    for doc, text in rows:
        sets[doc] = shingle_set(text, size)
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return Counter((doc, len(sets[doc]), root(doc), root(doc) == doc) for doc, _ in rows)


def check_near(table, rows):
    found = [
        (r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
        for r in minhash.near_duplicates(table).collect()
        if r["doc_id"] is not None
    ]
    assert Counter(found) == near_expected([x for x in rows if x[0] is not None])


def test_near_duplicates(table):
    check_near(table, rows_of(table))


def test_rows_without_an_id_go_by_their_text(docs):
    found = [r for r in minhash.near_duplicates(docs).collect() if r["doc_id"] is None]
    assert len(found) == 2 and len({r["component_id"] for r in found}) == 1


@pytest.mark.parametrize("small_bucket", [8, 2])
def test_large_group_of_near_copies_and_a_common_passage(spark, monkeypatch, small_bucket):
    """Chains of edits, and unrelated texts that share half of their words, in buckets split to blocks."""
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small_bucket)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    chance, rows, text = random.Random(9), [], prose(20, 150)
    for i in range(40):
        text = list(text)
        text[chance.randrange(len(text))] = f"edit{i}"
        rows.append((i, " ".join(text)))
    passage = prose(21, 60)
    rows += [(100 + i, " ".join(passage + prose(200 + i, 30))) for i in range(30)]
    order = list(rows)
    chance.shuffle(order)
    check_near(spark.createDataFrame(order, "doc_id long, text string"), rows)


def test_components_of_a_star_and_a_path(spark):
    star = [(0, i) for i in range(1, 200)]
    path = [(1000 + i, 1001 + i) for i in range(60)]
    found = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(star + path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(200)}, **{1000 + i: 1000 for i in range(61)}}


def test_run_hashes_depend_on_their_words_alone():
    words = np.random.default_rng(1).integers(0, 1 << 63, 90).astype("u8")
    for n in (1, 2, 3, 4, 26, 50):
        whole = minhash.runs(words, n)
        assert len(whole) == len(words) - n + 1
        assert all(minhash.runs(words[i : i + n], n)[0] == whole[i] for i in (0, 7, len(whole) - 1))


def passages_expected(rows):
    """Words covered by a passage that has an earlier copy, and those covered by one that has a later one."""
    where = defaultdict(set)
    for doc, text in rows:
        words = lowered(text).split()
        for i in range(len(words) - 49):
            where[tuple(words[i : i + 50])].add((doc, i))
    later, first = set(), set()
    for places in where.values():
        if len(places) > 1:
            head = min(places)
            for doc, i in places:
                (first if (doc, i) == head else later).update((doc, j) for j in range(i, i + 50))
    return first, later


@pytest.mark.parametrize("task_rows", [1 << 20, 50])
def test_repeated_passages(table, monkeypatch, task_rows):
    monkeypatch.setattr(suffixes, "TASK_ROWS", task_rows)
    rows = [x for x in rows_of(table) if x[0] is not None]
    first, later = passages_expected(rows)
    found = suffixes.repeated_passages(table.filter("doc_id is not null")).collect()
    covered = {True: set(), False: set()}
    for r in found:
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50
        covered[r["is_first"]].update((r["doc_id"], j) for j in range(r["start_word"], r["end_word"]))
    assert covered[False] == later
    assert covered[True] == first


def test_passages_of_rows_without_an_id(docs):
    found = suffixes.repeated_passages(docs).filter("doc_id is null").collect()
    assert not found  # the two equal rows are one document


def test_words_are_cut_with_the_space_after_them():
    assert suffixes.without_words("a  b\nc d e", [(1, 3)]) == "a  d e"
    assert suffixes.without_words("a b", [(0, 2)]) == ""


def test_fingerprints_of_edited_and_next_texts(table):
    rows = sorted(rows_of(table), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    words = spotsigs.Words()
    expected = Counter()
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = (set(spotsigs.signatures(x, words).tolist()) for x in (text, edited, after))
        alike = [len(own & x) / len(own | x) if own | x else 1.0 for x in (other, following)]
        expected[doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *[round(x, 9) for x in alike]] += 1
    found = spotsigs.edited_and_next(table).collect()
    assert (
        Counter(
            (r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
            for r in found
        )
        == expected
    )
    assert all(0 <= r["near_next"] <= 1 for r in found)


def test_signatures_follow_anchors():
    words = spotsigs.Words()
    one = spotsigs.signatures("Today the quick brown fox and a lazy dog", words)
    assert len(one) == 3 - 1 + 1  # the quick brown; and lazy dog; a lazy dog
    assert np.array_equal(one, spotsigs.signatures("the (quick) brown fox, and a lazy dog!", words))
    assert len(spotsigs.signatures("zzz yyy xxx", words)) == 1
    assert len(spotsigs.signatures("!!!", words)) == 1 and len(spotsigs.signatures("", words)) == 0
    assert np.array_equal(spotsigs.read(spotsigs.written(one)), one)


def test_similar_pairs(given):
    prints = spotsigs.fingerprints(given)
    by_print = defaultdict(list)
    for r in prints.collect():
        if r["fingerprint"]:
            by_print[r["fingerprint"]].append(r["doc_id"])
    classes = {min(ids): set(spotsigs.read(x).tolist()) for x, ids in by_print.items()}
    expected = {
        (a, b)
        for a in classes
        for b in classes
        if a < b and len(classes[a] & classes[b]) >= 0.8 * len(classes[a] | classes[b])
    }
    found = spotsigs.similar_pairs(prints).collect()
    assert {(r["a"], r["b"]) for r in found} == expected and len(found) == len(expected) > 0


def test_first_documents_of_spans_in_several_tasks(spark):
    """Ids descend over the partitions, so most tasks meet a later copy first; two passages join to one span."""
    hot, cold = prose(41, 60), prose(42, 60)
    rows = [(i, " ".join(prose(500 + i, 20) + hot + prose(700 + i, 20))) for i in range(40, 1, -1)]
    rows += [(1, " ".join(hot)), (9000, " ".join(cold))]
    rows += [(9100 + i, " ".join(prose(900 + i, 15) + hot + cold)) for i in range(12)]
    where = defaultdict(set)
    for doc, text in rows:
        words = lowered(text).split()
        for i in range(len(words) - 49):
            where[tuple(words[i : i + 50])].add((doc, i))
    texts = dict(rows)
    given = spark.createDataFrame(spark.sparkContext.parallelize(rows, 13), "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or one task sees all
    try:
        found = suffixes.repeated_passages(given).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found
    for r in found:
        words = lowered(texts[r["doc_id"]]).split()
        expected = set()
        for i in range(r["start_word"], r["end_word"] - 49):
            places = where[tuple(words[i : i + 50])]
            if len(places) > 1 and ((r["doc_id"], i) == min(places)) == r["is_first"]:
                expected.add(min(places)[0])
        assert r["first_doc_ids"] == sorted(expected) and r["first_doc_id"] == min(expected)
    assert any(len(r["first_doc_ids"]) > 1 for r in found)


def test_words_are_hashed_like_single_ones():
    hashes = minhash.WordHashes()
    found = ["", "  ", "a", " a B\x1cé\x0b\x0c c ", "A a\n", "\u2003x y", "\t\t", "É é"]
    for text, words in zip(found, minhash.hashed_words(found, hashes)):
        assert words.tolist() == [hashes[x] for x in text.encode().lower().split()]
    assert minhash.hashed_words([], hashes) == []


def shared_ids(spark):
    """Several texts under one doc_id: two that others are close to, an empty one, one with a repeated passage."""
    a, b, passage = prose(50, 48), prose(51, 48), " ".join(prose(52, 70))
    rows = [
        (5, " ".join(a)), (5, " ".join(b)), (6, " ".join([*a, "q"])), (7, " ".join([*b, "q"])),
        (8, ""), (8, " ".join(prose(53, 60))), (9, " ".join([*prose(53, 60), "z"])), (10, "alone here"), (10, None),
        (11, passage + " tail of eleven"), (11, "short"), (12, " ".join(prose(54, 90)) + " " + passage),
        (13, "one"), (13, passage),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_links_of_all_texts_of_a_doc_id_count(spark):
    rows = minhash.near_duplicates(shared_ids(spark)).collect()
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == 14
    assert found[5] == (5, True) and found[6] == (5, False) and found[7] == (5, False)
    assert {r["component_id"] for r in rows if r["doc_id"] in (8, 9)} == {8}
    assert found[10] == (10, True) and found[12] == (12, True)


def test_passages_of_texts_that_share_a_doc_id(spark):
    docs = shared_ids(spark)
    spans = suffixes.repeated_passages(docs).collect()
    passage = {(r["doc_id"], r["n_words"]) for r in spans if r["n_words"] == 70}
    assert {doc for doc, _ in passage} == {11, 12, 13}
    assert all(set(r["first_doc_ids"]) <= {5, 6, 7, 8, 9, 11, 12, 13} for r in spans)
    left = {(r["doc_id"], r["text"]) for r in corpus_pipeline.cut_repeated_passages(spark, docs, "").collect()}
    assert (11, "short") in left and (10, "alone here") in left and (13, "one") in left
    kept = [text for _, text in left if text and " ".join(prose(52, 70)) in text]
    assert len(kept) == 1  # the first copy, whole


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_further_links_join_components_that_were_found(spark, monkeypatch, few):
    monkeypatch.setattr(minhash, "FEW_LINKS", few)
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    first, more = [(1, 2), (3, 4), (4, 5), (8, 9), (20, 21)], [(5, 9), (30, 31), (2, 40), (41, 40)]
    found = minhash.components(frame(first))
    together = {r["node"]: r["component"] for r in minhash.components(frame(first + more)).collect()}
    rows = minhash.merged(found, frame(more)).collect()
    assert {r["node"]: r["component"] for r in rows} == together and len(rows) == len(together)
    assert together == {1: 1, 2: 1, 40: 1, 41: 1, 3: 3, 4: 3, 5: 3, 8: 3, 9: 3, 20: 20, 21: 20, 30: 30, 31: 30}


def test_few_links_are_not_dealt_out(spark, monkeypatch):
    made = []
    keep = minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df, name: made.append((name, df.rdd.getNumPartitions())) or keep(df, name))
    minhash.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")).collect()
    assert {n for name, n in made if name != "edges"} == {1}


def test_a_task_combines_matches_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(suffixes, "TASK_ROWS", 8000)
    words = [f"w{i}" for i in range(200)]
    given = pd.DataFrame({"node": range(100), "text": [" ".join(words)] * 100})
    wanted = next(suffixes._keys(iter([given])))["keys"].iloc[0]
    given["keys"] = [wanted] * 100
    frames = list(suffixes._extended(iter([given])))
    assert sum(map(len, frames)) == 100 * 151 and max(map(len, frames)) <= 1000 + 151


def test_matches_are_joined_in_arrow():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("first_node", pa.int64()), ("is_first", pa.bool_())]))
    matches = [[(9, 7, False), (0, 8, False), (0, 5, True), (59, 8, False), (110, 3, False)], [(1, 4, True)]]
    told = [[dict(zip(("start", "first_node", "is_first"), m, strict=True)) for m in row] for row in matches]
    batch = pa.RecordBatch.from_arrays([pa.array([6, 4]), pa.array(told, kind)], ["node", "matches"])
    found = {tuple(r.values())[:6] + (tuple(r["first_nodes"]),) for x in suffixes._spans(iter([batch])) for r in x.to_pylist()}
    assert found == {
        (6, 0, 50, 50, 5, True, (5,)),
        (6, 0, 109, 109, 7, False, (7, 8)),
        (6, 110, 160, 50, 3, False, (3,)),
        (4, 1, 51, 50, 4, True, (4,)),
    }
