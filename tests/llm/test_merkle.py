"""The Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from trendspark.llm import merkle
from trendspark.llm.queries import all_oracles

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node string, tree string, pos long, n long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def path(levels, at):
    steps = []
    for level in levels[:-1]:
        first = at // 16 * 16
        steps.append((level[first:at], level[at + 1 : first + 16]))
        at //= 16
    return steps


def brute(rows):
    by_source = defaultdict(list)
    for row in rows:
        text, doc = row["text"], row["doc_id"]
        own = other = leaf(row, text)
        if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
            other = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        by_source[row["source"]].append((doc, own, other))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = levels_of([own for _, own, _ in by_source[source]])
    top = levels_of([trees[source][-1][0] for source in order])
    out = []
    for k, source in enumerate(order):
        for at, (doc, own, other) in enumerate(by_source[source]):
            steps, folded = path(trees[source], at) + path(top, k), other
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in steps for x in left + right])
            out.append((doc, own, trees[source][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def same(found, expected):
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def sized(spark, sizes):
    rows = [
        (None if i == 3 and s != "one" else i * 7, None if i % 11 == 5 else f"Text {i % 9} É", "en", s, i, "x", "y", 1, 2)
        for s, n in sizes.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 16},
        {"a": 17, None: 3},
        {"hot": 600, "b": 256, "c": 257, "": 2, None: 1, "é": 5, "one": 1, "z": 4097},
        {f"s{k}": 1 + k % 3 for k in range(300)},
    ],
)
def test_trees_of_all_heights(spark, sizes):
    docs = sized(spark, sizes)
    same(merkle.verified(docs), brute(docs.collect()))


def test_corpus_and_given(docs, given):
    for table in (docs, given):
        found = merkle.verified(table)
        assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        same(found, brute(table.collect()))


def test_empty(empty):
    found = merkle.manifest(empty)
    assert found.root() is None
    assert found.proofs().count() == 0


def test_only_every_second_level_is_stored(spark):
    found = merkle.manifest(sized(spark, {"z": 4097}))
    assert [level.count() for level in found.documents] == [4097, 17, 1]


def test_a_changed_row_fails_alone(spark):
    docs = sized(spark, {"a": 300, "b": 20})
    changed = F.when((F.col("doc_id") == 70) & (F.col("source") == "a"), "other").otherwise(F.col("text"))
    proofs = merkle.folded(merkle.manifest(docs, changed).proofs())
    failed = proofs.filter("folded_root <> root").select("doc_id", "tree").collect()
    assert [tuple(r) for r in failed] == [(70, "1a")]


def test_oracle_agrees(spark, docs):
    rows = [r.asDict() for r in sized(spark, {"hot": 300, None: 18, "b": 1}).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany(
        "INSERT INTO documents VALUES (?, ?, ?, ?, ?)",
        [[r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")] for r in rows],
    )
    found = con.execute(all_oracles()["op11_merkle"]).fetchall()
    assert Counter(found) == Counter(brute(rows))
