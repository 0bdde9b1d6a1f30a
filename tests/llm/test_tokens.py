"""Counts, byte-level BPE and packing against the libraries."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from trendspark.llm import bpe, packing, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(params=["docs", "given", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def rows_of(table):
    return [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]


def same(found, expected):
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_counts_equal_the_librarys(table):
    library = Tokenizer.from_file(JSON)
    expected = []
    for doc, text in rows_of(table):
        n = len(library.encode(text, add_special_tokens=False).ids)
        expected.append((doc, len(text.encode()), n, n > 1024))
    same(token_counts.token_counts(table, JSON), expected)


def test_cache_encodes_only_what_it_lacks(spark, docs, tmp_path):
    path = str(tmp_path / "cache")
    token_counts.token_counts(docs.filter("doc_id <= 9"), JSON, path).collect()
    first = spark.read.parquet(path)
    known = {bytes(r["digest"]) for r in first.collect()}
    assert len(known) == first.count() == 8  # distinct texts of those rows, null and empty the same
    token_counts.token_counts(docs, JSON, path).collect()
    after = spark.read.parquet(path)
    assert after.count() == after.select("digest").distinct().count() == len({t for _, t in rows_of(docs)})
    assert token_counts.version(JSON) != token_counts.version(WORDS)


def test_ids_and_decoded_bytes_equal_the_librarys(table):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    expected = []
    for doc, text in rows_of(table):
        ids = library.encode_ordinary(text)
        said = " ".join(map(str, ids)).encode()
        expected.append((doc, len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    same(bpe.round_trip(table, RANKS, public_tokenizers.PATTERN), expected)


def test_decode_gives_the_text_back(docs):
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, own_cuts=False), RANKS)
    same(decoded.selectExpr("doc_id", "cast(bytes as string) as text"), rows_of(docs))


def test_cuts_change_no_match():
    import random

    chance, find = random.Random(3), regex.compile(public_tokenizers.PATTERN).findall
    splitter = bpe.Splitter(public_tokenizers.PATTERN, True)
    for _ in range(5000):
        text = "".join(chance.choices([" ", " ", "\n", "a", "'s", "1", "!", "\t", "\x1c", "\x85", "é", "　"], k=12))
        assert [x for y in splitter.words(text) for x in y] == find(text)


def test_blocks_of_any_size_give_the_same(docs, monkeypatch):
    whole = sorted(map(tuple, bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()), key=str)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 100)
    assert sorted(map(tuple, bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()), key=str) == whole


def test_packing_places_every_id_once(table):
    library = Tokenizer.from_file(WORDS)
    expected = Counter()
    texts = rows_of(table)
    for doc, text in texts:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        expected[doc, len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces = packing.pack(table, WORDS, length=256).collect()
    used = defaultdict(list)
    for p in pieces:
        used[p["sequence_id"]].append((p["offset"], p["length"]))
    for at, parts in used.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 256 or at == max(used)
    assert sorted(used) == list(range(len(used)))
    assert sum(p["length"] for p in pieces) == sum(n * k for (_, n, _), k in expected.items())
    whole = Counter((p["doc_id"], p["doc_tokens"], p["ids_crc32"]) for p in pieces if p["length"] == p["doc_tokens"])
    assert not whole - expected
    by_doc = defaultdict(set)
    for p in pieces:
        by_doc[p["doc_id"]].update(range(p["start"], p["start"] + p["length"]))
    for doc, n, _ in expected:
        assert set(range(n)) <= by_doc[doc]


def test_piece_checksums():
    import pandas as pd

    data = np.arange(10, dtype="<u4").tobytes()
    frame = pd.DataFrame({"doc_id": [5], "place": [6], "ids": [data]})
    out = next(packing.cut(8)(iter([frame])))
    assert out[["start", "length", "sequence_id", "offset"]].values.tolist() == [[0, 2, 0, 6], [2, 8, 1, 0]]
    assert out["ids_crc32"].tolist() == [zlib.crc32(data[:8]), zlib.crc32(data[8:])]


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dimensions, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    index = packing.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_pieces_have_the_ids_of_the_text():
    import random

    library, special, _ = packing.word_ids(WORDS)
    chance = random.Random(4)
    marks = ["'", "'s", "'LL", " ", "\n", "\t", "\x0b", "\x1c", "\x00", "\x85", " ", "　", ".", "<", "|", "12"]
    letters = ["a", "T", "e", "́", "̸", "É", "ß", "ς", "Σ", "İ", "ı", "ж", "你", "が", "゙", "한", "ᆨ", "ب", "²", "ǅ", "😀"]
    for _ in range(20000):
        text = "".join(chance.choices([*marks, *letters, *special] if chance.random() < 0.1 else [*marks, *letters], k=12))
        found = library.encode_batch_fast(packing.pieces(text, special), add_special_tokens=False)
        assert [x for piece in found for x in piece.ids] == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_over_batches_are_the_librarys():
    import random

    library, special, _ = packing.word_ids(WORDS)
    chance = random.Random(8)
    parts = ["the", "The", "cat", "naïve", "x'll", " ", "  ", "\n", "\r\n", "\t", "12", "!?", "中文", "İ", "é", "\u3000", "\x1c", "\x00", "'", "<|ENDOFTEXT|>", *special]
    for _ in range(60):
        texts = ["".join(chance.choices(parts, k=chance.randint(0, 60))) for _ in range(40)]
        ids, bounds = packing.encoded(pa.array(texts), WORDS)
        for text, start, end in zip(texts, bounds, bounds[1:]):
            assert ids[start:end].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        for most in (1, 40, 1 << 20):  # run by run
            runs = list(packing.encoded_runs(pa.array(texts), WORDS, most))
            assert [x for first, last, _, _ in runs for x in range(first, last)] == list(range(len(texts)))
            assert np.concatenate([part for _, _, part, _ in runs]).tolist() == ids.tolist()
            assert [n for *_, ends in runs for n in np.diff(ends)] == np.diff(bounds).tolist()
    assert packing.encoded(pa.array([], pa.string()), WORDS)[1].tolist() == [0]
    assert list(packing.encoded_runs(pa.array([], pa.string()), WORDS, 9)) == []
    assert list(packing.runs_of(np.array([5, 0, 7, 20, 1, 1]), 10)) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_pieces_follow_the_curve(given):
    """Documents come in the order of their place on the curve, worked out here from the library's ids."""
    library = Tokenizer.from_file(WORDS)
    place = {}
    for doc, text in rows_of(given):
        counts = np.zeros((1, packing.HASHED))
        for i in library.encode(text, add_special_tokens=False).ids:
            counts[0, (i * packing.HASH % 2**32) >> 24] += 1
        place[doc] = int(packing.curve_keys(counts)[0])
    first = {}
    for r in packing.pack(given, WORDS).collect():
        if r["start"] == 0:
            first[r["doc_id"]] = r["sequence_id"] * 4096 + r["offset"]
    order = [place[doc] for doc in sorted(first, key=first.get)]
    assert len(order) == len(place) and order == sorted(order)


def test_counts_of_parts_equal_those_of_whole_texts(monkeypatch):
    import random

    chance = random.Random(1)
    signs = [" ", " ", "a", "the", "'s", "42", "!", "\n", "\t", "é", "中", "　", "​", "\x85", "  ", "<|endoftext|>"]
    texts = ["".join(chance.choices(signs, k=chance.randrange(25))) for _ in range(3000)] + ["", " ", " a", "a ", "a" * 100]
    library = Tokenizer.from_file(JSON)
    expected = [len(library.encode(text, add_special_tokens=False).ids) for text in texts]
    counts = token_counts.PartCounts(JSON)
    assert token_counts.n_tokens(pa.array(texts), counts).tolist() == expected
    assert "a" * 100 not in counts  # long parts are not remembered
    monkeypatch.setattr(token_counts, "MEMO", 5)
    assert token_counts.n_tokens(pa.array(texts[:50]), counts).tolist() == expected[:50]


def test_a_word_is_encoded_once(monkeypatch):
    counts, said = token_counts.PartCounts(JSON), []
    whole = counts.of
    monkeypatch.setattr(counts, "of", lambda parts: said.extend(parts) or whole(parts))
    token_counts.n_tokens(pa.array(["some words and some words more"] * 50), counts)
    assert len(said) == len(set(said)) == 5
