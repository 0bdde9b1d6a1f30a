"""Byte-level BPE over the distinct words of the corpus, and decoding.

1. Each task splits its texts into the matches of the pattern and writes them as positions
   in the word list of a block (a run of rows of about ``BLOCK_CHARS`` characters).
2. The word lists are dealt out by a hash of the word. A task that gets a share of the words
   encodes each distinct one once and returns the ids under the block and share it came from.
3. Words and positions meet again by block, and the ids of a document are put together
   in the order of its positions.

Lists and positions travel as compressed columns. Decoding looks every id up in the table of
token bytes, whose size is that of the vocabulary file, never of the data.

Defined cases: a null text is empty (no ids); repeated rows give repeated results; an empty
table gives an empty one; columns other than doc_id and text are ignored. A text of any length
is handled whole, in the task that reads it.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, ship, texts

BLOCK_CHARS = 8 << 20
MEMO = 50_000

PIECES = "block string, share int, at long, doc_id long, data binary"

_encodings: dict[tuple[str, str], tiktoken.Encoding] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    if (path, pattern) not in _encodings:
        _encodings[path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
        )
    return _encodings[path, pattern]


def pack(numbers: np.ndarray) -> bytes:
    """uint32 numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Splitter:
    """Matches of the pattern in a text. Runs between spaces are matched once and remembered.

    ``own_cuts`` says that a text may be cut before any space that does not lie between two
    other white-space characters, without changing a match: true of the given pattern, whose
    words take one space in front.
    """

    _inner_space = re.compile(r"\s (?:\s|\Z)")
    _cut = regex.compile(r"(?<=\S)(?= \S)")

    def __init__(self, pattern: str, own_cuts: bool):
        self.find, self.own_cuts = regex.compile(pattern).findall, own_cuts
        self.memo: dict[str, list[str]] = {}

    def words(self, text: str) -> list[list[str]]:
        if not self.own_cuts:
            return [self.find(text)]
        if self._inner_space.search(text):
            runs = self._cut.split(text)
        else:
            first, *rest = text.split(" ")
            runs = [first, *[" " + x for x in rest]]
        memo, out = self.memo, []
        for run in runs:
            found = memo.get(run)
            if found is None:
                found = self.find(run)
                if len(memo) >= MEMO:
                    memo.clear()
                if len(run) < 100:
                    memo[run] = found
            out.append(found)
        return out


def split_blocks(pattern: str, own_cuts: bool, shares: int):
    """Rows (doc_id, text) to pieces: word lists by share, and the positions of each row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(pattern, own_cuts)
        codes: dict[str, int] = {}
        rows: list[tuple] = []
        numbers, held = itertools.count(), 0

        def block() -> pd.DataFrame:
            words = [x.encode() for x in codes]
            share = np.fromiter((zlib.crc32(x) for x in words), "u4", len(words)) % shares
            order = np.argsort(share, kind="stable")
            place = np.empty(len(words), "i8")
            place[order] = np.arange(len(words))  # words of a share are neighbours
            out = [(None, None, at, doc, pack(place[found])) for at, (doc, found) in enumerate(rows)]
            bounds = np.searchsorted(share[order], np.arange(shares + 1))
            press = zstandard.ZstdCompressor(level=3)
            for k in range(shares):
                mine = [words[i] for i in order[bounds[k] : bounds[k + 1]]]
                if mine:
                    sizes = np.array([len(x) for x in mine], "<u4").tobytes()
                    data = press.compress(len(mine).to_bytes(4, "little") + sizes + b"".join(mine))
                    out.append((None, k, int(bounds[k]), None, data))
            made = pd.DataFrame(out, columns=["block", "share", "at", "doc_id", "data"])
            made["block"] = f"{TaskContext.get().partitionId()}-{next(numbers)}"
            return made.astype({"share": "Int32", "doc_id": "Int64"})

        for frame in frames:
            for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
                if rows and held + len(text) > BLOCK_CHARS:
                    yield block()
                    codes, rows, held = {}, [], 0
                found = splitter.words(text)
                places = [codes.setdefault(word, len(codes)) for words in found for word in words]
                rows.append((None if pd.isna(doc) else int(doc), np.array(places, "u4")))
                held += len(text)
        if rows:
            yield block()

    return run


def encode_words(path: str, pattern: str):
    """Word lists of one share to the ids of their words; each distinct word is encoded once in a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(path, pattern)._encode_single_piece
        known: dict[bytes, bytes] = {}
        expand = zstandard.ZstdDecompressor()
        for frame in frames:
            for at, packed in enumerate(frame["data"]):
                data = expand.decompress(packed)
                n = int.from_bytes(data[:4], "little")
                ends = np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 + 4 * n
                start, out = 4 + 4 * n, []
                for end in ends.tolist():
                    word = data[start:end]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(encode(word), "<u4").tobytes()
                    out.append(ids)
                    start = end
                sizes = np.array([len(x) // 4 for x in out], "<u4")
                ids = np.frombuffer(b"".join(out), "<u4")
                row = frame.iloc[[at]][["block", "share", "at", "doc_id"]].copy()
                row["data"] = [joined(sizes, ids)]
                yield row

    return run


def joined(sizes: np.ndarray, ids: np.ndarray) -> bytes:
    first = pack(sizes)
    return len(first).to_bytes(4, "little") + first + pack(ids)


def lists_only(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The word lists among the pieces; a filter of its own would be moved below the shuffle that both sides read."""
    for frame in frames:
        yield frame[frame["share"].notna()]


def assemble(pieces: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    """The pieces and the encoded words of one block to (doc_id, ids)."""
    parts = []
    for data in words.sort_values("share")["data"]:
        cut = 4 + int.from_bytes(data[:4], "little")
        parts.append((unpack(data[4:cut]), unpack(data[cut:])))
    empty = np.empty(0, "<u4")
    sizes = np.concatenate([x for x, _ in parts] or [empty]).astype("i8")
    ids = np.concatenate([x for _, x in parts] or [empty]).astype("i4")
    starts = np.cumsum(sizes) - sizes
    rows = pieces[pieces["share"].isna()].sort_values("at")
    out = []
    for data in rows["data"]:
        places = unpack(data)
        lengths = sizes[places]
        shift = np.repeat(starts[places] - (np.cumsum(lengths) - lengths), lengths)
        out.append(ids[shift + np.arange(len(shift))])
    return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array, "ids": out})


def encode(docs: DataFrame, ranks_path: str, pattern: str, own_cuts: bool = True) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""
    spark = docs.sparkSession
    ship(spark)
    n = partitions(spark)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    # One shuffle by block; the lists leave it for the words' tasks, the positions wait in it for the ids.
    pieces = rows.mapInPandas(split_blocks(pattern, own_cuts, n), PIECES).repartition(n, "block")
    lists = pieces.mapInPandas(lists_only, PIECES).repartition(n, "share")
    words = lists.mapInPandas(encode_words(ranks_path, pattern), PIECES)
    return pieces.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(assemble, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the bytes of its ids, each looked up in the table of token bytes."""
    ship(encoded.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(ranks_path)
        for frame in frames:
            found = [b"".join([table[i] for i in ids.tolist()]) for ids in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "bytes": found})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, bytes binary")


_tables: dict[str, list[bytes]] = {}


def token_bytes(ranks_path: str) -> list[bytes]:
    """Token bytes by id."""
    if ranks_path not in _tables:
        ranks = read_ranks(ranks_path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _tables[ranks_path] = table
    return _tables[ranks_path]


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids, and digests both."""
    encoded = encode(docs, ranks_path, pattern)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(ranks_path)
        decimal = [str(i) for i in range(len(table))]
        for frame in frames:
            rows = []
            for ids in frame["ids"]:
                numbers = ids.tolist()
                said = " ".join([decimal[i] for i in numbers])
                text = b"".join([table[i] for i in numbers])
                rows.append((len(numbers), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").array)
            yield out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.mapInPandas(run, schema)
