"""Packing of neighbouring documents into sequences of a fixed length along a Hilbert curve.

Each document gets a hashed vector of its token ids, projected to four dimensions; its place on the Hilbert
curve through that space is the sort key. Documents are laid end to end in that order over the
whole corpus, and the line is cut every ``length`` tokens: every sequence but the last is full.

The order is global, yet no task holds it: a place is the token total of the key ranges before
(one row for each range) plus the running total inside the range. The low bits of the key are a
hash of the document, so that copies of one text, which share a curve place, still spread over ranges.

Defined cases: a null or empty text has only its end id; repeated rows are packed each; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_range, partitions, released, ship, stored, texts

DIMENSIONS, BITS = 4, 8
HASHED = 256  # 8 bits: the top ones of an id times HASH
HASH = 2654435769
TIE_BITS = 20
MEMO, MEMO_CHARS = 400_000, 16 << 20
#: Bytes of text whose distinct words are encoded together, and those whose ids are laid out together.
WORDS_OF, LAID_OUT = 8 << 20, 1 << 20

ROWS = "row long, doc_id long, curve long, n_tokens long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

#: Letters that no normal form changes and whose lower case is one letter.
_LETTERS = (
    "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0391-\u03a1\u03a3-\u03a9\u03ac-\u03ce"
    "\u0400-\u0481\u048a-\u052f\u0621-\u063a\u0641-\u064a\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
_PLAIN = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \t\n\r\x0b\x0c0-9{_LETTERS}]+"
_OTHER = f"[^\x00-\x7f{_LETTERS}]"
_has_other = re.compile(_OTHER).search
_plain_pieces = re.compile(_PLAIN).findall
_marked_pieces = re.compile(f"\n|{_PLAIN}").findall
_mixed_pieces = re.compile(rf"(?<![^ \n\r])(?:(?! |\n|\r|{_OTHER})[\s\S])*{_OTHER}[^ \n\r]*|{_PLAIN}").findall

_libraries: dict[str, tuple[tokenizers.Tokenizer, list[str], dict[str, bytes]]] = {}


def word_ids(path: str) -> tuple[tokenizers.Tokenizer, list[str], dict[str, bytes]]:
    """The tokenizer, its special strings, and the ids of pieces seen by this worker, about ``MEMO`` of them."""
    if path not in _libraries:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        loaded = tokenizers.Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _libraries[path] = loaded, [x.content for x in loaded.get_added_tokens_decoder().values()], {}
    return _libraries[path]


def pieces(text: str, special: list[str]) -> list[str]:
    """Parts of a text whose ids, one after the other, are those of the text.

    The tokenizer lower-cases, drops white space and never joins two of its pre-tokens in an id. Those
    of runs of ASCII and plain letters are found here; runs with other characters go to the library
    whole, and so do all runs, in their own case, of a text that holds a special string in any: the library
    looks for those before it lower-cases.
    """
    low = text.encode().lower().decode()  # A-Z only
    if any(x in low for x in special):
        return text.replace("\n", " ").replace("\r", " ").split(" ")
    return _mixed_pieces(low) if _has_other(low) else _plain_pieces(low)


def hilbert_index(places: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits in each dimension (columns).

    Gray-code construction: from the highest bit down, a set bit reverses the lower bits of the
    first dimension, a clear one exchanges them with those of its own; the transposed bits,
    Gray-decoded, are the index.
    """
    x = places.astype("u8").T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(n):
            is_set = (x[i] & high) != 0
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros(x.shape[1], "u8")
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[n - 1] & np.uint64(1 << bit)) != 0, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= flips
    index = np.zeros(x.shape[1], "u8")
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return index


def projection() -> np.ndarray:
    """Fixed random directions: the hashed vector's dimensions to those of the curve."""
    return np.random.default_rng(20).standard_normal((HASHED, DIMENSIONS))


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert index of each hashed count vector; counts are damped and scaled to length one."""
    damped = np.sqrt(vectors)
    norms = np.linalg.norm(damped, axis=1, keepdims=True)
    points = damped / np.where(norms == 0, 1, norms) @ projection()
    # A unit vector's projections spread about one: squeezed to (0, 1), then cut into cells.
    cells = (1 << BITS) / (1 + np.exp(-1.7 * points))
    return hilbert_index(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def _encode(new: list[str], library: tokenizers.Tokenizer) -> Iterator[bytes]:
    """The ids of pieces that are one pre-token each; between spaces they stay that, so many go at once."""
    for start in range(0, len(new), 5000):
        part = new[start : start + 5000]
        found = library.encode(" ".join(part), add_special_tokens=False)
        sizes = np.bincount(np.array(found.word_ids, "i8"), minlength=len(part))
        if len(sizes) != len(part) or not sizes.all():  # a piece has no ids, or several pre-tokens
            for alone in library.encode_batch_fast(part, add_special_tokens=False):
                yield array("I", alone.ids).tobytes()
            continue
        data, ends = np.array(found.ids, "<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        yield from (data[a:b] for a, b in zip([0, *ends], ends, strict=False))


class Parts:
    """The ids of distinct strings, to be laid out in any order."""

    def __init__(self, parts: list[bytes]):
        self.sizes = np.fromiter(map(len, parts), "i8", len(parts)) // 4
        self.flat = np.frombuffer(b"".join(parts), "<u4")
        self.starts = np.cumsum(self.sizes) - self.sizes

    def laid_out(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts in the order of ``index``, end to end, and where each begins (and the last ends)."""
        n = self.sizes[index]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.flat[np.repeat(self.starts[index] - ends[:-1], n) + np.arange(ends[-1])], ends


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _ids_of(words: pa.Array, path: str) -> list[bytes]:
    """The ids of distinct words: of their distinct pieces those that are new to this worker are encoded."""
    library, special, memo = word_ids(path)
    if len(memo) > MEMO or sum(map(len, memo)) > MEMO_CHARS:
        memo.clear()
    odd = pc.match_substring_regex(words, _OTHER)
    for string in special:
        odd = pc.or_(odd, pc.match_substring(words, string))
    plain = _strings(pc.ascii_lower(words.filter(pc.invert(odd))))
    coded = pa.array(_marked_pieces("".join([f"{word}\n" for word in plain])), pa.large_string()).dictionary_encode()
    known = _strings(coded.dictionary)
    new = [piece for piece in known if piece not in memo and piece != "\n"]
    memo.update(zip(new, _encode(new, library), strict=True))
    index = coded.indices.to_numpy()
    ids, ends = Parts([b"" if piece == "\n" else memo[piece] for piece in known]).laid_out(index)
    data = ids.tobytes()
    # A word ends where its mark stands.
    marks = (4 * ends[np.flatnonzero(index == known.index("\n"))]).tolist() if plain else []
    of_plain = (data[a:b] for a, b in zip([0, *marks], marks, strict=False))
    if len(plain) == len(words):
        return list(of_plain)
    whole = [pieces(word, special) for word in _strings(words.filter(odd))]
    encodings = iter(library.encode_batch_fast([x for parts in whole for x in parts], add_special_tokens=False))
    of_odd = (b"".join([array("I", next(encodings).ids).tobytes() for _ in parts]) for parts in whole)
    return [next(of_odd) if is_odd else next(of_plain) for is_odd in odd.to_pylist()]


def _coded(texts_: pa.Array, path: str) -> tuple[Parts, np.ndarray, np.ndarray]:
    """The distinct words of texts with their ids, which of them stand where, and where each text's begin.

    The tokenizer joins nothing over a space or a line end, so the words between these are told apart in Arrow.
    """
    body = pc.replace_substring(pc.replace_substring(texts_.cast(pa.large_string()), "\n", " "), "\r", " ")
    split = pc.split_pattern(body, " ")
    offsets = split.offsets.to_numpy()
    del body
    coded = split.flatten().dictionary_encode()
    words, index = coded.dictionary, coded.indices.to_numpy()
    del split, coded  # texts and words of all texts, not needed while the distinct ones are encoded
    return Parts(_ids_of(words, path)), index, offsets


def encoded(texts_: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, end to end, and where each text's begin (and the last ends)."""
    parts, index, offsets = _coded(texts_, path)
    ids, ends = parts.laid_out(index)
    return ids, ends[offsets]


def encoded_runs(texts_: pa.Array, path: str, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same for runs of the texts (start, end) with about ``most`` bytes, one after the other.

    Words are encoded once for all runs; the places of their ids, which take far more memory, are made run by run.
    """
    parts, index, offsets = _coded(texts_, path)
    for first, last in runs_of(pc.binary_length(texts_).to_numpy(zero_copy_only=False), most):
        begin = offsets[first]
        ids, ends = parts.laid_out(index[begin : offsets[last]])
        yield first, last, ids, ends[offsets[first : last + 1] - begin]


def runs_of(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of rows with about ``most`` bytes of text in all, one row at least."""
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def tokenise(path: str, end_id: int):
    """Rows (row, doc_id, text) to ids with the end id, their number, and the place on the curve.

    The hashed vector counts the ids but for the end id.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)
            for start, stop in runs_of(sizes, WORDS_OF):
                part = batch.slice(start, stop - start)
                for first, last, ids, bounds in encoded_runs(part["text"], path, LAID_OUT):
                    n = last - first
                    bucket = (ids * np.uint32(HASH) >> np.uint32(24)).astype("i8")
                    of = np.repeat(np.arange(n), np.diff(bounds)) * HASHED + bucket
                    vectors = np.bincount(of, minlength=n * HASHED).reshape(n, HASHED).astype("f8")
                    data = [ids[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["row"].slice(first, n),
                            part["doc_id"].slice(first, n),
                            pa.array(curve_keys(vectors).astype("i8")),
                            pa.array(np.diff(bounds) + 1, pa.int64()),
                            pa.array(data, pa.binary()),
                        ],
                        ["row", "doc_id", "curve", "n_tokens", "ids"],
                    )

    return run


def cut(length: int):
    """Rows (doc_id, place, ids) to the pieces between the cuts."""

    @released
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, place, data in zip(frame["doc_id"], frame["place"], frame["ids"], strict=True):
                n, start = len(data) // 4, 0
                while start < n:
                    offset = (place + start) % length
                    size = min(n - start, length - offset)
                    crc = zlib.crc32(data[4 * start : 4 * (start + size)])
                    out.append((doc, start, size, crc, n, (place + start) // length, offset))
                    start += size
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PIECES.split(", ")]).astype({"doc_id": "Int64"})

    return run


def places(rows: DataFrame, ranges: int) -> DataFrame:
    """row and place: tokens before each row, in the order of the curve."""
    tie = F.pmod(F.xxhash64("row"), F.lit(1 << TIE_BITS))
    keyed = rows.select("row", "n_tokens", (F.col("curve") * (1 << TIE_BITS) + tie).alias("key"))
    ranged = stored(keyed.withColumn("range", key_range(keyed, "key", ranges)), "ranged")
    totals = ranged.groupBy("range").agg(F.sum("n_tokens").alias("total"))  # one row for each range
    before = F.sum("total").over(Window.orderBy("range")) - F.col("total")
    bases = totals.select("range", before.alias("base"))
    inside = Window.partitionBy("range").orderBy("key", "row")
    running = ranged.withColumn("inner", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    return running.join(F.broadcast(bases), "range").select("row", (F.col("base") + F.col("inner")).alias("place"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = 4096) -> DataFrame:
    """Pieces of documents: which ids of which document lie where in which sequence."""
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs, F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    tokenised = stored(rows.mapInArrow(tokenise(tokenizer_path, end_id), ROWS), "ids")
    line = places(tokenised, partitions(spark))
    placed = tokenised.select("row", "doc_id", "ids").join(line, "row")
    return placed.select("doc_id", "place", "ids").mapInPandas(cut(length), PIECES)
