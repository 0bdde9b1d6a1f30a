"""Fill-in-the-middle transformation with a learned rank index.

A text is cut between its tokens (a word with the white space before it; white space at the end is one too). The index
of a text maps the rank of a boundary to its offset: straight segments, each as long as the error bound allows, predict
the offset, and a stored residual of one byte corrects it exactly. A cut is one prediction and one correction,
whatever the number of tokens, and an index that was stored serves any later draw without its text.

Cuts, order of the parts and the share of plain texts follow from the doc_id alone, so a task that runs again gives
the same rows. Nothing is dealt out: each text is cut where it is read.

Defined cases: a null text counts as empty, an empty text has no tokens and stays plain; a text that holds a sentinel
stays plain, so every output can be read back; a null doc_id draws as an empty number; repeated rows give repeated
results; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, texts

SEED = 42
#: Percent of documents that are transformed, and of those with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points that a segment may be off by; a residual, rounding included, has to fit one signed byte.
ERROR = 120
#: Boundaries that a segment is first tried on; each further try takes twice as many.
TRY = 256


def boundaries(text: str) -> np.ndarray:
    """Offsets (code points) before, between and after the tokens of ``text``; 0 alone where it is empty."""
    if not text:
        return np.zeros(1, "i8")
    codes = np.frombuffer(text.encode("ascii"), "u1") if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "<u4")
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.concatenate([[0], ends, [len(codes)]])


@dataclass
class RankIndex:
    """Segments (first rank, its offset, slope) and the residual of every rank."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, bounds: np.ndarray, error: int = ERROR) -> RankIndex:
        """Each segment starts on a boundary and goes on while one slope keeps all its boundaries within ``error``."""
        ranks, slopes, first = [], [], 0
        while first < len(bounds):
            end, low, high = _reach(bounds, first, error)
            ranks.append(first)
            slopes.append((low + high) / 2 if end > first + 1 else 0.0)
            first = end
        made = cls(np.array(ranks, "i8"), bounds[ranks], np.array(slopes), np.zeros(0, "i1"))
        missing = bounds - made.predicted(np.arange(len(bounds)))
        made.residuals = missing.astype("i1")
        if (made.residuals != missing).any():
            raise ValueError("the error bound does not fit a residual")
        return made

    def predicted(self, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[at] + np.rint(self.slopes[at] * (rank - self.ranks[at])).astype("i8")

    def offset(self, rank: np.ndarray) -> np.ndarray:
        return self.predicted(rank) + self.residuals[rank]


def _reach(bounds: np.ndarray, first: int, error: int) -> tuple[int, float, float]:
    """The rank where a segment from ``first`` ends, and the least and largest slope that fits all before it."""
    at, step, low, high = first + 1, TRY, -np.inf, np.inf
    while at < len(bounds):
        stop = min(len(bounds), at + step)
        run = np.arange(at - first, stop - first)
        rise = bounds[at:stop] - bounds[first]
        lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
        highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
        crossed = lows > highs
        over = int(crossed.argmax())
        if crossed[over]:
            return (at + over, float(lows[over - 1]), float(highs[over - 1])) if over else (at, low, high)
        at, step, low, high = stop, step * 2, float(lows[-1]), float(highs[-1])
    return at, low, high


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 that follow from the doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut_ranks(drawn: list[int], tokens: int) -> np.ndarray:
    return np.sort(np.array(drawn[:2], "i8") % (tokens + 1))


def transformed(text: str, drawn: list[int]) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    bounds = boundaries(text)
    n = len(bounds) - 1
    if not text or drawn[2] % 100 >= RATE or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    a, b = map(int, RankIndex.fit(bounds).offset(cut_ranks(drawn, n)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if drawn[3] % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch["doc_id"].to_pylist()
        rows = [transformed(text.as_py(), draws(doc)) for doc, text in zip(docs, batch["text"], strict=True)]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], pa.array(n, "int64"), pa.array(form, "string"), pa.array(prefix, "int64"),
                pa.array(middle, "int64"), pa.array(output, "string"),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars, output (text) of every row."""
    ship(docs.sparkSession)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(
        _transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Parts hold no sentinel, so the first of each is the one that was put in."""
    second = F.when(form == "psm", F.locate(SUFFIX, output)).otherwise(F.locate(PREFIX, output))
    last = F.locate(MIDDLE, output)
    head = F.substr(output, F.lit(4), second - 4)
    tail = F.substr(output, second + 3, last - second - 3)
    middle = F.substr(output, last + 3)
    rebuilt = F.when(form == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
    return F.when(form == "plain", output).otherwise(rebuilt)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [RankIndex.fit(boundaries(text.as_py())) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([x.ranks.tolist() for x in made], pa.list_(pa.int64())),
                pa.array([x.offsets.tolist() for x in made], pa.list_(pa.int64())),
                pa.array([x.slopes.tolist() for x in made], pa.list_(pa.float64())),
                pa.array([x.residuals.tobytes() for x in made], "binary"),
            ],
            ["doc_id", "ranks", "offsets", "slopes", "residuals"],
        )


def rank_index(docs: DataFrame) -> DataFrame:
    """The index of every row's text, to be stored: doc_id, ranks, offsets, slopes, residuals."""
    ship(docs.sparkSession)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(
        _index, "doc_id long, ranks array<long>, offsets array<long>, slopes array<double>, residuals binary"
    )


def cut_offsets(index: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, prefix_end, middle_end (code points) that ``seed`` draws, from stored indexes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                residuals = np.frombuffer(row["residuals"], "i1")
                made = RankIndex(np.array(row["ranks"]), np.array(row["offsets"]), np.array(row["slopes"]), residuals)
                found.append(made.offset(cut_ranks(draws(row["doc_id"], seed), len(residuals) - 1)).tolist())
            ends = np.array(found, "i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["doc_id", "prefix_end", "middle_end"]
            )

    ship(index.sparkSession)
    return index.mapInArrow(run, "doc_id long, prefix_end long, middle_end long")


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of the output and of the text read back from it."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
