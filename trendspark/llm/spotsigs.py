"""Document fingerprints by SpotSigs.

A spot is a common word (an anchor); its signature is the anchor with the next ``CHAIN`` content
words. A document's fingerprint is the set of its signatures. Fingerprints are compared by
Jaccard likeness; pairs whose set sizes rule the wanted likeness out are never compared.

Defined cases: a null text is empty; an empty text has an empty fingerprint, which is like
another empty one (1) and unlike any other (0); a text without an anchor, or without a full chain,
takes every word as an anchor, and if that gives nothing, its words as one signature, or the whole
text where it has none; the document after a row is the next row by (doc_id, text), null doc_ids
first, and the first one after the last; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_range, partitions, ship, texts
from .minhash import mixed

CHAIN = 2
THRESHOLD = 0.8
MEMO = 300_000
#: Ranges of doc_id for each shuffle partition.
RANGES = 4

#: Very common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "the of and to in a is that it for was on with as be by this are an at from or not have "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es "
    "de la le et les un du une que est pour qui dans il au sur pas par avec ne "
    "el y los se del las con no su para al lo como por más o si".split()
)

_OUTER = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…–—¿¡"


class Words(dict):
    """Hash of a lower-cased word without outer marks, and whether it is an anchor; 0 for marks alone."""

    def __missing__(self, word: str) -> tuple[int, bool]:
        if len(self) >= MEMO:
            self.clear()
        bare = word.strip(_OUTER)
        self[word] = found = (xxhash.xxh3_64_intdigest(bare) if bare else 0, bare in ANCHORS)
        return found


def _chains(hashes: np.ndarray, anchors: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Signatures of the anchors (places) with the next ``CHAIN`` of the content words (places)."""
    first = np.searchsorted(content, anchors, side="right")
    full = first + CHAIN <= len(content)
    anchors, first = anchors[full], first[full]
    total = mixed(hashes[anchors])
    for i in range(CHAIN):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[content[first + i]])
    return np.unique((total >> np.uint64(32)).astype("u4"))


def signatures(text: str, words: Words) -> np.ndarray:
    """Sorted 32-bit signatures of a text."""
    found = [words[x] for x in text.lower().split()]
    hashes = np.array([h for h, _ in found], "u8")
    common = np.array([c for _, c in found], bool)
    common, hashes = common[hashes != 0], hashes[hashes != 0]
    places = np.arange(len(hashes))
    out = _chains(hashes, places[common], places[~common])
    if not len(out):
        out = _chains(hashes, places, places)
    if not len(out) and len(hashes):
        out = np.array([xxhash.xxh3_64_intdigest(hashes.tobytes()) & 0xFFFFFFFF], "u4")
    if not len(out) and text:
        out = np.array([xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) & 0xFFFFFFFF], "u4")
    return out


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two signature sets; 0 without a comparison if the sizes keep it under ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(found: np.ndarray) -> str:
    """A fingerprint as text: eight hexadecimal digits for each signature, ascending."""
    return found.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype("u4")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_signatures, fingerprint of every row."""
    ship(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for frame in frames:
            found = [signatures(x, words) for x in frame["text"]]
            out = frame[["doc_id"]].astype({"doc_id": "Int64"})
            yield out.assign(n_signatures=[len(x) for x in found], fingerprint=[written(x) for x in found])

    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInPandas(run, "doc_id long, n_signatures long, fingerprint string")


def similar_pairs(prints: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints at least ``least`` alike.

    ``prints`` has doc_id and fingerprint. Equal fingerprints are one class, named by its smallest doc_id.
    Sets are partitioned by length so that a set can only be like one of its own or the next partition, and meet
    there by the signatures of a prefix: two sets that are alike share one among the first
    n - ceil(least * n) + 1 in any common order (here that of the signatures' hashes).
    """
    ship(prints.sparkSession)
    classes = (
        prints.filter(F.length("fingerprint") > 0).groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    ).withColumn("n", F.length("fingerprint") / 8)
    part = F.floor(F.log(F.col("n")) / -np.log(least)).cast("int")
    whole = F.transform(
        F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), lambda i: F.substring("fingerprint", i * 8 + 1, F.lit(8))
    )
    prefix = F.slice(
        F.array_sort(F.transform(whole, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("s")))),
        F.lit(1),
        (F.col("n") - F.ceil(F.col("n") * least) + 1).cast("int"),
    )
    spots = classes.select("doc_id", "n", part.alias("part"), F.explode(prefix).alias("spot"))
    left = spots.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), "spot", "part")
    right = spots.select(
        F.col("doc_id").alias("b"),
        F.col("n").alias("n_b"),
        "spot",
        F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"),
    )
    met = left.join(right, ["spot", "part"]).filter("a < b")
    met = met.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least).select("a", "b").distinct()
    of = lambda x: classes.select(F.col("doc_id").alias(x), F.col("fingerprint").alias(f"of_{x}"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [likeness(read(x), read(y), least) for x, y in zip(frame["of_a"], frame["of_b"], strict=True)]
            out = frame[["a", "b"]].assign(likeness=np.array(found, "f8"))
            yield out[out["likeness"] >= least]

    return met.join(of("a"), "a").join(of("b"), "b").mapInPandas(run, "a long, b long, likeness double")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, doc_id, text, tail), dealt out by range and sorted in it by doc_id.

    Each range ends with a copy of the first document of the range after it (``tail``), so that every
    document meets the next one without a global sort in one task.
    """
    ranges = RANGES * partitions(docs.sparkSession)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    ranged = rows.withColumn("range", key_range(rows.select("doc_id"), "doc_id", ranges))
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    heads = ranged.select("range", order.alias("at")).groupBy("range").agg(F.min("at").alias("first_id"))
    by_range = Window.orderBy("range")  # one row for each range
    before = F.coalesce(
        F.lag("range").over(by_range),
        F.max("range").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    tails = heads.select(before.alias("before"), "first_id")
    copies = ranged.join(F.broadcast(tails), order == F.col("first_id")).select(
        "doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("tail")
    )
    both = ranged.withColumn("tail", F.lit(False)).unionByName(copies)
    dealt = both.repartition(partitions(docs.sparkSession), "range")
    return dealt.sortWithinPartitions("range", "tail", "doc_id", "text")


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words, names = Words(), [x.split()[0] for x in COMPARED.split(", ")]
    held = None
    for frame in frames:
        out, size = [], 0
        columns = (frame[c] for c in ("range", "tail", "doc_id", "text"))
        for at, tail, doc, text in zip(*columns, strict=True):
            same = held is not None and held[0] == at
            if tail and not same:
                continue  # a further copy of the head
            own = signatures(text, words)
            if same:
                _, other, before, prints = held
                half = len(before) // 2
                edited = before[: len(before) - half] + text[:half]
                changed = signatures(edited, words)
                out.append(
                    (
                        None if pd.isna(other) else int(other),
                        len(before),
                        hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
                        written(prints),
                        written(changed),
                        likeness(prints, changed),
                        likeness(prints, own),
                    )
                )
                size += len(before) + len(edited)
            held = None if tail else (at, doc, text, own)
            if size > 1 << 23:
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                out, size = [], 0
        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness to each other and to the next text's.

    The edited form has the last floor(n / 2) of n code points replaced by the first as many of the next document.
    """
    ship(docs.sparkSession)
    return with_next(docs).mapInPandas(_compare, COMPARED)
