"""Exact deduplication with counting quotient filters and byte verification.

1. One pass takes the fingerprint (64 bits) and the sha256 of every normalised text.
2. Each partition counts its fingerprints in a counting quotient filter: the high bits name the
   slot range, the low bits are remainders, kept sorted, each with its count. Filters of the
   same range merge by their sorted remainders without loss.
3. Texts whose fingerprint counts more than one, and only those, are compared byte for byte.

Defined cases: a null text counts as empty, and empty texts are equal to each other; of equal
texts the largest doc_id stays, a null doc_id comes last; where rows repeat that doc_id, one of
them stays; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import node_id, released, ship, stored, texts

#: Fingerprints that one slot range of the merged filter should hold.
RANGE_ROWS = 1 << 16
#: Fingerprints counted at once in a task.
TASK_ROWS = 1 << 20


class CountingQuotientFilter:
    """Counts of 64-bit fingerprints of one slot range, as sorted remainders.

    ``quotient_bits`` high bits name the range that the filter stands for; what is left of a
    fingerprint is its remainder, so that nothing of it is lost.
    """

    def __init__(self, remainders: np.ndarray, counts: np.ndarray):
        self.remainders, self.counts = remainders, counts

    @classmethod
    def ranges(cls, fingerprints: np.ndarray, quotient_bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        """The filters of the slot ranges that occur among ``fingerprints``."""
        values, counts = np.unique(fingerprints, return_counts=True)
        low = np.uint64(64 - quotient_bits)
        quotients = values >> low if quotient_bits else np.zeros(len(values), "u8")
        starts = np.flatnonzero(np.diff(quotients, prepend=quotients[:1] + np.uint64(1)))
        for start, end in zip(starts, [*starts[1:], len(values)], strict=True):
            q = quotients[start]
            yield int(q), cls(values[start:end] - (q << low if quotient_bits else q), counts[start:end])

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """The filter of both; remainders stay sorted, equal ones add their counts."""
        both = np.concatenate([self.remainders, other.remainders])
        counts = np.concatenate([self.counts, other.counts])
        order = np.argsort(both, kind="stable")  # a merge of two sorted runs
        both, counts = both[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))[: len(both)]
        return CountingQuotientFilter(both[starts], np.add.reduceat(counts, starts) if len(both) else counts)

    def dump(self) -> dict:
        return {"remainders": self.remainders.astype("<u8").tobytes(), "counts": self.counts.astype("<u4").tobytes()}

    @classmethod
    def load(cls, remainders: bytes, counts: bytes) -> CountingQuotientFilter:
        return cls(np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<u4").astype("i8"))

    def repeated(self, quotient: int, quotient_bits: int) -> np.ndarray:
        """Fingerprints that were counted more than once."""
        high = np.uint64(quotient << (64 - quotient_bits) if quotient_bits else 0)
        return self.remainders[self.counts > 1] + high


def normalised(text: pa.Array) -> list[bytes]:
    """UTF-8 of each text with A-Z lower-cased; ``bytes.lower`` changes those 26 letters only."""
    return [x.lower() for x in text.cast(pa.binary()).to_pylist()]


@released
def _digest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        found = normalised(frame["text"])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": frame["doc_id"],
                "node": frame["node"],
                "fingerprint": pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in found], "int64"),
                "sha": pa.array([hashlib.sha256(x).digest() for x in found], "binary"),
            }
        )


@released
def _bytes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        found = normalised(frame["text"])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": frame["doc_id"],
                "node": frame["node"],
                "fingerprint": pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in found], "int64"),
                "body": pa.array(found, "binary"),
            }
        )


def repeated_fingerprints(prints: DataFrame) -> DataFrame:
    """Fingerprints (column ``fingerprint``) that occur more than once, by merged filters."""
    rows = prints.count()
    bits = max(0, int(rows / RANGE_ROWS).bit_length())

    @released
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            values = np.concatenate(held).view("u8") + np.uint64(1 << 63)
            made = [(q, *x.dump().values()) for q, x in CountingQuotientFilter.ranges(values, bits)]
            return pd.DataFrame(made, columns=["quotient", "remainders", "counts"])

        for frame in frames:
            held.append(frame["fingerprint"].to_numpy("i8"))
            size += len(frame)
            if size >= TASK_ROWS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    @released
    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, whole = None, None

        def answer() -> pd.DataFrame:
            return pd.DataFrame({"fingerprint": (whole.repeated(at, bits) - np.uint64(1 << 63)).view("i8")})

        for frame in frames:
            for q, remainders, counts in zip(frame["quotient"], frame["remainders"], frame["counts"], strict=True):
                part = CountingQuotientFilter.load(remainders, counts)
                if q != at:
                    if whole is not None:
                        yield answer()
                    at, whole = q, part
                else:
                    whole = whole.merged(part)
        if whole is not None:
            yield answer()

    filters = prints.select("fingerprint").mapInPandas(build, "quotient long, remainders binary, counts binary")
    by_range = filters.repartition("quotient").sortWithinPartitions("quotient")
    return by_range.mapInPandas(merge, "fingerprint long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, node of every row."""
    ship(docs.sparkSession)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), node_id().alias("node"))
    prints = stored(
        rows.mapInArrow(_digest, "doc_id long, node long, fingerprint long, sha binary").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "prints",
    )
    repeated = stored(repeated_fingerprints(prints), "repeated")
    suspects = prints.join(repeated, "fingerprint", "left_semi").select("node", "fingerprint").distinct()
    bodies = rows.mapInArrow(_bytes, "doc_id long, node long, fingerprint long, body binary")
    # Byte verification: equal bodies only, counted where they are read before they are dealt out.
    equal = (
        bodies.join(suspects.hint("shuffle_hash"), ["node", "fingerprint"], "left_semi")
        .groupBy("fingerprint", "body")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
        .filter(F.col("group_size") > 1)
        .select("fingerprint", F.unhex(F.sha2("body", 256)).alias("sha"), "group_size", "keep_id")
    )
    groups = stored(equal, "groups")
    # Where rows repeat the doc_id that stays, the last of them stays.
    last = stored(
        prints.join(groups, ["fingerprint", "sha"])
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("fingerprint", "sha", "group_size", "keep_id")
        .agg(F.max("row").alias("last_row")),
        "last",
    )
    joined = prints.join(last, ["fingerprint", "sha"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("last_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "node",
    )
