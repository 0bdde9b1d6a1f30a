"""Quality scores learnt from preference pairs (Bradley-Terry), cut at a quantile.

A document's strength is a linear function of features of its text. Of each pair (a good
document, a bad one) the good one should win; the weights minimise the logistic loss of the
feature differences. The cut is the quantile of the strengths that equals the share of
bad labels; the score is a logistic curve which passes ``THRESHOLD`` there.

The weights are fit on at most ``PER_CLASS`` labelled rows of each class (those with the smallest hashes of
doc_id) and ``PAIRS`` pairs of them, whatever the size of the corpus. Shares are counted over
all labels, the cut is the quantile over all labelled rows outside the held-out fold, scores cover all rows.

Defined cases: null and empty texts get the score of their (zero) features; null labels are
ignored; several labels of one doc_id count as the largest; without labels of both classes all
scores are 0.5; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, released, ship, stored, texts

PER_CLASS = 3000
PAIRS = 60_000
THRESHOLD = 0.3
FOLDS = 5
#: Labels that are broadcast to the texts; more are joined with their strengths.
FEW_LABELS = 500_000
#: Ranges counted at once on the way to a quantile, and distinct strengths that the driver takes.
RANGES, LAST_VALUES = 4096, 10_000

FEATURES = (
    "no_words", "words", "word_length", "repeated_next", "top_word", "distinct", "upper", "digits", "symbols",
    "marks_in_row", "bars", "stops", "short_words", "ends_in_letter", "long_words", "lines", "repeated_lines",
    "non_ascii", "controls", "mixed_case",
)

_KINDS = np.zeros(256, "i8")
_KINDS[ord("a") : ord("z") + 1] = 1
_KINDS[ord("A") : ord("Z") + 1] = 2
_KINDS[ord("0") : ord("9") + 1] = 3
for _mark in b"!#$%&*@^~=+<>\\/{}[]_`":
    _KINDS[_mark] = 4
_KINDS[ord("|")] = 5
for _mark in b".,;:'\"()-?":
    _KINDS[_mark] = 6
_KINDS[128:] = 7
_KINDS[:9] = 8
_KINDS[14:32] = 8
_MARK_RUNS = re.compile(r"[^\w\s]{2,}")
_MIXED = re.compile(r"[a-z][A-Z]")


def features(text: str) -> list[float]:
    """The numbers that a score rests on, each a share or a damped count of the whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    kinds = np.bincount(_KINDS[np.frombuffer(text.encode("utf-8", "replace"), "u1")], minlength=9)
    letters = max(1, int(kinds[1] + kinds[2] + kinds[7]))
    size = max(1, int(kinds.sum()))
    same = sum(map(str.__eq__, words, words[1:]))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = len(set(lines))
    lengths = np.fromiter(map(len, words), "i8", n)
    return [
        0.0,
        math.log1p(n),
        min(20.0, float(lengths.mean())),
        same / n,
        max(counts.values()) / n,
        len(counts) / n,
        float(kinds[2]) / letters,
        float(kinds[3]) / size,
        float(kinds[4]) / size,
        len(_MARK_RUNS.findall(text)) / n,
        counts["|"] / n,
        text.count(".") / n,
        float((lengths <= 3).mean()),
        sum(x[-1].isalpha() for x in words) / n,
        float((lengths > 20).mean()),
        math.log1p(len(lines)),
        1 - line_counts / max(1, len(lines)),
        float(kinds[7]) / size,
        float(kinds[8]) / size,
        len(_MIXED.findall(text)) / n,
    ]


@released
def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = frame.drop(columns="text")
        out["x"] = [features(x) for x in frame["text"]]
        yield out


class Ranker:
    """Weights, the features' centre and scale, and the cut."""

    def __init__(self, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray, cut: float):
        self.weights, self.centre, self.scale, self.cut = weights, centre, scale, cut

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        margin = np.clip(self.strengths(x) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)
        return 1 / (1 + np.exp(-margin))


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float, penalty: float = 1.0) -> Ranker:
    """Bradley-Terry weights by Newton steps on the pairs' feature differences."""
    both = np.concatenate([good, bad]) if len(good) and len(bad) else np.zeros((0, len(FEATURES)))
    if not len(both):
        zero = np.zeros(len(FEATURES))
        return Ranker(zero, zero, zero + 1, 0.0)
    centre, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    g, b = (np.clip((x - centre) / scale, -8, 8) for x in (good, bad))
    chance = np.random.default_rng(5)
    pairs = g[chance.integers(len(g), size=PAIRS)] - b[chance.integers(len(b), size=PAIRS)]
    weights = np.zeros(pairs.shape[1])
    for _ in range(30):
        lose = 1 / (1 + np.exp(np.clip(pairs @ weights, -500, 500)))
        slope = pairs.T @ lose - penalty * weights
        curve = (pairs * (lose * (1 - lose))[:, None]).T @ pairs + penalty * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    strengths = np.concatenate([g @ weights, b @ weights])
    shares = np.concatenate([np.full(len(g), (1 - bad_share) / len(g)), np.full(len(b), bad_share / len(b))])
    order = np.argsort(strengths, kind="stable")
    below = np.cumsum(shares[order])
    at = int(np.clip(np.searchsorted(below, bad_share - 1e-9) + 1, 1, len(order) - 1))
    cut = (strengths[order[at - 1]] + strengths[order[at]]) / 2
    return Ranker(weights, centre, scale, float(cut))


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    given = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(fold("doc_id", FOLDS) != 0)
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    counts = {row["quality"]: row["count"] for row in given.groupBy("quality").count().collect()}
    order = [F.xxhash64("labelled"), F.col("labelled")]
    chosen = None
    for quality in (0, 1):
        part = given.filter(F.col("quality") == quality).orderBy(*order).limit(PER_CLASS)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = texts(docs, "doc_id").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))  # 2 * PER_CLASS rows
    rows = sample.select("quality", "labelled", "text").mapInPandas(
        _rows, "quality int, labelled long, x array<double>"
    )
    found = rows.toPandas().sort_values("labelled", kind="stable")
    by = [np.array(found.loc[found["quality"] == q, "x"].tolist()).reshape(-1, len(FEATURES)) for q in (1, 0)]
    total = sum(counts.values())
    bad_share = counts.get(0, 0) / total if total else 0.0
    ranker = fit(by[0], by[1], bad_share)
    if max(counts.values(), default=0) > PER_CLASS and ranker.weights.any():
        few = total <= FEW_LABELS
        ranker.cut = quantile(stored(_strengths(docs, given, ranker, few), "strengths"), bad_share)
    return ranker


def _strengths(docs: DataFrame, given: DataFrame, ranker: Ranker, few: bool) -> DataFrame:
    """quality, strength of every labelled row; of many labels the texts are scored before the join, not dealt out."""

    @released
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array([features(text) for text in frame["text"]]).reshape(-1, len(FEATURES))
            # Adding 0 makes -0.0 the same as 0.0.
            yield frame[["labelled"]].assign(strength=ranker.strengths(x) + 0.0)

    rows = texts(docs.filter(F.col("doc_id").isNotNull()).filter(fold("doc_id", FOLDS) != 0), F.col("doc_id").alias("labelled"))
    if few:
        rows = rows.join(F.broadcast(given.select("labelled")), "labelled", "left_semi")
    rows = rows.select(F.col("labelled").cast("long").alias("labelled"), "text")
    return rows.mapInPandas(run, "labelled long, strength double").join(given, "labelled").select("quality", "strength")


def quantile(rows: DataFrame, bad_share: float) -> float:
    """The strength that has ``bad_share`` of all weight below it; each class weighs its share, whatever rows it has.

    Ranges around the wanted place are counted until they hold few distinct values.
    """
    good = F.sum((F.col("quality") == 1).cast("long")).alias("good")
    bad = F.sum((F.col("quality") == 0).cast("long")).alias("bad")
    all_ = rows.agg(good, bad, F.min("strength").alias("lo"), F.max("strength").alias("hi")).first()
    each = (1 - bad_share) / max(1, all_["good"]), bad_share / max(1, all_["bad"])
    wanted, before, lo, hi = bad_share - 1e-9, 0.0, all_["lo"], all_["hi"]
    while True:
        inside = rows.filter(F.col("strength").between(lo, hi))
        values = inside.groupBy("strength").agg(good, bad)
        width = (hi - lo) / RANGES
        last = values.orderBy("strength").limit(LAST_VALUES + 1).collect()
        if len(last) <= LAST_VALUES or not width or lo + width == lo:
            break
        number = F.least(F.floor((F.col("strength") - lo) / width), F.lit(RANGES - 1))
        ranges = inside.groupBy(number.alias("k")).agg(good, bad, F.min("strength").alias("lo"), F.max("strength").alias("hi"))
        for one in ranges.orderBy("k").collect():
            weight = one["good"] * each[0] + one["bad"] * each[1]
            if before + weight >= wanted:
                break
            before += weight
        if (one["lo"], one["hi"]) == (lo, hi):
            break
        lo, hi = one["lo"], one["hi"]
    at = last[-1]["strength"]
    more = False  # whether the place lies before the last of equal strengths
    for one in last:
        before += one["good"] * each[0] + one["bad"] * each[1]
        if before >= wanted:
            at, more = one["strength"], before - (each[1] if one["bad"] else each[0]) >= wanted
            break
    if more:
        return float(at)
    side = rows.agg(
        F.min(F.when(F.col("strength") > at, F.col("strength"))).alias("above"),
        F.max(F.when(F.col("strength") < at, F.col("strength"))).alias("below"),
    ).first()
    other = side["above"] if side["above"] is not None else side["below"]
    return float(at if other is None else (at + other) / 2)


def accepted(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``THRESHOLD`` or more."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(ranker.scores(np.array([features(x) for x in text]).reshape(-1, len(FEATURES))))

    return docs.filter(score(F.coalesce("text", F.lit(""))) >= THRESHOLD)


def quality_scores(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)

    @released
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array([features(text) for text in frame["text"]]).reshape(-1, len(FEATURES))
            out = frame.drop(columns="text").astype({"doc_id": "Int64"})
            out["score"] = ranker.scores(x)
            yield out

    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"))
    scored = rows.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
